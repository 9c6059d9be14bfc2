"""A training-data pipeline over the documents: filters, near duplicates, mixture, tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from klinark.llm import quality, toxicity
from klinark.llm.byte_bpe import read_ranks, round_trip
from klinark.llm.mixing import Target, mix
from klinark.llm.ngram_join import repeated_rows, text_key
from klinark.llm.shared import table
from klinark.llm.vocabulary import PATTERN, vocabulary_path
from klinark.session import stage, staging_path

LEAST_QUALITY = 0.5   # documents that score less go
MOST_TOXICITY = 0.7   # documents that score as much go


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject.

    Learns from the labels of the documents at hand. A text without words is scored like any other;
    without labels nothing is rejected.
    """
    described = stage(quality.features(docs), "quality-features")
    model = quality.train(described, table(spark, sf_dir, "labels"))
    return quality.add_scores(docs, model).filter(F.col("_quality") >= LEAST_QUALITY).select(*docs.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier does not reject; without toxic labels all stay."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.add_scores(docs, model).filter(F.col("_toxicity") < MOST_TOXICITY).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group whose five-word shingles are linked at 0.8: that of the smallest id.

    Each row is judged by its own text, whatever other rows hold its id. Rows without an id are
    judged among themselves: one of a group stays, beside that of the smallest id. Documents without
    words are in no group and stay; with an id, one for each text.
    """
    flags = repeated_rows(docs, size=5, percent=80).select(
        F.col("doc_id").alias("_flag_id"), F.col("text_key").alias("_flag_text"), F.col("gone").alias("_gone"))
    flagged = docs.join(flags, docs["doc_id"].cast("long").eqNullSafe(flags["_flag_id"])
                        & (text_key() == flags["_flag_text"]), "left")
    single = flagged.filter("_flag_text is null").select(*docs.columns)
    repeated = flagged.filter("not _gone").dropDuplicates(["doc_id", "text"]).select(*docs.columns)
    return single.unionByName(repeated)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, those of rare sources repeated up to twice as often as those of the largest one."""
    return mix(docs, Target(repeats=2.0)).select(*docs.columns)


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of each row of the mixture.

    Equal rows are counted before they are encoded, which also deals the texts out evenly; each is written as often
    as it was met.
    """
    counted = docs.groupBy("doc_id", "text").agg(F.count("*").alias("_copies"))
    return round_trip(counted, read_ranks(vocabulary_path()), PATTERN, copies="_copies")


STAGES = [("quality classifier", keep_good), ("toxicity", drop_toxic), ("n-gram Jaccard join", drop_near_copies),
          ("mixing sources to target weights", mix_sources), ("byte-level BPE encoding and decoding", to_tokens)]

ORACLE_SQL = None  # the classifiers and the vocabulary have no SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents, each written as Parquet and read by the next one."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        path = staging_path(spark, name.replace(" ", "-"))
        function(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
