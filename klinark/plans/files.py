"""From delimited files to the sources of a load, so that every line is accounted for."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from klinark.operators.rows import Rules
from klinark.plans.facts import type_consultations, type_stays, type_surveys
from klinark.schemas import CORRUPT, RAW_CONSULTATIONS, RAW_DEATHS, RAW_STAYS, RAW_SURVEY
from klinark.sources.delimited import malformed_reason, read_delimited

ORIGIN = ("fichier", "debut_bloc")
MALFORMED = "motif_ligne"
REASONS = ("LIGNE_COURTE", "LIGNE_LONGUE", "LIGNE_ILLISIBLE")


@dataclass(frozen=True)
class TextFile:
    """Where a delimited source lies and how it is written."""

    path: str
    sep: str = ";"
    encoding: str = "UTF-8"


def read_lines(spark: SparkSession, file: TextFile, schema: T.StructType) -> DataFrame:
    """Every line of a source in its columns, with its file, the block it lies in, and why it is malformed, if it is.

    A malformed line keeps its text in `ligne_brute` and what could be read of it; nothing is left out.
    """
    read = read_delimited(spark, file.path, schema, file.sep, file.encoding)
    return (read.withColumn(MALFORMED, malformed_reason(schema, file.sep))
            .withColumn("fichier", F.col("_metadata.file_name")).withColumn("debut_bloc", F.col("_metadata.file_block_start"))
            .withColumnRenamed(CORRUPT, "ligne_brute"))


def line_rules(df: DataFrame) -> Rules:
    """Reject reasons of malformed lines, for sources that were read from files; they come before all others."""
    return [(reason, F.col(MALFORMED) == reason) for reason in REASONS] if MALFORMED in df.columns else []


def count_lines(spark: SparkSession, file: TextFile) -> int:
    """Lines of a source that are not blank, without one header per file: counted from the text, not from its parse."""
    lines = spark.read.text(file.path).select("value", F.col("_metadata.file_path").alias("f")).filter(F.trim("value") != "")
    return lines.groupBy("f").agg((F.count("*") - 1).alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def read_consultations(spark: SparkSession, file: TextFile) -> DataFrame:
    return type_consultations(read_lines(spark, file, RAW_CONSULTATIONS))


def read_stays(spark: SparkSession, file: TextFile) -> DataFrame:
    return type_stays(read_lines(spark, file, RAW_STAYS))


def read_one_campaign(spark: SparkSession, file: TextFile) -> DataFrame:
    return type_surveys(read_lines(spark, file, RAW_SURVEY))


def read_deaths(spark: SparkSession, file: TextFile) -> DataFrame:
    return read_lines(spark, file, RAW_DEATHS)
