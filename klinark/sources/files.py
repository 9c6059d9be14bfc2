"""Format profile of text files whose encoding and separator are not known."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SEPARATORS = {";": "point-virgule", ",": "virgule", "\t": "tabulation", "|": "barre"}


def _occurrences(line: Column, sep: str) -> Column:
    return F.length(line) - F.length(F.replace(line, F.lit(sep), F.lit("")))


def _separator_count(header: Column) -> Column:
    """Number of the most frequent candidate separator of a header line, and how often it occurs; the first one wins ties.

    Both are in one number (count * candidates + candidate), so that an aggregate of it needs no text.
    """
    return F.greatest(*[_occurrences(header, sep).cast("long") * len(SEPARATORS) + (len(SEPARATORS) - 1 - rank)
                      for rank, sep in enumerate(SEPARATORS)])


def profile_files(spark: SparkSession, path: str, pattern: str = "*.csv") -> DataFrame:
    """One row per file: encoding, separator, number of columns and of data lines.

    Works line by line, so that large files are split over many tasks and every line
    counts in the encoding test: a file is UTF-8 when each of its lines is. The header's separator and columns are
    found line by line as one number: aggregates of a fixed size take no sort and no memory that grows with the lines.
    """
    in_first_block = F.col("_metadata.file_block_start") == 0
    lines = (spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
             .text(path)
             .select(F.col("_metadata.file_path").alias("file"), F.is_valid_utf8("value").alias("valid"),
                     (F.trim("value") != "").alias("filled"), F.when(in_first_block, _separator_count(F.col("value"))).alias("head"),
                     F.when(in_first_block, F.monotonically_increasing_id()).alias("position")))
    per_file = lines.groupBy("file").agg(
        F.bool_and("valid").alias("utf8"), F.min_by("head", "position").alias("header"),
        F.count_if("filled").alias("lines"))
    last = len(SEPARATORS) - 1
    separator = F.element_at(F.array(*[F.lit(sep) for sep in SEPARATORS]), (last + 1 - F.col("header") % (last + 1)).cast("int"))
    return per_file.select(
        "file",
        F.when(F.col("utf8"), "utf-8").otherwise("latin-1").alias("encoding"),
        separator.alias("separator"),
        (F.floor(F.col("header") / (last + 1)) + 1).cast("int").alias("n_columns"),
        (F.col("lines") - 1).alias("n_rows"))
