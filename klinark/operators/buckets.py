"""Bucketed tables whose hot keys are spread over buckets, and the join that reads them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from klinark.operators.layout import write_table

SALT = "_sel"


def bucket_number(columns: list[str], buckets: int) -> Column:
    """Bucket that the writer puts a row in: its hash of the bucket columns modulo their number."""
    return F.pmod(F.hash(*columns), F.lit(buckets)).cast("int")


def bucket_rows(df: DataFrame, columns: list[str], buckets: int) -> DataFrame:
    """(seau, n) for every bucket, empty ones included."""
    filled = df.groupBy(bucket_number(columns, buckets).alias("seau")).agg(F.count("*").alias("n"))
    numbers = df.sparkSession.range(buckets).select(F.col("id").cast("int").alias("seau"))
    return numbers.join(filled, "seau", "left").withColumn("n", F.coalesce("n", F.lit(0).cast("long")))


def bucket_skew(df: DataFrame, columns: list[str], buckets: int, name: str) -> DataFrame:
    """One row: largest and smallest bucket, and the ratio of the largest to the mean."""
    return (bucket_rows(df, columns, buckets)
            .agg(F.max("n").alias("n_max"), F.min("n").alias("n_min"), F.sum("n").alias("n"))
            .select(F.lit(name).alias("disposition"), F.lit(buckets).alias("n_seaux"), "n_max", "n_min",
                    F.round(F.col("n_max") * buckets / F.col("n"), 2).alias("rapport_moyenne")))


def hot_keys(df: DataFrame, key: str, buckets: int, share: float = 0.1) -> DataFrame:
    """(key, parts): keys with more rows than `share` of an even bucket, and into how many parts each is cut.

    At most buckets / share keys are hot and have together at most twice as many parts, whatever the size of the table.
    Parts are a tenth of an even bucket, so that chance spreads them well. Null is a key like any other.
    """
    counts = df.groupBy(key).agg(F.count("*").alias("_n"))
    even = counts.agg(F.sum("_n")).first()[0] or 0
    limit = max(even * share / buckets, 1)
    return (counts.filter(F.col("_n") > limit)
            .select(key, F.ceil(F.col("_n") / F.lit(limit)).cast("int").alias("parts")))


def salted(df: DataFrame, key: str, hot: DataFrame, spread: list[str]) -> DataFrame:
    """Rows with the part of their key: 0, or for hot keys a hash of the `spread` columns.

    The list of hot keys is broadcast; its size is bounded by the number of buckets.
    """
    parts = hot.select(F.col(key).alias("_hot"), "parts")
    joined = df.join(F.broadcast(parts), F.col(key).eqNullSafe(F.col("_hot")), "left")
    return (joined.withColumn(SALT, F.when(F.col("parts").isNull(), 0).otherwise(F.pmod(F.xxhash64(*spread), F.col("parts"))).cast("int"))
            .drop("_hot", "parts"))


def write_salted(df: DataFrame, table: str, key: str, spread: list[str], buckets: int, path: str | None = None,
                 share: float = 0.1) -> None:
    """Save a table bucketed on a key, hot keys cut into parts; the list of hot keys is saved as `<table>_chaudes`."""
    spark = df.sparkSession
    hot = hot_keys(df, key, buckets, share)
    write_table(hot, f"{table}_chaudes", None if path is None else f"{path}-chaudes")
    write_table(salted(df, key, spark.table(f"{table}_chaudes"), spread), table, path, bucket_by=(key, SALT), buckets=buckets)


def join_salted(spark: SparkSession, table: str, other: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join of a salted table with a frame on its key, without moving the table.

    Rows of `other` whose key is hot are repeated once per part, all others stay single. Every row of the
    table meets each partner once, so `how` may be inner, left, left_semi or left_anti (the table is on the left).
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"a {how} join would count repeated rows of the right side")
    hot = spark.table(f"{table}_chaudes").select(F.col(key).alias("_hot"), "parts")
    parts = F.coalesce(F.col("parts"), F.lit(1))
    repeated = (other.join(F.broadcast(hot), F.col(key) == F.col("_hot"), "left")
                .withColumn(SALT, F.explode(F.sequence(F.lit(0), parts - 1))).drop("_hot", "parts"))
    return spark.table(table).join(repeated, [key, SALT], how).drop(SALT)
