"""Persistent surrogate keys: a natural key keeps its surrogate through every reload."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from klinark.session import stage

KEY, COPY = "_cle", "_copie"
BUCKET_ROWS = 250_000  # keys of one bucket when the map is made: some 12 MB


def digest(columns: list[str], hexadecimal: tuple[str, ...] = ()) -> Column:
    """256-bit digest of several columns; lengths keep the parts apart and null differs from empty text.

    Bytes of `hexadecimal` columns count as their lower-case digits.
    """
    parts = []
    for name in columns:
        text = F.lower(F.hex(name)) if name in hexadecimal else F.col(name).cast("string")
        parts += [F.coalesce(F.length(text).cast("string"), F.lit("-")), F.lit(":"), F.coalesce(text, F.lit(""))]
    return F.unhex(F.sha2(F.concat(*parts), 256))


def distinct_keys(df: DataFrame, natural: list[str] | None) -> DataFrame:
    """Rows with their place among those of their natural key.

    Without a natural key the whole row is the key; equal rows are counted, not sorted, and each copy has
    a place of its own.
    """
    if natural is not None:
        return df.withColumn(COPY, F.lit(0).cast("long"))
    counted = df.groupBy(*df.columns).agg(F.count("*").alias("_n"))
    return counted.withColumn(COPY, F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1))).drop("_n")


def numbered(df: DataFrame, name: str, start: int) -> DataFrame:
    """Rows numbered from `start` + 1 in any order, without a sort.

    Each task numbers its rows; the rows are staged with their place, so the count per task and the
    numbers see the same cut. One offset per task is broadcast.
    """
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = stage(df.withColumn("_task", F.spark_partition_id()).withColumn("_place", place), f"{name}-places", compression="zstd")
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (placed.groupBy("_task").count()
               .select("_task", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_offset")))
    return (placed.join(F.broadcast(offsets), "_task")
            .withColumn(name, F.lit(start) + F.col("_offset") + F.col("_place") + 1).drop("_task", "_place", "_offset"))


def map_buckets(spark: SparkSession, table: str) -> int:
    """Buckets that a key map was made with."""
    told = spark.sql(f"DESCRIBE FORMATTED {table}")
    return int(told.filter("lower(col_name) = 'num buckets'").first().data_type)


def stable_keys(df: DataFrame, name: str, natural: list[str] | None, table: str, buckets: int = 8,
                hexadecimal: tuple[str, ...] = ()) -> DataFrame:
    """Rows with a surrogate key that the key map `table` remembers.

    Rows whose natural key is in the map get the surrogate it had; the others get new numbers after the
    largest one and are added to the map before they are returned. `natural` must be unique in `df`;
    None stands for rows without a key, whose copies are numbered one by one. The map holds digests only and is
    bucketed on them, so a reload joins it without moving it. One task reads one bucket: the first load makes as many
    as its rows ask for, `buckets` at least, each one file. After a failure numbers may be missing, but none is given twice.

    Digests are made where a bucket or the map needs them: no row travels or is staged with its own. Columns of
    lower-case `hexadecimal` digests travel and are staged as bytes, in half the room. The rows returned are read
    from staged files, so a caller need not stage them again.
    """
    spark = df.sparkSession
    key = digest(df.columns if natural is None else natural, hexadecimal)
    keyed = distinct_keys(df.withColumns({c: F.unhex(c) for c in hexadecimal}), natural)
    columns = [*df.columns, COPY]
    if spark.catalog.tableExists(table):
        known, count = spark.table(table), map_buckets(spark, table)
        start = known.agg(F.coalesce(F.max(name), F.lit(0))).first()[0]
        if natural is None:  # copies of a row share a bucket, so rows and map are dealt by copy, too
            met = keyed.withColumn(KEY, key).join(known, [KEY, COPY], "left")
        else:  # rows go to the buckets of the map
            met = keyed.repartition(count, key).withColumn(KEY, key).join(known.filter(F.col(COPY) == 0).drop(COPY), KEY, "left")
        # staged: the map is extended below and must not be read again for these rows
        found = stage(met.select(*columns, name), f"{name}-connus", compression="zstd")
        kept, fresh = found.filter(F.col(name).isNotNull()), found.filter(F.col(name).isNull()).select(*columns)
    else:
        start, kept, fresh, count = 0, None, keyed, None
    added = numbered(fresh, name, start)
    entries = added.select(key.alias(KEY), COPY, name)
    if count is None:
        count = max(buckets, -(-entries.count() // BUCKET_ROWS))  # the numbered rows are staged: no work is repeated
        (entries.repartition(count, KEY).write.mode("overwrite").format("parquet").option("compression", "zstd")
         .bucketBy(count, KEY).sortBy(KEY).saveAsTable(table))
    else:
        entries.select(*spark.table(table).columns).repartition(count, KEY).write.insertInto(table)
    out = [name, *[F.lower(F.hex(c)).alias(c) if c in hexadecimal else F.col(c) for c in df.columns]]
    return added.select(*out) if kept is None else kept.select(*out).unionByName(added.select(*out))
