"""Physical layout of the tables: zones, partitions, buckets, statistics, evidence."""

from __future__ import annotations

from contextlib import nullcontext

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from klinark.session import open_writers, small_reads


def ensure_zones(spark: SparkSession, root: str, zones=("staging", "entrepot")) -> None:
    """Create one database per zone, each with its own location."""
    for zone in zones:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {zone} LOCATION '{root.rstrip('/')}/{zone}'")


COMPRESSION = "zstd"  # halves the hexadecimal digits of pseudonyms, which the default codec stores as they are


def gather(df: DataFrame, *columns) -> DataFrame:
    """Bring the rows of each output file together before a write.

    A rebalance, not a repartition: adaptive execution merges small groups and splits
    a group that holds most rows over several writers.
    """
    return df.hint("rebalance", *columns)


ROWS_PER_TASK = 250_000


def deal(df: DataFrame, rows: int, *columns: str) -> DataFrame:
    """Rows dealt by a key without hot values over tasks of some `ROWS_PER_TASK` rows; `rows` is their number.

    Adaptive execution merges shuffled parts up to a number of bytes: of narrow rows that is many millions, whose sorts and
    hash tables share the memory of one task. It does not merge what was dealt by number.
    """
    return df.repartition(max(1, -(-rows // ROWS_PER_TASK)), *columns)


def write_partitions(df: DataFrame, path: str, partition_by: list[str], lying: bool = False) -> None:
    """Replace only the partitions present in the frame; the others stay.

    `lying` rows were read from files that hold few partitions each, and are written by the tasks that read them.
    """
    rows = df if lying else gather(df, *[F.col(c) for c in partition_by])
    with open_writers(df.sparkSession):
        (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", COMPRESSION)
         .partitionBy(*partition_by).parquet(path))


def stale_partitions(before: DataFrame, written: DataFrame, partition: str) -> DataFrame:
    """Partitions of a table that a reload did not rewrite."""
    return before.select(partition).distinct().join(
        written.select(partition).distinct(), partition, "left_anti")


def write_table(df: DataFrame, table: str, path: str | None = None,
                partition_by: tuple[str, ...] = (), bucket_by: tuple[str, ...] = (), buckets: int = 8,
                lying: bool = False) -> None:
    """Save a table, partitioned and bucketed as declared; flat by default."""
    groups = [] if lying else [F.col(c) for c in (*partition_by, *bucket_by)]
    writer = (gather(df, *groups) if groups else df).write.mode("overwrite").format("parquet").option("compression", COMPRESSION)
    if path:
        writer = writer.option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        writer = writer.bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
    with open_writers(df.sparkSession):
        writer.saveAsTable(table)


def write_fact(df: DataFrame, table: str, bucket_by: tuple[str, ...] = (), buckets: int = 8,
               path: str | None = None, year: str = "annee", years: list[int] | None = None, lying: bool = False) -> None:
    """Publish a fact by year: the years of the frame are replaced, the other years stay.

    The first load creates the table with its declared buckets. `years` names the years to replace also
    where the frame has no row for them. `lying` rows were read from files that hold few years each, such as those of a
    numbering by day: the tasks that read them write them, without a shuffle, and each has files in few years only.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        with small_reads(spark) if lying else nullcontext():
            write_table(df, table, path, (year,), bucket_by, buckets, lying)
        return
    name, before = "spark.sql.sources.partitionOverwriteMode", spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set(name, "dynamic")
    try:
        rows = df.select(*spark.table(table).columns)
        with open_writers(spark), small_reads(spark) if lying else nullcontext():
            (rows if lying else gather(rows, F.col(year))).write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set(name, before)
    if years is not None:
        filled = {row[0] for row in df.select(year).distinct().collect()}  # one row per year
        for empty in sorted(set(years) - filled):
            clear_partition(spark, table, year, empty)


def clear_partition(spark: SparkSession, table: str, partition: str, value: int) -> None:
    """Remove the rows of one partition of a table; the others keep their files."""
    kinds = T.StructType([f for f in spark.table(table).schema if f.name != partition])
    nothing = spark.createDataFrame([], kinds)
    spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION ({partition} = {int(value)}) SELECT * FROM {{rows}}", rows=nothing)


def replace_batch(df: DataFrame, path: str, batch: dict[str, str]) -> None:
    """Replace one partition of a file table by the rows of a frame, also by none."""
    folder = "/".join([path.rstrip("/"), *[f"{name}={value}" for name, value in batch.items()]])
    df.write.mode("overwrite").parquet(folder)


def inventory(spark: SparkSession, zone: str) -> DataFrame:
    """Tables of a zone with their columns and types (catalog metadata only)."""
    rows = [(table.name, column.name, column.dataType)
            for table in spark.catalog.listTables(zone) if not table.isTemporary
            for column in spark.catalog.listColumns(f"{zone}.{table.name}")]
    return spark.createDataFrame(rows, "table_name string, colonne string, type string")


def analyse(spark: SparkSession, table: str) -> None:
    """Collect the column statistics the cost-based optimiser uses."""
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR ALL COLUMNS")


def partition_counts(df: DataFrame, partition: str) -> DataFrame:
    return df.groupBy(partition).agg(F.count("*").alias("n"))


def value_skew(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of the most and least frequent value of a choice of layout columns."""
    return (df.groupBy(*keys).agg(F.count("*").alias("n"))
            .agg(F.count("*").alias("n_valeurs"), F.max("n").alias("n_max"), F.min("n").alias("n_min"))
            .select(F.lit("+".join(keys)).alias("cles"), "n_valeurs", "n_max", "n_min",
                    F.round(F.col("n_max") / F.col("n_min"), 2).alias("rapport")))


def scanned_bytes(df: DataFrame) -> DataFrame:
    """Files and bytes that a filtered read of a file table touches."""
    return (df.select("_metadata.file_path", "_metadata.file_size").distinct()
            .agg(F.count("*").alias("n_fichiers"), F.sum("file_size").alias("octets")))
