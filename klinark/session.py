"""Session defaults and the shared staging folder."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", memory: str = "8g", app: str = "klinark") -> SparkSession:
    """Session for tests and benches; on a cluster the submitter configures Spark."""
    partitions = "8" if cpus == "*" else str(cpus)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName(app)
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@contextmanager
def open_writers(spark: SparkSession, count: int = 32):
    """Let a task keep several partition files open while it writes.

    Spark otherwise sorts the rows of each task by partition first. A task that meets
    more partitions than `count` still sorts.
    """
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, str(count))
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def small_reads(spark: SparkSession, size: str = "32m"):
    """Read files in parts of this size: a task that sorts what it read, compressed, then holds some million rows at most."""
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, size)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def staging_root(spark: SparkSession) -> str:
    """Shared folder for staged tables: `spark.checkpoint.dir` of the session, else one in the warehouse."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    return root or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_staging"


def staging_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the staging folder."""
    return f"{staging_root(spark).rstrip('/')}/klinark/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str, partition_by: tuple[str, ...] = (), **options) -> DataFrame:
    """Write a frame to the staging folder and read it back.

    Cuts the lineage with files that survive the loss of executors. The caller owns
    the folder: remove it with the retention rule of the staging area. `options` are those of the writer.
    """
    path = staging_path(df.sparkSession, label)
    with open_writers(df.sparkSession):
        df.write.options(**options).partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
