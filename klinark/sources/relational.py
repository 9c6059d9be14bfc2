"""Relational sources read in parallel through JDBC, and their Bronze copy."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_relational(spark: SparkSession, url: str, query: str, properties: dict[str, str],
                    split_column: str | None = None, lower: int | None = None,
                    upper: int | None = None, partitions: int = 1) -> DataFrame:
    """Result of a query on a database.

    With a split column the rows are fetched by several range queries at once; the
    bounds only shape the ranges and never filter rows.
    """
    reader = (spark.read.format("jdbc").options(**properties)
              .option("url", url).option("dbtable", f"({query}) source"))
    if split_column:
        reader = reader.options(partitionColumn=split_column, lowerBound=lower,
                                upperBound=upper, numPartitions=partitions)
    return reader.load()


def to_bronze(df: DataFrame, path: str, sep: str | None = None) -> None:
    """Land an extraction unchanged: as Parquet, or as text when a separator is given."""
    writer = df.write.mode("overwrite")
    if sep:
        writer.options(header=True, sep=sep).csv(path)
    else:
        writer.parquet(path)
