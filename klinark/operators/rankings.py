"""Top lists, shares, changes and gaps over aggregated results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from klinark.functions.fixed_values import OTHER_LABEL
from klinark.functions.values import whole_percent


def top_n(totals: DataFrame, measure: str, key: str, n: int) -> DataFrame:
    """The n largest rows; the key settles ties."""
    return totals.orderBy(F.desc(measure), F.asc(key)).limit(n)


def top_n_per_group(totals: DataFrame, group: str, measure: str, key: str, n: int) -> DataFrame:
    """The n largest rows of each group; the key settles ties."""
    window = Window.partitionBy(group).orderBy(F.desc(measure), F.asc(key))
    return totals.withColumn("rang", F.row_number().over(window)).filter(F.col("rang") <= n)


def lump_other(df: DataFrame, column: str, n: int, weight: str | None = None,
               other: str = OTHER_LABEL) -> DataFrame:
    """Keep the n most frequent values of a column and merge the others.

    `weight` holds the number of rows each row stands for when the frame is already
    aggregated. NULL takes no place in the list and is merged like any other value.
    """
    size = F.sum(weight) if weight else F.count("*")
    kept = (top_n(df.filter(F.col(column).isNotNull()).groupBy(column).agg(size.alias("_size")), "_size", column, n)
            .select(column, F.lit(True).alias("_kept")))
    return (df.join(kept, column, "left")
            .withColumn(column, F.when(F.col("_kept"), F.col(column)).otherwise(other))
            .drop("_kept"))


def share_of_total(totals: DataFrame, measure: str, digits: int, name: str = "part_pct") -> DataFrame:
    """Share of each row in the sum of an aggregated frame (one row per axis value).

    The sum is a scalar subquery: the rows stay spread over their partitions.
    """
    whole = totals.agg(F.sum(measure)).scalar()
    return totals.withColumn(name, F.round(100.0 * F.col(measure) / whole, digits).cast("double"))


def year_on_year(totals: DataFrame, year: str, measure: str) -> DataFrame:
    """Previous-year value and rounded change; NULL when the year before is absent."""
    before = totals.select((F.col(year) + 1).cast(totals.schema[year].dataType).alias(year),
                           F.col(measure).alias("precedent"))
    return (totals.join(before, year, "left")
            .withColumn("evolution_pct",
                        whole_percent(F.col(measure) - F.col("precedent"), F.col("precedent"))))


def first_by(value: str, measure: str) -> Column:
    """Value with the largest measure; the smallest value settles ties."""
    return F.min_by(value, F.struct(-F.col(measure), F.col(value)))


def last_by(value: str, measure: str) -> Column:
    """Value with the smallest measure; the smallest value settles ties."""
    return F.min_by(value, F.struct(F.col(measure), F.col(value)))
