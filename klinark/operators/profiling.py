"""Source profiles. Each one reads its input once."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from klinark.functions.codes import is_blank
from klinark.functions.values import percent


def volumes(frames: dict[str, DataFrame]) -> DataFrame:
    """Number of rows of each frame."""
    counts = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n")
              for name, df in frames.items()]
    return reduce(DataFrame.unionAll, counts)


def completeness(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per column: missing values, blanks, and their share in percent."""
    counts = [F.count_if(F.col(c).isNull()).alias(f"{c}|nulls") for c in columns]
    counts += [F.count_if(F.trim(F.col(c).cast("string")) == "").alias(f"{c}|blanks") for c in columns]
    one_row = df.agg(F.count("*").alias("total"), *counts)
    entries = F.array(*[F.struct(F.lit(c).alias("colonne"), F.col(f"{c}|nulls").alias("n_null"),
                                 F.col(f"{c}|blanks").alias("n_vide")) for c in columns])
    return (one_row.select("total", F.explode(entries).alias("e")).select("total", "e.*")
            .withColumn("pct_manquant", percent(F.col("n_null") + F.col("n_vide"), F.col("total"), 1)))


def duplicate_rows(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows in excess of one per key, in total."""
    per_key = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return per_key.agg(F.sum(F.col("n") - 1).alias("n_doublons"))


def date_range(df: DataFrame, day: str, start: str, end: str) -> DataFrame:
    """First and last date, inverted and empty intervals."""
    return df.agg(F.min(day).alias("date_min"), F.max(day).alias("date_max"),
                  F.count_if(F.col(end) < F.col(start)).alias("n_inverse"),
                  F.count_if(F.col(end) == F.col(start)).alias("n_duree_zero"))


def cardinalities(df: DataFrame, columns: list[str], exact: bool = True) -> DataFrame:
    """Distinct values per column; approximate counts need no shuffle of the values."""
    count = F.count_distinct if exact else F.approx_count_distinct
    return df.agg(*[count(F.col(c)).alias(f"{c}_distinct") for c in columns])


def numeric_profile(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    """Range and mean of a number, and values outside the admitted range."""
    value = F.col(column)
    return df.agg(F.count(value).alias("n"), F.min(value).alias("valeur_min"),
                  F.max(value).alias("valeur_max"), F.avg(value).alias("valeur_moyenne"),
                  F.count_if(~value.between(low, high)).alias("n_hors_plage"))


def histograms(df: DataFrame, axes: dict[str, Column]) -> DataFrame:
    """Counts per value of several expressions, over one scan (grouping sets)."""
    named = df.select(*[axis.cast("string").alias(name) for name, axis in axes.items()])
    sets = [[F.col(name)] for name in axes]
    number = {name: (1 << len(axes)) - 1 - (1 << (len(axes) - 1 - i)) for i, name in enumerate(axes)}
    kind = reduce(lambda acc, item: acc.when(F.col("_set") == item[1], item[0]),
                  list(number.items())[1:],
                  F.when(F.col("_set") == list(number.values())[0], list(number)[0]))
    return (named.groupingSets(sets, *[F.col(n) for n in axes])
            .agg(F.grouping_id().alias("_set"), F.count("*").alias("n"))
            .select(kind.alias("axe"), F.coalesce(*axes).alias("valeur"), "n"))


def run_summary(runs: DataFrame) -> DataFrame:
    """Mean, fastest and slowest duration per query and variant of a benchmark log."""
    return (runs.filter(F.col("duration_sec").isNotNull()).groupBy("query", "variant")
            .agg(F.avg("duration_sec").alias("moyenne"), F.min("duration_sec").alias("minimum"),
                 F.max("duration_sec").alias("maximum"), F.count("*").alias("n")))


def blanks(df: DataFrame, columns: list[str]) -> DataFrame:
    """Share of missing or blank values per column, one column each."""
    return df.agg(*[percent(F.count_if(is_blank(F.col(c))), F.count("*"), 1).alias(f"pct_{c}")
                    for c in columns])
