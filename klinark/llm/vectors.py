"""Vectors of an embedding table as numpy matrices inside Spark tasks."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

QUERY_STEP = 50  # rows whose id is divisible by it are the queries


def usable(df: DataFrame, k: int, vec_id: str = "vec_id", vector: str = "embedding", kind: str = "double") -> DataFrame:
    """(vec_id, x array of `kind`): rows with an id whose vector has only finite components.

    Null vectors, empty ones and those with a null, NaN or infinite component are left out. Equal
    rows are counted, and k of them stay: further copies, of a candidate or of a query, cannot change which k
    results are best. Different vectors of one id are all kept.
    """
    x = F.transform(F.col(vector), lambda v: v.cast(kind))
    fine = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = df.select(F.col(vec_id).cast("long").alias("vec_id"), x.alias("x"))
    rows = rows.filter(F.col("vec_id").isNotNull() & (F.size("x") > 0) & fine)
    counted = rows.groupBy("vec_id", "x").agg(F.count("*").alias("n"))
    return counted.select("vec_id", "x", F.explode(F.sequence(F.lit(1), F.least("n", F.lit(k)).cast("int")))).drop("col")


def matrix(lists, width: int | None = None) -> np.ndarray:
    """Rows of an Arrow list column as a matrix; shorter rows are padded with zeros."""
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    width = int(max(lengths, default=0)) if width is None else width
    if len(lengths) and (lengths == width).all():
        return flat.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width), flat.dtype)
    at = np.concatenate(([0], np.cumsum(lengths)))
    for k, n in enumerate(lengths):
        out[k, :min(n, width)] = flat[at[k]:at[k] + min(n, width)]
    return out


def best(found: DataFrame, k: int) -> DataFrame:
    """The k best candidates of each query, numbered from 1; ties go to the smaller id."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
