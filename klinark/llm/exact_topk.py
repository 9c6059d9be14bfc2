"""Exact top-k by inner product: a Voronoi join that sends data only to query groups that may need it."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from klinark.llm.shared import whole_groups
from klinark.llm.vectors import QUERY_STEP, best, matrix, usable
from klinark.session import stage

PIVOTS = 16          # cells; a data row goes to at most so many query groups
DATA_BLOCK = 20_000  # data rows that meet in one task
QUERY_BLOCK = 2_000  # queries that meet in one task
SLACK = 1e-9         # relative room for rounding in the bounds


def quantised(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """Components as floor(scale * x), whole numbers."""
    return vectors.select("vec_id", F.transform("x", lambda v: F.floor(v * scale)).alias("x"))


def products(queries: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers, as long (saturated beyond)."""
    largest = float(np.abs(queries.astype(float)).max(initial=0)) * float(np.abs(data.astype(float)).max(initial=0))
    if largest * queries.shape[1] < 2 ** 53:  # exact in floating point
        return (queries.astype(np.float64) @ data.astype(np.float64).T).astype(np.int64)
    if largest * queries.shape[1] < 2 ** 63:
        return queries @ data.T
    whole = queries.astype(object) @ data.astype(object).T
    return np.clip(whole, -(2 ** 63), 2 ** 63 - 1).astype(np.int64)


def _nearest(x: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cell of the nearest pivot, and the distance to it."""
    squares = (x ** 2).sum(1)[:, None] - 2 * x @ pivots.T + (pivots ** 2).sum(1)[None, :]
    cell = squares.argmin(1)
    return cell, np.sqrt(((x - pivots[cell]) ** 2).sum(1))


def thresholds(pivots: np.ndarray, near: dict[int, list[tuple[int, float]]], reach: np.ndarray, k: int) -> np.ndarray:
    """Per query group, a score that the k-th best candidate of each of its queries surely has.

    `near` holds the k + 1 ids closest to each pivot and their distances, `reach` the distance of the
    farthest query of a group from its pivot. With q = c + d and x = p + e, |d| <= u, |e| = r:
    q.x >= c.p - u|p| - r(|c| + u). One id more than k counts, since the rows of a query's own id are
    not its candidates.
    """
    norm = np.sqrt((pivots ** 2).sum(1))
    out = np.full(len(pivots), -np.inf)
    for i, u in enumerate(reach):
        low: dict[int, float] = {}
        for j, own in near.items():
            for name, r in own:
                low[name] = max(low.get(name, -np.inf), pivots[i] @ pivots[j] - u * norm[j] - r * (norm[i] + u))
        if len(low) > k:
            out[i] = sorted(low.values(), reverse=True)[k]
    return out


def top_products(vectors: DataFrame, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding",
                 scale: int = 256, step: int = QUERY_STEP) -> DataFrame:
    """(query_id, rank, vec_id, score): the k largest integer inner products of each query.

    Queries are the rows whose id is divisible by `step`, candidates all rows but those of the query's id.
    Rows and queries are grouped by their nearest pivot (pivots: 16 rows whose ids hash lowest).
    Per cell a summary is kept: the k + 1 ids closest to the pivot with their distances, the largest
    distance of a query. They give each query group a score that its k-th best surely reaches; a
    data row goes to the groups where its upper bound c.p + u|p| + r(|c| + u) reaches it. There, in
    blocks of bounded size, products are exact.

    Vectors that are null, empty or hold a null or non-finite component take no part; equal rows are each a
    candidate and each a query; different vectors of one id are each a candidate and, if the id is a query's, each asked for, the
    best finds of all counting; shorter vectors count as padded with zeros; fewer than k
    candidates give all; ties go to the smaller id; other columns are ignored.
    """
    spark = vectors.sparkSession
    rows = stage(quantised(usable(vectors, k, vec_id, vector), scale), "topk-vectors")
    total, width = rows.agg(F.count("*"), F.coalesce(F.max(F.size("x")), F.lit(0))).first()
    picked = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(PIVOTS).collect()
    if not picked:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    pivots = np.zeros((len(picked), width))
    for at, row in enumerate(picked):
        pivots[at, :len(row.x)] = row.x
    shared = spark.sparkContext.broadcast(pivots)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch["x"], width)
            cell, far = _nearest(x.astype(np.float64), shared.value)
            yield pa.record_batch([batch["vec_id"], pa.array([v.astype("<i8").tobytes() for v in x], pa.binary()),
                                   pa.array(cell.astype(np.int32)), pa.array(far)], names=["vec_id", "x", "cell", "far"])

    placed = stage(rows.mapInArrow(assign, "vec_id long, x binary, cell int, far double"), "topk-placed")
    query = F.col("vec_id") % step == 0
    closest = Window.partitionBy("cell").orderBy("far", "vec_id")
    near: dict[int, list[tuple[int, float]]] = {}
    for cell, name, far in (placed.groupBy("cell", "vec_id").agg(F.min("far").alias("far"))
                            .withColumn("n", F.row_number().over(closest)).filter(F.col("n") <= k + 1)
                            .select("cell", "vec_id", "far").collect()):  # at most PIVOTS * (k + 1) rows
        near.setdefault(cell, []).append((name, far))
    groups = {r[0]: (r[1], r[2]) for r in placed.filter(query).groupBy("cell").agg(F.max("far"), F.count("*")).collect()}
    reach = np.array([groups.get(i, (0.0, 0))[0] for i in range(len(pivots))])
    floors = thresholds(pivots, near, reach, k)
    parts = np.array([-(-groups.get(i, (0.0, 0))[1] // QUERY_BLOCK) for i in range(len(pivots))])
    bounds = spark.sparkContext.broadcast((pivots, reach, floors, parts))
    blocks = max(1, -(-total // DATA_BLOCK))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, u, floor, cuts = bounds.value
        norm, cross = np.sqrt((p ** 2).sum(1)), p @ p.T
        for batch in batches:
            cell, far = batch["cell"].to_numpy(), batch["far"].to_numpy()
            most = cross[cell] + u[None, :] * norm[cell][:, None] + far[:, None] * (norm + u)[None, :]
            room = SLACK * (np.abs(cross[cell]) + (norm + u)[None, :] * (norm[cell] + far)[:, None]) + 1e-6
            row, group = np.nonzero((most + room >= floor[None, :]) & (cuts > 0)[None, :])
            many = cuts[group]  # a row meets each block of the group's queries
            part = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            row, group = np.repeat(row, many), np.repeat(group, many)
            yield pa.record_batch([batch["vec_id"].take(pa.array(row)), batch["x"].take(pa.array(row)),
                                   pa.array(group.astype(np.int32)), pa.array(part.astype(np.int32))],
                                  names=["vec_id", "x", "grp", "part"])

    kind = "vec_id long, x binary, grp int, part int"
    block = F.pmod(F.xxhash64("vec_id", "x"), F.lit(blocks)).cast("int")
    data = placed.mapInArrow(send, kind).withColumn("block", block).withColumn("asks", F.lit(False))
    cuts = F.element_at(F.array(*[F.lit(int(max(c, 1))) for c in parts]), F.col("cell") + 1)
    asking = (placed.filter(query)
              .select("vec_id", "x", F.col("cell").alias("grp"),
                      F.pmod(F.xxhash64("vec_id", "x"), cuts).cast("int").alias("part"),
                      F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(True).alias("asks")))

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tab, at in whole_groups(batches, ["grp", "part", "block"]):
            ids, asks = tab["vec_id"].to_numpy(), tab["asks"].to_numpy()
            x = np.frombuffer(b"".join(tab["x"].to_pylist()), "<i8").reshape(-1, width)
            for start, end in zip(at[:-1].tolist(), at[1:].tolist()):
                mine = np.flatnonzero(asks[start:end]) + start
                theirs = np.flatnonzero(~asks[start:end]) + start
                theirs = theirs[np.argsort(ids[theirs])]
                if not len(mine) or not len(theirs):
                    continue
                for some in np.array_split(mine, -(-len(mine) // 200)):
                    score = products(x[some], x[theirs])
                    own = ids[some][:, None] == ids[theirs][None, :]
                    score[own] = np.iinfo(np.int64).min
                    few = np.argsort(~score, axis=1, kind="stable")[:, :k + 1]  # ids ascend, so ties keep their order
                    q = np.repeat(np.arange(len(some)), few.shape[1])
                    d = few.ravel()
                    ok = ~own[q, d]
                    yield pa.record_batch([pa.array(ids[some][q[ok]]), pa.array(ids[theirs][d[ok]]), pa.array(score[q[ok], d[ok]])],
                                          names=["query_id", "vec_id", "score"])

    met = data.unionByName(asking).repartition("grp", "part", "block").sortWithinPartitions("grp", "part", "block")
    return best(met.mapInArrow(solve, "query_id long, vec_id long, score long"), k)
