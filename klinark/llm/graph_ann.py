"""Approximate nearest neighbours by cosine: a robust-pruned directed graph per shard, searched with a beam."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType
from pyspark.sql.window import Window

from klinark.llm.vectors import QUERY_STEP, best, matrix, usable
from klinark.session import stage

SHARD_ROWS = 4096      # distinct vectors of a shard, at least
SHARD_GROWTH = 32      # and this many times the root of all: a query meets fewer shards than the table grows by
SHARD_BYTES = 32 << 20  # vectors of a shard, at most
DEGREE = 32            # edges of a node
BEAM = 80              # nodes a search keeps
RELAX = 1.2            # factor by which an edge must be shorter through another neighbour to be pruned
ENTRY_STEP = 4         # nodes per entry node
STARTS = 32            # entry nodes a search starts from
OPENS = 8              # nodes a search opens at once
QUERY_BLOCK = 256      # queries searched together
SLACK = 1e-5            # room for the rounding of similarities in single precision
CELLS = 1 << 23        # numbers of a block of similarities or vectors


def beam_search(x: np.ndarray, edges: np.ndarray, entries: np.ndarray, q: np.ndarray, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
    """Nearest nodes found for each query, and their similarities, best first; places without a find hold -1.

    A search starts from the entry nodes most like the query and always opens the best unopened nodes among the
    `beam` best ones; it ends when all are open. The searches of all queries go on in step.
    """
    n, m = len(x), len(q)
    every = np.arange(m)
    seen = np.zeros((m, n + 1), bool)
    seen[:, n] = True  # edges are filled up with n
    flat, writer = seen.reshape(-1), np.empty(m * (n + 1), np.int32)
    near = q @ x[entries].T
    starts = min(STARTS, beam, len(entries))
    first = np.argpartition(-near, starts - 1, axis=1)[:, :starts]
    first = np.take_along_axis(first, np.argsort(-np.take_along_axis(near, first, 1), axis=1, kind="stable"), 1)
    node, score = np.full((m, beam), -1, np.int64), np.full((m, beam), -np.inf, x.dtype)
    node[:, :starts], score[:, :starts] = entries[first], np.take_along_axis(near, first, 1)
    opened = node < 0
    seen[every[:, None], node[:, :starts]] = True
    found, scores, alive = np.empty_like(node), np.empty_like(score), every
    while len(alive):
        pick = ~opened
        pick &= np.cumsum(pick, axis=1, dtype=np.int32) <= OPENS
        opened |= pick
        row, at = np.nonzero(pick)
        key = (np.take(edges, node[row, at], axis=0) + (alive[row] * (n + 1))[:, None]).reshape(-1)
        key = key[~np.take(flat, key)]
        turn = np.arange(len(key), dtype=np.int32)
        writer[key] = turn
        key = key[np.take(writer, key) == turn]  # of equal ones the last
        flat[key] = True
        asked, new = np.divmod(key, n + 1)
        like = np.einsum("ij,ij->i", np.take(x, new, axis=0), np.take(q, asked, axis=0))
        row = np.searchsorted(alive, asked)
        better = like > score[row, -1]
        row, new, like = row[better], new[better], like[better]
        many = np.bincount(row, minlength=len(alive))
        if len(row):
            place = beam + np.arange(len(row)) - (np.cumsum(many) - many)[row]
            wide = (len(alive), beam + int(many.max()))
            nodes, likes, done = np.full(wide, -1, np.int64), np.full(wide, -np.inf, x.dtype), np.ones(wide, bool)
            nodes[:, :beam], likes[:, :beam], done[:, :beam] = node, score, opened
            nodes[row, place], likes[row, place], done[row, place] = new, like, False
            order = np.argsort(-likes, axis=1, kind="stable")[:, :beam]
            node, score, opened = (np.take_along_axis(a, order, 1) for a in (nodes, likes, done))
        over = opened.all(1)
        if over.any():
            found[alive[over]], scores[alive[over]] = node[over], score[over]
            alive, node, score, opened = alive[~over], node[~over], score[~over], opened[~over]
    return found, scores


def nearest_nodes(x: np.ndarray, many: int) -> np.ndarray:
    """The `many` nodes most like each node, best first, by all products of the shard in blocks.

    The `many`-th largest of the maxima of groups of columns is a floor that at least `many` nodes reach; only
    those are sorted.
    """
    n = len(x)
    many = min(many, n - 1)
    out = np.empty((n, many), np.int64)
    step, group = max(1, CELLS // max(1, n)), max(1, n // (4 * max(1, many)))
    for at in range(0, n if many else 0, step):
        like = x[at:at + step] @ x.T
        own = np.arange(len(like))
        like[own, at + own] = -2
        tops = like[:, :n // group * group].reshape(len(like), -1, group).max(2)
        floor = np.partition(tops, tops.shape[1] - many, axis=1)[:, tops.shape[1] - many]
        row, node = np.divmod(np.flatnonzero(like >= floor[:, None]), n)
        count = np.bincount(row, minlength=len(like))
        place = np.arange(len(row)) - (np.cumsum(count) - count)[row]
        likes, nodes = np.full((len(like), count.max()), -np.inf, x.dtype), np.empty((len(like), count.max()), np.int64)
        likes[row, place], nodes[row, place] = like[row, node], node
        out[at:at + step] = np.take_along_axis(nodes, np.argsort(-likes, axis=1, kind="stable")[:, :many], 1)
    return out


def robust_prune(x: np.ndarray, nodes: np.ndarray, candidates: np.ndarray, degree: int, relax: float) -> np.ndarray:
    """Diverse neighbours of nodes: the nearest candidate is kept, candidates it covers are dropped, and so on.

    A candidate c is covered by a kept p if relax * d(p, c) <= d(node, c). Vectors have length 1, so
    squared distances are 2 - 2 * similarity; those that rounding cannot tell apart cover nothing. Places without a candidate, or without a neighbour, hold len(x).
    """
    n, width = len(x), candidates.shape[1]
    out = np.full((len(nodes), degree), n, np.int64)
    step = max(1, CELLS // 4 // max(1, width * max(width, x.shape[1])))
    for at in range(0, len(nodes) if width else 0, step):
        some = candidates[at:at + step]
        y = np.take(x, np.minimum(some, n - 1), axis=0)
        far = 2 - 2 * (y @ x[nodes[at:at + step]][:, :, None])[:, :, 0]
        far[some == n] = np.inf
        order = np.argsort(far, axis=1, kind="stable")
        some, far = np.take_along_axis(some, order, 1), np.take_along_axis(far, order, 1)
        y = np.take_along_axis(y, order[:, :, None], 1)
        between = x.dtype.type(relax ** 2) * (2 - 2 * (y @ y.transpose(0, 2, 1)))
        open_, every = some < n, np.arange(len(some))
        for place in range(degree):
            k = open_.argmax(1)
            live = open_[every, k]
            if not live.any():
                break
            out[at + every[live], place] = some[live, k[live]]
            open_ &= between[every, k] > far - SLACK
            open_[every, k] = False
    return out


def _linked_back(x: np.ndarray, edges: np.ndarray, most: int, relax: float) -> np.ndarray:
    """Edges in both directions; a node that gets more than `most` is pruned anew."""
    n = len(x)
    here, at = np.nonzero(edges < n)
    there = edges[here, at]
    here, there = np.divmod(np.unique(np.concatenate([here * n + there, there * n + here])), max(1, n))
    count = np.bincount(here, minlength=n)
    order = np.lexsort((-np.einsum("ij,ij->i", np.take(x, here, axis=0), np.take(x, there, axis=0)), here))
    here, there = here[order], there[order]  # the nearest first
    place = np.arange(len(here)) - (np.cumsum(count) - count)[here]
    out = np.full((n, most), n, np.int64)
    fits = count[here] <= most
    out[here[fits], place[fits]] = there[fits]
    full = np.flatnonzero(count > most)
    pool = np.full((len(full), min(int(count.max(initial=0)), 8 * most)), n, np.int64)
    near = ~fits & (place < pool.shape[1])
    pool[np.searchsorted(full, here[near]), place[near]] = there[near]
    out[full] = robust_prune(x, full, pool, most, relax)
    return out


def _entries(edges: np.ndarray, step: int) -> np.ndarray:
    """Entry nodes: a fixed random part of the nodes, and more of them until every node can be reached."""
    n = len(edges)
    entries = fresh = np.sort(np.random.default_rng(7).permutation(n)[:-(-n // step)])
    known = np.zeros(n + 1, bool)
    known[n] = True
    while True:
        known[fresh] = True
        while len(fresh):
            fresh = np.unique(edges[fresh])
            fresh = fresh[~known[fresh]]
            known[fresh] = True
        fresh = np.flatnonzero(~known)[::step]
        if not len(fresh):
            return entries
        entries = np.concatenate([entries, fresh])


def build_graph(x: np.ndarray, degree: int = DEGREE, beam: int = BEAM, relax: float = RELAX) -> tuple[np.ndarray, np.ndarray]:
    """Edges (a row per node, filled up with len(x)) and entry nodes: nodes are linked to the pruned nearest ones, and linked back."""
    edges = robust_prune(x, np.arange(len(x)), nearest_nodes(x, beam), degree, relax)
    edges = _linked_back(x, edges, degree + degree // 2, relax)
    return edges, _entries(edges, ENTRY_STEP)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def shard_count(nodes: int, row_bytes: int) -> int:
    """Shards for so many nodes: each holds some `SHARD_GROWTH` times the root of all, so shards grow in number as the root, too."""
    rows = max(SHARD_ROWS, int(SHARD_GROWTH * nodes ** 0.5))
    return max(1, -(-nodes // max(1, min(rows, SHARD_BYTES // row_bytes))))


def search_shard(x: np.ndarray, counts: np.ndarray, ids: np.ndarray, q: np.ndarray, q_ids: np.ndarray, k: int,
                 beam: int = BEAM) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(query ids, found ids, scores) of a shard: the k best rows found for each query.

    Node i holds the `counts[i]` next ids of `ids`, ascending. A node that only the query's own id holds is no candidate.
    """
    unit, length = _unit(x).astype(np.float32), np.sqrt((x * x).sum(1))
    edges, entries = build_graph(unit)
    offset = np.cumsum(counts) - counts
    least, most, kth = ids[offset], ids[offset + counts - 1], min(k, beam) - 1
    step = max(1, min(QUERY_BLOCK, CELLS // (OPENS * edges.shape[1] * x.shape[1])))
    for at in range(0, len(q), step):
        v, own = q[at:at + step], q_ids[at:at + step]
        size = np.sqrt((v * v).sum(1))
        nodes, near = beam_search(unit, edges, entries, _unit(v).astype(np.float32), beam)
        near[(nodes < 0) | ((least[nodes] == own[:, None]) & (most[nodes] == own[:, None]))] = -np.inf
        near = np.where(near >= -np.partition(-near, kth, axis=1)[:, kth:kth + 1] - SLACK, near, -np.inf)
        row, place = np.nonzero(near > -np.inf)
        node = nodes[row, place]
        score = np.einsum("ij,ij->i", np.take(x, node, axis=0), np.take(v, row, axis=0)) / (length[node] * size[row])
        many = counts[node]  # a node stands for all rows that hold its vector
        copy = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        row, score, name = np.repeat(row, many), np.repeat(score, many), ids[np.repeat(offset[node], many) + copy]
        other = name != own[row]
        row, score, name = row[other], score[other], name[other]
        order = np.lexsort((name, -score, row))
        row, score, name = row[order], score[order], name[order]
        found = np.bincount(row, minlength=len(v))
        kept = np.arange(len(row)) - (np.cumsum(found) - found)[row] < k
        yield own[row[kept]], name[kept], score[kept]


def nearest_cosine(vectors: DataFrame, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding",
                   step: int = QUERY_STEP, beam: int = BEAM) -> DataFrame:
    """(query_id, rank, vec_id, score): about the k nearest rows of each query by cosine.

    Queries are the rows whose id is divisible by `step`; a query is not its own candidate. Every
    shard is searched for every query, in blocks of queries; the finds of all shards are ranked by
    the cosine in double precision, ties by the smaller id.

    Equal vectors are one node with their smallest k + 1 ids (as often as they are held), so a vector that very many rows hold
    neither fills a shard nor closes the graph; the ids beyond can be in no result. Shards are a hash of the
    vector. One task holds one shard: it builds the graph and searches it.

    Vectors that are null, empty, zero or hold a null or non-finite component take no part; equal rows
    are each a candidate and each a query; different vectors of one id are each a candidate and, if the id is a query's, each asked for,
    the best finds of all counting; shorter vectors count as padded with zeros;
    fewer than k candidates give all that are found; other columns are ignored.
    """
    spark = vectors.sparkSession
    of = vectors.select(F.col(vector)).schema[0].dataType
    single = isinstance(of, ArrayType) and isinstance(of.elementType, FloatType)  # these travel as they are
    rows = stage(usable(vectors, k, vec_id, vector, "float" if single else "double").filter(F.exists("x", lambda v: v != 0)), "ann-vectors")
    width = rows.agg(F.coalesce(F.max(F.size("x")), F.lit(0))).first()[0]
    if not width:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    smallest = Window.partitionBy("x").orderBy("vec_id")
    nodes = stage(rows.withColumn("n", F.dense_rank().over(smallest)).filter(F.col("n") <= k + 1)
                  .groupBy("x").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")), "ann-nodes")
    shards = shard_count(nodes.count(), width * (4 if single else 8))
    placed = nodes.select(F.pmod(F.xxhash64("x"), F.lit(shards)).cast("int").alias("shard"), "x", "ids", F.lit(False).alias("asks"))
    asked = rows.filter(F.col("vec_id") % step == 0).select(
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), "x", F.array("vec_id").alias("ids"), F.lit(True).alias("asks"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        tab = pa.Table.from_batches(held).combine_chunks()
        shard, asks = tab["shard"].to_numpy(), tab["asks"].to_numpy()
        for own in np.unique(shard):
            mine = tab.filter(pa.array((shard == own) & ~asks)).combine_chunks()
            if not mine.num_rows:
                continue
            ids, q = mine["ids"].combine_chunks(), tab.filter(pa.array((shard == own) & asks)).combine_chunks()
            first = ids.flatten().to_numpy()[ids.offsets.to_numpy()[:-1] - ids.offsets[0].as_py()]
            mine = mine.take(pa.array(np.argsort(first, kind="stable")))  # one graph whatever the order of arrival
            ids = mine["ids"].combine_chunks()
            x = matrix(mine["x"].combine_chunks(), width).astype(np.float64)
            v = matrix(q["x"].combine_chunks(), width).astype(np.float64)
            q_ids = q["ids"].combine_chunks().flatten().to_numpy()
            for found in search_shard(x, ids.value_lengths().to_numpy(), ids.flatten().to_numpy(), v, q_ids, k, beam):
                yield pa.record_batch([pa.array(a) for a in found], names=["query_id", "vec_id", "score"])

    met = placed.unionByName(asked).repartitionById(shards, F.col("shard"))
    return best(met.mapInArrow(search, "query_id long, vec_id long, score double"), k)
