"""Prefix trie of conversations: sorted sequences, common-prefix lengths, and range-minimum searches for extents."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from klinark.session import stage

GROUP = 20                 # conversations c with equal c - c % GROUP share a beginning
SHARED = 4                 # of at most SHARED - 1 turns
WORDS = r"[^\x20\x09-\x0D]+"
TURN_BYTES = 16            # of a turn in a sequence: half of its SHA-256
BLOCK_ROWS = 20_000        # sequences of one block
BLOCK_TURNS = 1_000_000    # or so many turns, whichever comes first
NO_ENDS = hashlib.sha256(b"").hexdigest()


def turn_digest(role, text) -> F.Column:
    """Hex digest of a turn; the length of the role keeps (role, text) apart from other splits."""
    return F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * TURN_BYTES)


def sequences(turns: DataFrame) -> DataFrame:
    """(conv_id, digests, words): the turns of each conversation in order, as digests and word counts.

    Texts are digested where they lie and do not travel. Null turns come first; equal turn numbers
    are ordered by digest.
    """
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                        turn_digest(role, text).alias("digest"),
                        F.regexp_count(text, F.lit(WORDS)).cast("long").alias("words")).filter("conv_id is not null")
    return (rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "digest", "words"))).alias("t"))
            .select("conv_id", F.col("t.digest").alias("digests"), F.col("t.words").alias("words")))


def rebuilt(turns: DataFrame) -> DataFrame:
    """(seq binary, conv_id, words): every conversation with its shared beginning put in.

    The first h turns, h = crc32(decimal id) % 4, come from conversation id - id % 20 as it was before, all
    if it has fewer and none if it is absent; then come the own turns after the first h.
    """
    own = sequences(turns).withColumn("h", F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(SHARED)).cast("int"))
    own = own.withColumn("base", F.col("conv_id") - F.col("conv_id") % GROUP)
    heads = (sequences(turns.filter(F.col("conv_id") % GROUP == 0))
             .select(F.col("conv_id").alias("base"), F.slice("digests", 1, SHARED - 1).alias("head"),
                     F.slice("words", 1, SHARED - 1).alias("head_words")))
    joined = own.join(heads, "base", "left")

    def put(head: str, mine: str) -> F.Column:
        first = F.coalesce(F.slice(head, F.lit(1), F.col("h")), F.expr(f"slice({mine}, 1, 0)"))
        return F.concat(first, F.slice(mine, F.col("h") + 1, F.greatest(F.size(mine), F.lit(1))))

    return joined.select(F.unhex(F.array_join(put("head", "digests"), "")).alias("seq"), "conv_id",
                         put("head_words", "words").alias("words"))


class RangeMinimum:
    """Sparse table over an array: the minimum of any interval by two look-ups."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        span = 1
        while 2 * span <= len(values):
            last = self.levels[-1]
            self.levels.append(np.minimum(last[:-span], last[span:]))
            span *= 2

    def minimum(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Minimum of each closed interval."""
        out = np.empty(len(left), self.levels[0].dtype)
        level = np.frexp((right - left + 1).astype(float))[1] - 1
        for k in np.unique(level):
            at = level == k
            out[at] = np.minimum(self.levels[k][left[at]], self.levels[k][right[at] - (1 << int(k)) + 1])
        return out

    def right_extent(self, at: np.ndarray, least: np.ndarray) -> np.ndarray:
        """Last position reached from each `at` while all values after it are `least` or more."""
        at = at.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            level = self.levels[k]
            fits = at + 1 < len(level)
            fits[fits] = level[at[fits] + 1] >= least[fits]
            at[fits] += 1 << k
        return at

    def left_extent(self, at: np.ndarray, least: np.ndarray) -> np.ndarray:
        """First position reached from each `at` while all values from the one after it to `at` are `least` or more."""
        at = at.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            level = self.levels[k]
            fits = at - (1 << k) + 1 >= 0
            fits[fits] = level[at[fits] - (1 << k) + 1] >= least[fits]
            at[fits] -= 1 << k
        return at


def common_turns(flat: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Turns that each sequence shares with the one before it; -1 for the first."""
    lengths = np.diff(offsets)
    shorter = np.minimum(lengths[1:], lengths[:-1])
    starts = np.concatenate(([0], np.cumsum(shorter)))
    step = np.arange(starts[-1]) - np.repeat(starts[:-1], shorter)
    differ = (flat[np.repeat(offsets[:-2], shorter) + step] != flat[np.repeat(offsets[1:-1], shorter) + step]).any(1)
    place = np.where(differ, step, np.repeat(shorter, shorter))
    out = np.zeros(len(shorter), np.int64)
    some = shorter > 0
    if some.any():
        out[some] = np.minimum.reduceat(place, starts[:-1][some])
    return np.concatenate(([-1], out))


def path_keys(seq: bytes) -> list[bytes]:
    """Key of each prefix of a sequence, from the empty one to the whole."""
    state, keys = hashlib.sha256(), []
    for at in range(0, len(seq) + 1, TURN_BYTES):
        keys.append(state.digest())
        state.update(seq[at:at + TURN_BYTES])
    return keys


def border(before: bytes, after: bytes, words: list[int]) -> list[tuple]:
    """What two neighbouring blocks count twice: (key, depth, leaves, children, tokens) to be added.

    `before` ends one block, `after` begins the next one and has the given words per turn. Nodes on both paths began in
    the first block; the last sequence of the first block is no leaf if the next one goes on from it.
    """
    common = 0
    while common < min(len(before), len(after)) and before[common:common + TURN_BYTES] == after[common:common + TURN_BYTES]:
        common += TURN_BYTES
    shared, keys = common // TURN_BYTES, path_keys(before)
    twice = np.concatenate((np.cumsum(words[:shared][::-1])[::-1], [0])).astype(np.int64)  # words from each depth on
    deepest = len(keys) - 1 if common == len(before) else shared
    leaf = -1 if common == len(before) else 0
    return [(keys[d], d, leaf, -1 if d < shared else 0, int(twice[max(d - 1, 0)]) if shared else 0)
            for d in range(deepest + 1)]


NODE = ("kind int, key binary, parent_key binary, depth long, conv_id long, parent_conv_id long, n_convs long, "
        "n_children long, n_leaves long, saved_tokens long, ends_sha256 string, ids string, part long, "
        "first binary, last binary, first_words array<long>")
NAMES = [field.split(" ")[0] for field in NODE.split(", ")]
INNER, OPEN, ENDS, EDGE = 0, 1, 2, 3


def rows_of(kind: int, n: int, **columns) -> pa.RecordBatch:
    """A batch of NODE rows; columns that are not given are null."""
    types = {"string": pa.string(), "binary": pa.binary(), "long": pa.int64(), "int": pa.int32(),
             "array<long>": pa.list_(pa.int64())}
    kinds = [types[field.split(" ")[1]] for field in NODE.split(", ")]
    columns["kind"] = [kind] * n
    return pa.record_batch([pa.array(columns[name], t) if name in columns else pa.nulls(n, t)
                            for name, t in zip(NAMES, kinds)], names=NAMES)


def block_nodes(seqs: pa.Array, ids: np.ndarray, words: pa.Array) -> Iterator[pa.RecordBatch]:
    """Nodes of one block of sorted (sequence, id) rows.

    Each row proposes the prefixes longer than what it shares with the row before it. A prefix searches the sparse
    table of common lengths for its right extent, and its parent for both extents, each on its own. The rows
    between are its members. Nodes that touch neither end of the block are final (INNER). Those on the first or last path
    may go on in a neighbouring block and carry parts that add up (OPEN).
    """
    n = len(ids)
    raw = b"".join(seqs.to_pylist())
    lengths = np.array([len(s) // TURN_BYTES for s in seqs.to_pylist()], np.int64)
    offsets = np.concatenate(([0], np.cumsum(lengths)))
    flat = np.frombuffer(raw, np.uint64).reshape(-1, TURN_BYTES // 8)
    counts = words.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    upto = np.concatenate(([0], np.cumsum(counts)))
    lcp = common_turns(flat, offsets)
    shared = np.maximum(lcp, 0)
    own = lengths - shared                            # prefixes that begin at each row
    begin = np.concatenate(([0], np.cumsum(own)))
    row = np.repeat(np.arange(n), own)
    depth = np.arange(begin[-1]) - np.repeat(begin[:-1], own) + shared[row] + 1

    table = RangeMinimum(lcp)
    right = table.right_extent(row, depth)
    up = table.left_extent(row, depth - 1)            # where the parent begins
    up[depth == 1] = 0
    parent = np.where(depth > 1, begin[up] + depth - 2 - shared[up], -1)

    ends_here = np.concatenate((lcp[1:] < lengths[:-1], [True]))     # no later row goes on from this one
    leaves = np.concatenate(([0], np.cumsum(ends_here)))
    total = upto[offsets[1:]] - upto[offsets[:-1]]
    totals = np.concatenate(([0], np.cumsum(total)))
    before = upto[offsets[row] + depth - 1] - upto[offsets[row]]     # words above the node's own turn
    fresh = np.concatenate(([0], np.cumsum(counts[offsets[row] + depth - 1])))
    members = right - row + 1
    saved = (totals[right + 1] - totals[row] - members * before) - (fresh[begin[right + 1]] - fresh[:-1])
    children = np.bincount(parent[parent >= 0], minlength=len(row))
    least = RangeMinimum(ids).minimum(row, right) if n else ids

    first, last = seqs[0].as_py(), seqs[n - 1].as_py()
    first_keys, last_keys = path_keys(first), path_keys(last)
    open_left, open_right = row == 0, right == n - 1
    is_open = open_left | open_right

    # conversations that end at a node: the run of rows equal to its sequence
    new_run = np.concatenate(([True], (lcp[1:] < lengths[1:]) | (lengths[1:] != lengths[:-1])))
    run = np.append(np.flatnonzero(new_run), n)
    text = [",".join(map(str, ids[a:b].tolist())) for a, b in zip(run[:-1], run[1:])]
    run_of = np.cumsum(new_run) - 1
    terminal = depth == lengths[row]

    inner = np.flatnonzero(~is_open)
    over_open = np.where(parent >= 0, is_open[np.maximum(parent, 0)], True)
    parent_depth = depth - 1
    parent_left = np.where(parent >= 0, open_left[np.maximum(parent, 0)], True)

    def key_of(depths, lefts) -> list[bytes]:
        return [first_keys[d] if left else last_keys[d] for d, left in zip(depths.tolist(), lefts.tolist())]

    if len(inner):
        hung = over_open[inner]
        known = iter(key_of(parent_depth[inner][hung], parent_left[inner][hung]))
        keys = [next(known) if h else None for h in hung.tolist()]
        ends = [hashlib.sha256(text[run_of[r]].encode()).hexdigest() if t else NO_ENDS
                for r, t in zip(row[inner].tolist(), terminal[inner].tolist())]
        above = pa.array(least[np.maximum(parent[inner], 0)], mask=hung)
        yield rows_of(INNER, len(inner), parent_key=keys, depth=depth[inner], conv_id=least[inner],
                      parent_conv_id=above, n_convs=members[inner], n_children=children[inner],
                      n_leaves=(leaves[right + 1] - leaves[row])[inner], saved_tokens=saved[inner], ends_sha256=ends)

    outer = np.flatnonzero(is_open)
    # the root holds the whole block
    yield rows_of(OPEN, len(outer) + 1,
                  key=[first_keys[0], *key_of(depth[outer], open_left[outer])],
                  parent_key=[None, *key_of(depth[outer] - 1, open_left[outer])],
                  depth=np.append(0, depth[outer]), conv_id=np.append(ids.min(), least[outer]),
                  n_convs=np.append(n, members[outer]), n_children=np.append((depth == 1).sum(), children[outer]),
                  n_leaves=np.append(leaves[-1], (leaves[right + 1] - leaves[row])[outer]),
                  saved_tokens=np.append(totals[-1] - fresh[-1], saved[outer]))
    runs = [(row[k], key) for k, key in zip(outer.tolist(), key_of(depth[outer], open_left[outer])) if terminal[k]]
    runs += [(0, first_keys[0])] if lengths[0] == 0 else []
    yield rows_of(ENDS, len(runs), key=[key for _, key in runs], conv_id=[int(ids[run[run_of[r]]]) for r, _ in runs],
                  ids=[text[run_of[r]] for r, _ in runs])


def corrections(rows: list[tuple]) -> pa.RecordBatch:
    """Border rows as parts of open nodes."""
    return rows_of(OPEN, len(rows), key=[r[0] for r in rows], depth=[r[1] for r in rows], n_leaves=[r[2] for r in rows],
                   n_children=[r[3] for r in rows], saved_tokens=[r[4] for r in rows], n_convs=[0] * len(rows))


def find_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of one sorted partition, block by block, and its first and last sequence (EDGE)."""
    waiting: list[pa.RecordBatch] = []
    edge: list = []

    def close() -> Iterator[pa.RecordBatch]:
        tab = pa.Table.from_batches(waiting).combine_chunks()
        seqs, words = tab["seq"].chunk(0), tab["words"].chunk(0)
        first, first_words = seqs[0].as_py(), words[0].as_py()
        if edge:
            yield corrections(border(edge[1], first, first_words))
        else:
            edge[:] = [first, None, first_words]
        edge[1] = seqs[len(seqs) - 1].as_py()
        yield from block_nodes(seqs, tab["conv_id"].to_numpy(), words)

    rows = turns = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        waiting.append(batch)
        rows, turns = rows + batch.num_rows, turns + len(batch["words"].flatten())
        if rows >= BLOCK_ROWS or turns >= BLOCK_TURNS:
            yield from close()
            waiting, rows, turns = [], 0, 0
    if waiting:
        yield from close()
    if edge:
        yield rows_of(EDGE, 1, part=[TaskContext.get().partitionId()], first=[edge[0]], last=[edge[1]], first_words=[edge[2]])


def joined_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hash of the ids of each key, read as sorted pieces one after the other."""
    key, state = None, None
    for batch in batches:
        found: list[tuple[bytes, str]] = []
        for k, ids in zip(batch["key"].to_pylist(), batch["ids"].to_pylist()):
            if k == key:
                state.update(b"," + ids.encode())
                continue
            if state is not None:
                found.append((key, state.hexdigest()))
            key, state = k, hashlib.sha256(ids.encode())
        yield pa.record_batch([pa.array([f[0] for f in found], pa.binary()), pa.array([f[1] for f in found], pa.string())],
                              names=["key", "ends"])
    if state is not None:
        yield pa.record_batch([pa.array([key], pa.binary()), pa.array([state.hexdigest()])], names=["key", "ends"])


def trie_nodes(conversations: DataFrame) -> DataFrame:
    """One row per node of the prefix trie of the rebuilt conversations.

    Columns conv_id (smallest member), depth, parent_conv_id (null at the root), n_convs, n_children, n_leaves,
    saved_tokens and ends_sha256. Turns are ordered by number, null first, equal numbers by digest; a null role or text is
    empty; rows without a conv_id take no part; repeated rows are turns of their own; an empty table gives no
    node; other columns are ignored. A turn counts as equal when half of its SHA-256 is.

    Rebuilt sequences are range-partitioned on (sequence, id), so equal conversations, however many, are spread over tasks.
    A conversation is one row of about 24 bytes a turn. Each sorted block finds its nodes alone; only the
    paths at block ends are added up over blocks.
    """
    ordered = rebuilt(conversations).repartitionByRange("seq", "conv_id").sortWithinPartitions("seq", "conv_id")
    found = stage(ordered.select("seq", "conv_id", "words").mapInArrow(find_nodes, NODE), "trie-nodes", ("kind",))

    # one row per partition of the range partitioning
    edges = found.filter(F.col("kind") == EDGE).select("part", "first", "last", "first_words")
    neighbours = edges.withColumn("before", F.lag("last").over(Window.orderBy("part"))).filter("before is not null")

    def stitch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for before, after, words in zip(*[batch[c].to_pylist() for c in ("before", "first", "first_words")]):
                yield corrections(border(before, after, words))

    stitched = neighbours.select("before", "first", "first_words").mapInArrow(stitch, NODE)
    pieces = found.filter(F.col("kind") == ENDS).select("key", "conv_id", "ids")
    ends = (pieces.repartition("key").sortWithinPartitions("key", "conv_id").select("key", "ids")
            .mapInArrow(joined_ends, "key binary, ends string"))
    sums = [F.sum(c).cast("long").alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    open_nodes = (found.filter(F.col("kind") == OPEN).select(*NAMES).unionByName(stitched)
                  .groupBy("key", "depth").agg(F.min("conv_id").alias("conv_id"), F.max("parent_key").alias("parent_key"), *sums))
    open_nodes = stage(open_nodes.join(ends, "key", "left"), "trie-open")

    above = open_nodes.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("above"))
    columns = ["conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    inner = found.filter(F.col("kind") == INNER)
    outer = open_nodes.withColumn("ends_sha256", F.coalesce("ends", F.lit(NO_ENDS)))
    hung = (inner.filter("parent_key is not null").select("parent_key", *columns)
            .unionByName(outer.select("parent_key", *columns)).join(above, "parent_key", "left"))
    return (inner.filter("parent_key is null").select(F.col("parent_conv_id").alias("above"), *columns)
            .unionByName(hung.select("above", *columns))
            .select("conv_id", "depth", F.col("above").alias("parent_conv_id"), *columns[2:]))
