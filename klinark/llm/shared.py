"""Helpers of the training-data operators: word hashing, sorted groups in Arrow batches, components."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from klinark.session import stage

MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@contextmanager
def small_batches(spark: SparkSession, rows: int):
    """Fewer rows in an Arrow batch, for jobs whose rows hold whole sets or texts."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def mixed(values: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values (finaliser of a multiplicative hash)."""
    values = (values ^ (values >> np.uint64(30))) * MIX[0]
    values = (values ^ (values >> np.uint64(27))) * MIX[1]
    return values ^ (values >> np.uint64(31))


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of each word of each text, and the offsets of the texts in them.

    A-Z is lower-cased; words are runs without ASCII white space. Each distinct word of
    the batch is hashed once. A null text has no word.
    """
    texts = texts.take(pa.array(range(len(texts)))) if texts.offset else texts
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts.cast(pa.large_string()), "")))
    flat = pc.list_flatten(lists)
    encoded = flat.dictionary_encode()
    words = encoded.dictionary.cast(pa.large_binary()).to_pylist()
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words), np.uint64, len(words))
    real = np.fromiter((len(w) > 0 for w in words), bool, len(words))
    codes = encoded.indices.to_numpy(zero_copy_only=False)
    kept = real[codes] if len(words) else np.zeros(0, bool)
    ends = np.concatenate(([0], np.cumsum(kept)))
    offsets = np.concatenate(([0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))))
    return hashes[codes[kept]], ends[offsets]


def shingle_sets(texts: pa.Array, size: int) -> list[np.ndarray]:
    """Sorted distinct hashes of the word n-grams of each text.

    A text with fewer than `size` words has its whole word sequence as the only n-gram;
    a text without words has an empty set.
    """
    words, offsets = word_hashes(texts)
    grams = np.zeros(max(len(words) - size + 1, 0), np.uint64)
    for j in range(size):
        grams = mixed((grams ^ words[j:j + len(grams)]) * MIX[2] + np.uint64(size))
    sets = []
    for start, end in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        if end - start >= size:
            sets.append(np.unique(grams[start:end - size + 1]))
        elif end > start:
            gram = np.zeros(1, np.uint64)
            for j in range(start, end):
                gram = mixed((gram ^ words[j:j + 1]) * MIX[2] + np.uint64(end - start))
            sets.append(gram)
        else:
            sets.append(words[:0])
    return sets


def slices(batches: Iterator[pa.RecordBatch], rows: int = 2000) -> Iterator[pa.RecordBatch]:
    """Smaller batches, to bound what a task holds at once.

    Rows are copied: the split into words does not heed the offset of a slice.
    """
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.take(pa.array(range(start, min(start + rows, batch.num_rows))))


def group_starts(tab: pa.Table, keys: list[str]) -> np.ndarray:
    """Rows of a sorted table at which a group begins."""
    changed = np.zeros(tab.num_rows, bool)
    changed[:1] = True
    for key in keys:
        column = tab[key].combine_chunks()
        changed[1:] |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
    return np.flatnonzero(changed)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Cut sorted batches into tables that hold only whole groups, with the group bounds."""
    waiting: list[pa.Table] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        tab = pa.Table.from_batches([batch])
        cut = int(group_starts(tab, keys)[-1])
        same = waiting and all(waiting[-1][k][-1].as_py() == tab[k][0].as_py() for k in keys)
        if cut == 0 and (same or not waiting):
            waiting.append(tab)
            continue
        ready = pa.concat_tables([*waiting, tab.slice(0, cut)])
        waiting = [tab.slice(cut)]
        if ready.num_rows:
            yield ready, np.append(group_starts(ready, keys), ready.num_rows)
    if waiting:
        ready = pa.concat_tables(waiting)
        yield ready, np.append(group_starts(ready, keys), ready.num_rows)


def bounded_groups(batches: Iterator[pa.RecordBatch], keys: list[str],
                   limit: int) -> Iterator[tuple[pa.Table, np.ndarray | None]]:
    """Like `whole_groups`, but a group that outgrows `limit` rows comes in pieces, with None for the bounds.

    Whatever the size of a group, a task holds about `limit` rows and one batch.
    """
    waiting, in_pieces = None, False  # the rows of the last group so far; of one in pieces only the last row
    for batch in batches:
        if not batch.num_rows:
            continue
        tab = pa.Table.from_batches([batch])
        tab = tab if waiting is None else pa.concat_tables([waiting, tab])
        at = group_starts(tab, keys)
        if in_pieces and len(at) > 1:
            yield tab.slice(0, int(at[1])), None
            tab, at, in_pieces = tab.slice(int(at[1])), at[1:] - at[1], False
        last = int(at[-1])
        if last:
            yield tab.slice(0, last), at
        waiting = tab.slice(last)
        if in_pieces or waiting.num_rows > limit:
            if waiting.num_rows > 1:
                yield waiting.slice(0, waiting.num_rows - 1), None
            waiting, in_pieces = waiting.slice(waiting.num_rows - 1), True
    if waiting is not None:
        yield waiting, None if in_pieces else np.array([0, waiting.num_rows])


def components(edges: DataFrame, label: str) -> DataFrame:
    """Connected components: (node, root) with the smallest node of each component.

    `edges` has columns a and b. Alternates "larger neighbours point to the smallest
    one" and "smaller neighbours point to the smallest one" until no edge changes. Each
    step is an aggregation, combined before its shuffle, and a join back, and is staged
    in the shared folder, so a lost executor costs no earlier step.
    """
    def large(e: DataFrame) -> DataFrame:
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        return (both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                .filter("a <> b").distinct())

    def small(e: DataFrame) -> DataFrame:
        down = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        return moved.union(least.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()

    def state(e: DataFrame):
        return tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())

    current = stage(edges.select("a", "b").filter("a <> b").distinct(), label)
    before = state(current)
    while before[0]:
        current = stage(small(large(current)), label)
        after = state(current)
        if after == before:
            break
        before = after
    return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
