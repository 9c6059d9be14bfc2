"""SimHash near-duplicates: fingerprints meet by equal distances to reference fingerprints, and distances discard pairs."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from klinark.llm.shared import components, slices, whole_groups
from klinark.session import stage

SHINGLE = 4
SEED = 42
DISTANCE = 4          # fingerprints link at so many differing bits or fewer
REFERENCES = 16       # reference fingerprints
SEGMENTS = 6          # parts of a fingerprint that have distances of their own
GROUP_ROWS = 2_048    # fingerprints of one block of a meeting
SHINGLES_AT_ONCE = 65_536


def fingerprint(text: bytes) -> int:
    """64-bit SimHash of a whole UTF-8 text; 0 without words.

    A bit is 1 if it is set in over half of the XXH64 values (seed 42) of the shingles of four
    words, repeats included; a text of fewer words has its word sequence as its only shingle.
    """
    words = text.lower().split()  # on bytes: A-Z only, and the six ASCII blanks
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.concatenate(([0], np.cumsum(lengths + 1)[:-1]))
    ends = starts + lengths
    size = min(SHINGLE, len(words))
    starts, ends = starts[:len(words) - size + 1].tolist(), ends[size - 1:].tolist()
    counts, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for at in range(0, len(starts), SHINGLES_AT_ONCE):
        part = range(at, min(at + SHINGLES_AT_ONCE, len(starts)))
        hashes = np.fromiter((digest(joined[starts[i]:ends[i]], SEED) for i in part), ">u8", len(part))
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(starts)).view(">u8")[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp) of every row: the fingerprint of its whole text as a signed long. No row moves."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 500):
            marks = np.fromiter((fingerprint(t or b"") for t in batch["t"].to_pylist()), np.uint64, batch.num_rows)
            yield pa.record_batch([batch["doc_id"], pa.array(marks.view(np.int64))], names=["doc_id", "fp"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").cast("binary").alias("t"))
    return rows.mapInArrow(run, "doc_id long, fp long")


def reference_fingerprints(count: int = REFERENCES) -> np.ndarray:
    """Reference fingerprints: hashes of their numbers, the same for every table."""
    return np.array([xxhash.xxh64_intdigest(f"reference {i}", SEED) for i in range(count)], np.uint64)


def segment_masks(segments: int = SEGMENTS) -> np.ndarray:
    """Masks of the consecutive segments of 64 bits, their widths at most one apart."""
    cuts = [64 * i // segments for i in range(segments + 1)]
    return np.array([(1 << b) - (1 << a) for a, b in zip(cuts, cuts[1:])], np.uint64)


def distance_table(marks: np.ndarray, references: np.ndarray, masks: np.ndarray) -> np.ndarray:
    """Hamming distance of each segment of each fingerprint to the same segment of each reference.

    Shape (fingerprints, segments, references). By the triangle inequality the largest difference of two
    rows within a segment is at most the distance of the two fingerprints there.
    """
    apart = marks[:, None] ^ references[None, :]
    return np.bitwise_count(apart[:, None, :] & masks[None, :, None])


def lower_bounds(one: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Least possible distance of pairs of fingerprints from their rows of the table."""
    return np.abs(one.astype(np.int8) - others.astype(np.int8)).max(-1).sum(-1, dtype=np.int64)


def near(marks: np.ndarray, table: np.ndarray, at: int, others: np.ndarray, limit: int) -> np.ndarray:
    """Those of `others` within `limit` bits of row `at`: discarded by coordinates first, the rest verified.

    Coordinates are looked at in two steps, whole fingerprints against each reference and then by segment.
    """
    whole = np.abs(table[others].sum(1, dtype=np.int16) - table[at].sum(0, dtype=np.int16)).max(-1)
    left = others[whole <= limit]
    left = left[lower_bounds(table[at][None], table[left]) <= limit]
    return left[np.bitwise_count(marks[left] ^ marks[at]) <= limit]


def links_of_group(marks: np.ndarray, limit: int, references: np.ndarray, masks: np.ndarray) -> tuple[list, list]:
    """A spanning forest of the links of one meeting: (members, the member each hangs on).

    A search from each member not reached yet; every member is compared only with those not reached.
    """
    table = distance_table(marks, references, masks)
    left, child, parent = np.arange(len(marks)), [], []
    while len(left):
        todo, left = [int(left[0])], left[1:]
        while todo and len(left):
            at = todo.pop()
            found = near(marks, table, at, left, limit)
            if len(found):
                child += found.tolist()
                parent += [at] * len(found)
                todo += found.tolist()
                left = left[~np.isin(left, found)]
    return child, parent


def pairs_of_groups(marks: np.ndarray, bounds: np.ndarray, limit: int, references: np.ndarray,
                    masks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs (places) inside each of many groups of few members, all groups at once."""
    end = np.repeat(bounds[1:], np.diff(bounds))
    at, left, right = np.arange(len(marks)), [], []
    for step in range(1, int(np.diff(bounds).max(initial=0))):
        at = at[at + step < end[at]]
        a, b = at, at + step
        table = distance_table(np.concatenate((marks[a], marks[b])), references, masks)
        keep = lower_bounds(table[:len(a)], table[len(a):]) <= limit
        a, b = a[keep], b[keep]
        keep = np.bitwise_count(marks[a] ^ marks[b]) <= limit
        left.append(a[keep])
        right.append(b[keep])
    empty = np.zeros(0, np.int64)
    return np.concatenate([empty, *left]), np.concatenate([empty, *right])


def rooted(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest member of the component of each of n members, by hooking and pointer jumping."""
    root = np.arange(n)
    while len(a):
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        np.minimum.at(root, high, low)
        while not (root == root[root]).all():
            root = root[root]
        open_ = root[a] != root[b]
        a, b = a[open_], b[open_]
    return root


def links(marks: DataFrame, limit: int = DISTANCE, segments: int = SEGMENTS, group_rows: int = GROUP_ROWS,
          few: int = 24) -> DataFrame:
    """(a, b): pairs that connect all distinct fingerprints (column fp) that links connect, and no others.

    Two fingerprints within `limit` bits agree wholly in at least segments - limit segments, so there
    their distances to every reference are equal. A fingerprint therefore goes to one meeting for each choice of
    so many segments, named by its distances there; a linked pair meets at least once. In a meeting the other
    distances discard pairs and the survivors are verified. Only a forest leaves it, each member hung on one of its
    component: work is per pair of distinct fingerprints that meet, output per member.

    A meeting of more than `group_rows` fingerprints is cut into blocks, and each pair of blocks is a task of its own,
    so no task holds a group of unbounded size and no pair is left out.
    """
    if not 0 <= limit < segments:
        raise ValueError(f"{segments} segments cannot find links of {limit} bits")
    references, masks = reference_fingerprints(), segment_masks(segments)
    choices = list(combinations(range(segments), segments - limit))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 10_000):
            own = batch["fp"].to_numpy().view(np.uint64)
            table = distance_table(own, references, masks)
            for number, chosen in enumerate(choices):
                rows = np.ascontiguousarray(table[:, list(chosen), :].reshape(len(own), -1))
                seed = SEED + number
                keys = np.fromiter((xxhash.xxh3_64_intdigest(r.data, seed) for r in rows), np.uint64, len(own))
                yield pa.record_batch([pa.array(keys.view(np.int64)), batch["fp"]], names=["meeting", "fp"])

    meetings = stage(marks.select("fp").mapInArrow(meet, "meeting long, fp long"), "simhash-meetings")
    sizes = meetings.groupBy("meeting").agg(F.count("*").alias("n")).filter("n > 1")
    blocks = F.ceil(F.col("n") / F.lit(group_rows)).cast("int")
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    sent = (meetings.join(sizes, "meeting").withColumn("blocks", blocks).withColumn("own", own)
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .filter("blocks = 1 or own <> other")
            .select("meeting", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "fp"))

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tab, at in whole_groups(batches, ["meeting", "i", "j"]):
            own = np.ascontiguousarray(tab["fp"].to_numpy()).view(np.uint64)
            sizes = np.diff(at)
            small = np.repeat(sizes <= few, sizes)
            places = np.flatnonzero(small)
            bounds = np.concatenate(([0], np.cumsum(sizes[sizes <= few])))
            a, b = pairs_of_groups(own[places], bounds, limit, references, masks)
            root = rooted(len(places), a, b)
            moved = np.flatnonzero(root != np.arange(len(places)))
            child, parent = [places[moved]], [places[root[moved]]]
            for start, end in zip(at[:-1][sizes > few].tolist(), at[1:][sizes > few].tolist()):
                c, p = links_of_group(own[start:end], limit, references, masks)
                child.append(np.array(c, np.int64) + start)
                parent.append(np.array(p, np.int64) + start)
            c, p = np.concatenate(child), np.concatenate(parent)
            if len(c):
                yield pa.record_batch([pa.array(own[c].view(np.int64)), pa.array(own[p].view(np.int64))], names=["a", "b"])

    return (sent.repartition("meeting", "i", "j").sortWithinPartitions("meeting", "i", "j")
            .mapInArrow(solve, "a long, b long").distinct())


def simhash_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", limit: int = DISTANCE) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row.

    `fingerprint` has 16 lower-case hex digits; `component_id` is the smallest doc_id reachable by links of at
    most `limit` differing bits, its own included. Equal fingerprints are one member, so copies cost nothing
    beyond their row.

    A null or empty text has fingerprint zero and is linked like any other; rows that repeat an id each
    keep their own fingerprint; a null id is no component_id, so a component of null ids only has null. An empty table gives no row;
    other columns are ignored, whatever their names.
    """
    marked = stage(fingerprints(docs, doc_id, text), "simhash-fingerprints")
    members = stage(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-members")
    roots = components(links(members, limit), "simhash-links")
    placed = (members.join(roots, F.col("fp") == F.col("node"), "left")
              .select("fp", "least", F.coalesce("root", "fp").alias("root")))
    named = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = placed.join(named, "root").select("fp", "component_id")
    return (marked.join(classes, "fp")
            .select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"))
