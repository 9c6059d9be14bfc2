"""Importance resampling towards a target text: gains per feature bucket, noisy scores, exact distributed selection."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from klinark.llm.shared import slices
from klinark.operators.rows import surrogate_key
from klinark.session import stage

BUCKETS = 10_000
SHARE = 25              # percent of the long enough documents that are drawn
LEAST_WORDS = 20
BATCH_BYTES = 8 << 20   # of texts looked at together
CHUNK_ROWS = 1_000_000  # keys of one partition median
BASE_ROWS = 256         # keys that are sorted instead of halved further
LONG_WORD = 64          # bytes; longer words are hashed one by one


def _word_bytes() -> np.ndarray:
    """Whether a byte belongs to a word: 0-9, a-z and all of multi-byte characters."""
    table = np.zeros(256, bool)
    for first, last in ((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF)):
        table[first:last + 1] = True
    return table


def _lower() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[ord("A"):ord("Z") + 1] += 32
    return table


def _crc_table() -> np.ndarray:
    """Effect of one byte on a CRC-32."""
    zero = zlib.crc32(b"\0", 0xFFFFFFFF)
    return np.array([zlib.crc32(b"\0", 0xFFFFFFFF ^ i) ^ zero for i in range(256)], np.uint32)


WORD_BYTES, LOWER, CRC = _word_bytes(), _lower(), _crc_table()


@lru_cache(maxsize=4096)
def shift_table(length: int) -> np.ndarray:
    """For each byte of a CRC-32, what it becomes when `length` bytes follow: four rows of 256."""
    after = b"\0" * length
    plain = zlib.crc32(after, 0)
    bits = [zlib.crc32(after, 1 << k) ^ plain for k in range(32)]
    table = np.zeros((4, 256), np.uint32)
    for k, moved in enumerate(bits):
        table[k // 8] ^= np.where(np.arange(256) >> (k % 8) & 1, np.uint32(moved), np.uint32(0))
    return table


def word_crcs(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC-32 of each word, one byte of all words at a time; very long words one by one."""
    state = np.full(len(starts), 0xFFFFFFFF, np.uint32)
    order = np.argsort(-np.minimum(lengths, LONG_WORD + 1), kind="stable")
    sizes = lengths[order]
    long = int((sizes > LONG_WORD).sum())
    short = order[long:]
    left = len(short)
    for at in range(int(lengths[short[0]]) if left else 0):
        while left and lengths[short[left - 1]] <= at:
            left = int(np.searchsorted(-sizes[long:], -at, side="left"))
        now = short[:left]
        value = state[now]
        state[now] = CRC[(value ^ data[starts[now] + at]) & 255] ^ (value >> 8)
    out = state ^ np.uint32(0xFFFFFFFF)
    for k in order[:long]:
        out[k] = zlib.crc32(data[starts[k]:starts[k] + lengths[k]].tobytes())
    return out


def feature_buckets(texts: list[bytes | None], buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each feature of each text, and the offsets of the texts in them.

    Words are lower-cased runs of digits, ASCII letters and multi-byte characters; features are all words and all
    pairs of consecutive words joined by a space. A bucket is the CRC-32 of the feature modulo `buckets`: that of a
    pair follows from those of its words, as the checksum is linear.
    """
    joined = LOWER[np.frombuffer(b" ".join(t or b"" for t in texts) + b" ", np.uint8)]
    sizes = np.array([len(t or b"") + 1 for t in texts], np.int64)
    inside = np.concatenate(([False], WORD_BYTES[joined]))
    turns = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = turns[::2], turns[1::2]
    lengths = ends - starts
    owner = np.searchsorted(np.cumsum(sizes), starts, side="right")
    crc = word_crcs(joined, starts, lengths)
    value = crc ^ np.uint32(0xFFFFFFFF)
    spaced = CRC[(value ^ np.uint32(32)) & 255] ^ (value >> 8) ^ np.uint32(0xFFFFFFFF)
    pair = np.flatnonzero(owner[1:] == owner[:-1])
    first, second = spaced[pair], pair + 1
    pair_crc = crc[second].copy()
    kinds, kind = np.unique(lengths[second], return_inverse=True)
    if len(kinds):
        tables = np.stack([shift_table(int(n)) for n in kinds]) if len(kinds) <= 256 else None
        if tables is None:  # very many lengths: one after the other
            for k, n in enumerate(kinds.tolist()):
                at, table = kind == k, shift_table(n)
                pair_crc[at] ^= _shifted(first[at], table[None], np.zeros(int(at.sum()), np.int64))
        else:
            pair_crc ^= _shifted(first, tables, kind)
    place = np.argsort(np.concatenate((owner, owner[pair])), kind="stable")
    found = (np.concatenate((crc, pair_crc)) % np.uint32(buckets)).astype(np.int64)[place]
    words = np.bincount(owner, minlength=len(texts))
    return found, np.concatenate(([0], np.cumsum(words + np.maximum(words - 1, 0))))


def _shifted(values: np.ndarray, tables: np.ndarray, kind: np.ndarray) -> np.ndarray:
    return (tables[kind, 0, values & 255] ^ tables[kind, 1, values >> 8 & 255]
            ^ tables[kind, 2, values >> 16 & 255] ^ tables[kind, 3, values >> 24])


def text_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes | None]]]:
    """Batches of bounded bytes with their texts as bytes; one longer text is a batch of its own."""
    for batch in slices(batches, 2_000):
        texts = batch["t"].to_pylist()
        start = size = 0
        for at, text in enumerate(texts):
            size += len(text or b"")
            if size > BATCH_BYTES and at > start:
                yield batch.slice(start, at - start), texts[start:at]
                start, size = at, len(text or b"")
        if len(texts) > start:
            yield batch.slice(start), texts[start:]


def bucket_counts(rows: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all texts (column t, binary) per bucket, summed in each task before they are shuffled."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for _, texts in text_parts(batches):
            total += np.bincount(feature_buckets(texts, buckets)[0], minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.record_batch([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    summed = rows.select("t").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for row in summed.collect():  # at most one row per bucket
        out[row.bucket] = row.n
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Whole thousandths of the log ratio of target to source share of each bucket, add-one smoothed."""
    s, t, n = source.astype(float), target.astype(float), float(len(source))
    return np.floor(1000 * np.log(((t + 1) * (s.sum() + n)) / ((s + 1) * (t.sum() + n)))).astype(np.int64)


def weighted(rows: DataFrame, gains: np.ndarray) -> DataFrame:
    """(doc_id, n_words, n_features, weight): floored mean gain of the features of each whole text; no row moves."""
    shared = rows.sparkSession.sparkContext.broadcast(gains)  # one number per bucket

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_parts(batches):
            found, offsets = feature_buckets(texts, len(shared.value))
            run = np.concatenate(([0], np.cumsum(shared.value[found])))
            n = np.diff(offsets)
            total = run[offsets[1:]] - run[offsets[:-1]]
            weight = np.where(n > 0, total // np.maximum(n, 1), 0)
            yield pa.record_batch([batch["doc_id"], pa.array((n + 1) // 2), pa.array(n), pa.array(weight)],
                                  names=["doc_id", "n_words", "n_features", "weight"])

    return rows.mapInArrow(score, "doc_id long, n_words long, n_features long, weight long")


def noise(seed: int, doc_id: Column) -> Column:
    """Gumbel noise in whole thousandths, fixed by seed and id; a null id counts as no text."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


ORDER = ("_low", "_id", "_row")  # keys ascend: highest score, then smallest id, then row


def above(key: tuple, inclusive: bool) -> Column:
    """Rows whose key comes before `key` (or is it)."""
    low, name, row = (F.col(c) for c in ORDER)
    last = row <= key[2] if inclusive else row < key[2]
    return (low < key[0]) | ((low == key[0]) & ((name < key[1]) | ((name == key[1]) & last)))


def weighted_median(keys: np.ndarray, weights: np.ndarray) -> tuple:
    """Key up to which half of the weight lies. `keys` has a row per key, columns in order of comparison."""
    order = np.lexsort(keys.T[::-1])
    upto = np.cumsum(weights[order])
    return tuple(int(v) for v in keys[order[np.searchsorted(upto, (upto[-1] + 1) // 2)]])


def cutoff(keys: DataFrame, k: int, chunk: int = CHUNK_ROWS, base: int = BASE_ROWS) -> tuple | None:
    """The k-th key (from 1) of a staged table of distinct keys, by weighted median of medians.

    Each round takes the median of every chunk of keys that are left in a task, and the median of these weighted by
    the sizes of their chunks. At least a quarter of what is left lies on either side, so counting the keys up to
    it discards at least a quarter for certain. The last `base` keys are sorted. What reaches the driver is one key
    per chunk.
    """
    def medians(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def median(parts: list[np.ndarray]) -> pa.RecordBatch:
            rows = np.concatenate(parts)
            key = weighted_median(rows, np.ones(len(rows), np.int64))
            return pa.record_batch([pa.array([v], pa.int64()) for v in (*key, len(rows))], names=[*ORDER, "n"])

        waiting, size = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, chunk):
                rows = np.stack([batch[c].slice(at, chunk).to_numpy() for c in ORDER], 1)
                if size and size + len(rows) > chunk:
                    yield median(waiting)
                    waiting, size = [], 0
                waiting.append(rows)
                size += len(rows)
        if size:
            yield median(waiting)

    left, place = keys.select(*ORDER), k
    total = keys.count()
    if not 0 < k <= total:
        return None
    low, high = None, None  # what is left comes after `low` and not after `high`
    while total > base:
        found = left.mapInArrow(medians, "_low long, _id long, _row long, n long").toPandas()
        pivot = weighted_median(found[list(ORDER)].to_numpy(np.int64), found["n"].to_numpy(np.int64))
        before = left.filter(above(pivot, True)).count()
        if before == place:
            return pivot
        if before > place:
            high, total = pivot, before
        else:
            low, total, place = pivot, total - before, place - before
        left = keys.select(*ORDER)
        left = left.filter(~above(low, True)) if low else left
        left = left.filter(above(high, True)) if high else left
    last = sorted(tuple(r) for r in left.collect())  # at most `base` keys
    return last[place - 1]


def importance_resample(docs: DataFrame, target: DataFrame, share: int = SHARE, least_words: int = LEAST_WORDS, seed: int = 7,
                        doc_id: str = "doc_id", text: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every document; `rank` is null where it is not drawn.

    `share` percent (floored) of the documents with at least `least_words` words are drawn, those of the highest
    scores, ties to the smaller id: a draw without replacement by weight, as Gumbel noise is added. Counts
    cover all texts of both tables.

    A null or empty text has no features and weight 0, and takes part only if `least_words` is 0; a null id
    is scored with the noise of no id and comes after other ids at ties; rows that repeat an id are documents of their own,
    equal ones in the order of their rows; an empty table gives no row; other columns are ignored.
    """
    def texts(df: DataFrame) -> Column:
        return F.col(text).cast("string").cast("binary").alias("t")

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), texts(docs))
    gains = bucket_gains(bucket_counts(rows, buckets), bucket_counts(target.select(texts(target)), buckets))
    scored = weighted(rows, gains).withColumn("score", F.col("weight") + noise(seed, F.col("doc_id")))
    scored = stage(scored.select(
        "doc_id", "n_features", "weight", "score", (F.col("n_words") >= least_words).alias("_fit"), (-F.col("score")).alias("_low"),
        F.coalesce("doc_id", F.lit(2 ** 63 - 1)).alias("_id"), F.monotonically_increasing_id().alias("_row")), "importance-scores")
    fit = scored.filter("_fit")
    last = cutoff(fit, fit.count() * share // 100)
    columns = ["doc_id", "n_features", "weight", "score"]
    if last is None:
        return scored.select(*columns, F.lit(None).cast("long").alias("rank"))
    drawn = F.col("_fit") & above(last, True)
    winners = surrogate_key(scored.filter(drawn), "rank", list(ORDER))
    return (winners.select(*columns, "rank")
            .unionByName(scored.filter(~drawn).select(*columns, F.lit(None).cast("long").alias("rank"))))
