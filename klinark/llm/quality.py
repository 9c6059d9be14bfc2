"""Quality classifier: an additive model with pairwise interactions, boosted in cycles over its features."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from klinark.llm.shared import slices

TRAINING_ROWS = 40_000  # labelled rows that are learnt from at most, those of smallest hash
BINS = 32               # bins of a feature
CROSS_BINS = 8          # bins of a feature inside a pair
PAIRS = 10              # interactions kept
CYCLES = 150            # rounds over all features, then over all pairs
RATE = 0.15             # learning rate
SHRINK = 2.0            # weight added to each leaf

FEATURES = ("log_words", "log_bytes", "bytes_per_word", "distinct_words", "upper", "digits", "stops", "symbols",
            "bangs", "bars", "lines", "non_ascii", "repeats", "distinct_lines", "top_word", "distinct_pairs",
            "long_words", "plain_words")


def describe(text: str | None) -> list[float]:
    """The features of a whole text, in the order of FEATURES; all 0 for a text without words."""
    words = (text or "").split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    raw = text.encode()
    count = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    size, letters = len(raw), count[65:91].sum() + count[97:123].sum()
    of = lambda signs: sum(int(count[ord(c)]) for c in signs)
    lines = [line for line in text.split("\n") if line.strip()]
    return [np.log1p(n), np.log1p(size), size / n, len(set(words)) / n, count[65:91].sum() / max(letters, 1),
            count[48:58].sum() / size, of(".,;:?") / n, of("#$%&*@^~<>=+_\\{}[]") / n, of("!") / n, of("|") / n,
            len(lines) / n, count[128:].sum() / size, sum(a == b for a, b in zip(words, words[1:])) / n,
            len(set(lines)) / max(len(lines), 1), Counter(words).most_common(1)[0][1] / n,
            len(set(zip(words, words[1:]))) / n, sum(len(w) > 20 for w in words) / n, sum(w.isalpha() for w in words) / n]


@dataclass
class AdditiveModel:
    """Score = intercept + one table lookup per feature and per pair, as log odds."""
    cuts: list[np.ndarray]
    cross_cuts: list[np.ndarray]
    intercept: float
    tables: np.ndarray
    pairs: list[tuple[int, int]]
    cross_tables: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row of features."""
        total = np.full(len(x), self.intercept)
        for f, table in enumerate(self.tables):
            total += table[np.searchsorted(self.cuts[f], x[:, f], "right")]
        if self.pairs:
            coarse = [np.searchsorted(c, x[:, f], "right") for f, c in enumerate(self.cross_cuts)]
            for (i, j), table in zip(self.pairs, self.cross_tables):
                total += table[coarse[i], coarse[j]]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _cuts(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))


def _best_split(g: np.ndarray, h: np.ndarray) -> tuple[int, float]:
    """Cut of a row of bins with the largest gain."""
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    if not len(left_g):
        return 0, 0.0
    right_g, right_h = g.sum() - left_g, h.sum() - left_h
    gain = left_g ** 2 / (left_h + SHRINK) + right_g ** 2 / (right_h + SHRINK) - g.sum() ** 2 / (h.sum() + SHRINK)
    k = int(np.argmax(gain))
    return k + 1, float(gain[k])


def _shallow_tree(g: np.ndarray, h: np.ndarray, depth: int = 2) -> np.ndarray:
    """Values per bin of a tree of at most `depth` levels over bins in order."""
    at, gain = _best_split(g, h)
    if not depth or gain <= 1e-6:
        return np.full(len(g), g.sum() / (h.sum() + SHRINK))
    return np.concatenate([_shallow_tree(g[:at], h[:at], depth - 1), _shallow_tree(g[at:], h[at:], depth - 1)])


def _cross_tree(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
    """Values and gain of a tree over two features: a cut of one, then cuts of the other on both sides."""
    best, values = 0.0, np.full(g.shape, g.sum() / (h.sum() + SHRINK))
    for a, b, turned in ((g, h, False), (g.T, h.T, True)):
        for at in range(1, a.shape[0]):
            parts, gain = np.empty(a.shape), 0.0
            for side in (slice(0, at), slice(at, None)):
                sg, sh = a[side].sum(axis=0), b[side].sum(axis=0)
                cut, _ = _best_split(sg, sh)
                for part in (slice(0, cut), slice(cut, None)):
                    total, weight = sg[part].sum(), sh[part].sum()
                    gain += total ** 2 / (weight + SHRINK)
                    parts[side, part] = total / (weight + SHRINK)
            if gain > best:
                best, values = gain, parts.T if turned else parts
    return values, best


def fit(x: np.ndarray, y: np.ndarray) -> AdditiveModel:
    """Boost one table per feature in cycles, then one per chosen pair on what remains.

    Each step fits a tree of two levels to the gradient of the log loss on one feature and
    adds a part of it to the feature's table. The pairs are those whose tree gains most.
    Without rows of both labels the model gives the share of label 1 (0.5 without rows).
    """
    features = len(FEATURES)
    share = (y.sum() + 1) / (len(y) + 2)
    model = AdditiveModel([np.zeros(0)] * features, [np.zeros(0)] * features, float(np.log(share / (1 - share))),
                          np.zeros((features, BINS + 1)), [], np.zeros((0, CROSS_BINS + 1, CROSS_BINS + 1)))
    if not len(y) or y.min() == y.max():
        return model
    model.cuts = [_cuts(x[:, f], BINS) for f in range(features)]
    model.cross_cuts = [_cuts(x[:, f], CROSS_BINS) for f in range(features)]
    bins = [np.searchsorted(model.cuts[f], x[:, f], "right") for f in range(features)]
    coarse = [np.searchsorted(model.cross_cuts[f], x[:, f], "right") for f in range(features)]
    total = np.full(len(y), model.intercept)

    def gradient():
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(CYCLES):
        for f in range(features):
            g, h = gradient()
            n = len(model.cuts[f]) + 1
            step = RATE * _shallow_tree(np.bincount(bins[f], g, n), np.bincount(bins[f], h, n))
            model.tables[f, :n] += step
            total += step[bins[f]]

    def cells(i: int, j: int) -> np.ndarray:
        return coarse[i] * (CROSS_BINS + 1) + coarse[j]

    def histogram(where: np.ndarray, weight: np.ndarray) -> np.ndarray:
        return np.bincount(where, weight, (CROSS_BINS + 1) ** 2).reshape(CROSS_BINS + 1, CROSS_BINS + 1)

    g, h = gradient()
    gains = {p: _cross_tree(histogram(cells(*p), g), histogram(cells(*p), h))[1] for p in combinations(range(features), 2)}
    model.pairs = sorted(gains, key=gains.get, reverse=True)[:PAIRS]
    model.cross_tables = np.zeros((len(model.pairs), CROSS_BINS + 1, CROSS_BINS + 1))
    for _ in range(CYCLES // 5):
        for k, pair in enumerate(model.pairs):
            g, h = gradient()
            where = cells(*pair)
            step = RATE * _cross_tree(histogram(where, g), histogram(where, h))[0]
            model.cross_tables[k] += step
            total += step.ravel()[where]
    return model


def features(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, features) of every document's whole text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = pa.array([describe(t) for t in batch["text"].to_pylist()], pa.list_(pa.float64()))
            yield pa.record_batch([batch["doc_id"], rows], names=["doc_id", "features"])
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, features array<double>")


def train(described: DataFrame, labels: DataFrame, label: str = "quality", rows: int = TRAINING_ROWS) -> AdditiveModel:
    """Fit on at most `rows` labelled documents, those whose ids hash lowest.

    `described` has doc_id and features, `labels` doc_id and the label (0 or 1; null is unlabelled).
    """
    chosen = (labels.select(F.col("doc_id").cast("long"), F.col(label).cast("int").alias("y")).filter("y is not null")
              .orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(rows))
    # at most `rows` pairs of numbers
    data = described.join(F.broadcast(chosen), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(rows).toPandas()
    x = np.array(data["features"].tolist(), np.float64).reshape(-1, len(FEATURES))
    return fit(x, data["y"].to_numpy(np.float64))


def score_features(described: DataFrame, model: AdditiveModel) -> DataFrame:
    """(doc_id, score) from described documents."""
    shared = described.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch["features"].flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
            yield pa.record_batch([batch["doc_id"], pa.array(shared.value.score(x))], names=["doc_id", "score"])
    return described.mapInArrow(run, "doc_id long, score double")


def add_scores(docs: DataFrame, model: AdditiveModel, text: str = "text", name: str = "_quality") -> DataFrame:
    """Documents with all their columns and the score of their text; no row moves."""
    shared, columns = docs.sparkSession.sparkContext.broadcast(model), docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            x = np.array([describe(t) for t in batch["_own_text"].to_pylist()], np.float64).reshape(-1, len(FEATURES))
            yield pa.record_batch([*batch.select(columns).columns, pa.array(shared.value.score(x))], names=[*columns, name])
    kind = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema] + [f"`{name}` double"])
    return docs.withColumn("_own_text", F.col(text).cast("string")).mapInArrow(run, kind)


def held_out(parts: int, rest: int):
    """Whether the checksum of the id leaves this remainder; false for a null id."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(parts)) == rest, F.lit(False))
