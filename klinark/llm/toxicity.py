"""Toxicity classifier learnt from confirmed toxic texts and unlabelled ones (non-negative PU risk)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from klinark.llm.shared import slices
from klinark.session import stage

TRAINING_ROWS = 20_000  # toxic and unlabelled documents that are learnt from, at most so many of each
WORDS = 2048            # words the classifier looks at, those most typical of toxic texts
STEPS = 600             # gradient steps
SHRINKAGE = 0.02        # penalty on squared weights, shared by the toxic rows: few of them allow small weights only
WORD = regex.compile(r"\p{L}+")


def word_keys(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of the lower-cased runs of letters of a whole text."""
    words = set(WORD.findall((text or "").lower()))
    return np.unique(np.fromiter((xxhash.xxh3_64_intdigest(w) >> 1 for w in words), np.int64, len(words)))


@dataclass
class ToxicModel:
    """A logistic model on the presence of words: sorted word keys, their weights, the intercept."""
    keys: np.ndarray
    weights: np.ndarray
    intercept: float

    def score(self, text: str | None) -> float:
        own = word_keys(text)
        if not len(self.keys) or not len(own):
            total = self.intercept
        else:
            at = np.minimum(np.searchsorted(self.keys, own), len(self.keys) - 1)
            total = self.intercept + self.weights[at[self.keys[at] == own]].sum()
        return float(1 / (1 + np.exp(-np.clip(total, -30, 30))))


def pu_risk(z: np.ndarray, toxic: np.ndarray, prior: float) -> tuple[float, float]:
    """Risk of logits z on toxic rows as such, and the corrected risk of calling unlabelled rows clean (may be negative)."""
    p, u = toxic.astype(bool), ~toxic.astype(bool)
    clean = np.logaddexp(0, z)
    return prior * np.logaddexp(0, -z)[p].mean(), clean[u].mean() - prior * clean[p].mean()


def pu_slope(z: np.ndarray, toxic: np.ndarray, prior: float) -> np.ndarray:
    """Direction of a step for each logit: down the risk, or up its second part where that fell below 0."""
    p, u = toxic.astype(bool), ~toxic.astype(bool)
    s = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    sign = 1.0 if pu_risk(z, toxic, prior)[1] >= 0 else -1.0
    slope = np.zeros(len(z))
    slope[u] += sign * s[u] / u.sum()
    slope[p] -= sign * prior * s[p] / p.sum()
    if sign > 0:
        slope[p] -= prior * (1 - s[p]) / p.sum()
    return slope


def fit(rows: list[np.ndarray], toxic: np.ndarray, keys: np.ndarray, prior: float) -> ToxicModel:
    """Minimise the non-negative risk by gradient steps (Adam) with numpy.

    `rows` has the places of the words of each document in `keys`, `toxic` tells the confirmed
    ones; the others are unlabelled. With l the logistic loss, the risk is
    prior * E_p[l(+)] + max(0, E_u[l(-)] - prior * E_p[l(-)]). Where the second part
    falls below 0 the step goes up its slope, so unlabelled toxic texts are not learnt as clean. Squared
    weights cost SHRINKAGE divided by the number of toxic rows: scores near 0 or 1 need many of them.
    """
    doc = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    word = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    p, u = toxic.astype(bool), ~toxic.astype(bool)
    w, b = np.zeros(len(keys)), float(np.log(prior / (1 - prior)))
    if not p.any() or not u.any():
        return ToxicModel(keys, w, b)
    m, v, shrink = np.zeros(len(keys) + 1), np.zeros(len(keys) + 1), SHRINKAGE / p.sum()
    for step in range(1, STEPS + 1):
        slope = pu_slope(b + np.bincount(doc, w[word], len(rows)), p, prior)
        grad = np.append(np.bincount(word, slope[doc], len(keys)) + shrink * w, slope.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad ** 2
        move = 0.05 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return ToxicModel(keys, w, float(b))


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", doc_id: str = "doc_id", text: str = "text",
          rows: int = TRAINING_ROWS, words: int = WORDS) -> ToxicModel:
    """Choose words and fit weights from bounded samples of toxic and of unlabelled documents.

    The samples are the ids that hash lowest, each with one of its texts (the one whose words sort last), so
    rows that repeat an id neither outweigh others nor come to the driver. The class prior is the share of label 1 among all
    labelled rows. Words are ranked by the z-value of their share of toxic documents against
    their share of unlabelled ones. Without a toxic row every score is the prior.
    """
    own = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y")).filter("y is not null")
    total, ones = own.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0))).first()
    prior = (ones + 1) / (total + 10)
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))

    def lowest(ids: DataFrame) -> DataFrame:
        return ids.filter("doc_id is not null").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)

    confirmed = lowest(own.filter("y = 1").select("doc_id")).withColumn("toxic", F.lit(True))
    unlabelled = lowest(texts.select("doc_id")).withColumn("toxic", F.lit(False))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            keys = pa.array([word_keys(t) for t in batch["text"].to_pylist()], pa.list_(pa.int64()))
            yield pa.record_batch([batch["doc_id"], batch["toxic"], keys], names=["doc_id", "toxic", "words"])

    # two bounded lists of ids
    chosen = texts.join(F.broadcast(confirmed.union(unlabelled)), "doc_id").select("doc_id", "toxic", "text")
    sample = stage(chosen.mapInArrow(split, "doc_id long, toxic boolean, words array<long>")
                   .groupBy("doc_id", "toxic").agg(F.max("words").alias("words")), "toxicity-sample")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words = batch["words"]
            toxic = np.repeat(batch["toxic"].to_numpy(zero_copy_only=False),
                              words.value_lengths().to_numpy(zero_copy_only=False))
            flat = words.flatten().to_numpy(zero_copy_only=False)
            for side in (True, False):
                found, hits = np.unique(flat[toxic == side], return_counts=True)
                yield pa.record_batch([pa.array(found), pa.array(hits * side), pa.array(hits * (not side))],
                                      names=["word", "p", "u"])

    np_, nu = sample.agg(F.count_if("toxic"), F.count_if(~F.col("toxic"))).first()
    totals = sample.mapInArrow(count, "word long, p long, u long").groupBy("word").agg(F.sum("p").alias("p"), F.sum("u").alias("u"))
    share = (F.col("p") + F.col("u")) / F.lit(max(np_ + nu, 1))
    z = ((F.col("p") / F.lit(max(np_, 1)) - F.col("u") / F.lit(max(nu, 1)))
         / F.sqrt(share * (1 - share) * (1 / max(np_, 1) + 1 / max(nu, 1)) + 1e-12))
    best = totals.filter("p >= 5").orderBy(F.desc(F.abs(z)), "word").limit(words).select("word").toPandas()
    keys = np.sort(best["word"].to_numpy(np.int64))
    shared = docs.sparkSession.sparkContext.broadcast(keys)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in slices(batches):
            places = [np.flatnonzero(np.isin(known, own.values.to_numpy())) for own in batch["words"]]
            yield pa.record_batch([batch["doc_id"], batch["toxic"], pa.array(places, pa.list_(pa.int64()))],
                                  names=["doc_id", "toxic", "places"])

    data = sample.mapInArrow(find, "doc_id long, toxic boolean, places array<long>").orderBy("toxic", "doc_id").toPandas()
    return fit([np.asarray(r, np.int64) for r in data["places"]], data["toxic"].to_numpy(bool), keys, prior)


def add_scores(docs: DataFrame, model: ToxicModel, text: str = "text", name: str = "_toxicity") -> DataFrame:
    """Documents with all their columns and the toxicity of their whole text; no row moves.

    A text without words scores what its absence of words says: the model's intercept.
    """
    shared, columns = docs.sparkSession.sparkContext.broadcast(model), docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 200):
            scores = pa.array([shared.value.score(t) for t in batch["_own_text"].to_pylist()], pa.float64())
            yield pa.record_batch([*batch.select(columns).columns, scores], names=[*columns, name])
    kind = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema] + [f"`{name}` double"])
    return docs.withColumn("_own_text", F.col(text).cast("string")).mapInArrow(run, kind)
