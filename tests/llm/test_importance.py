"""Importance resampling against a plain loop, and the distributed selection against sorting."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from klinark.llm import importance
from klinark.session import stage

SCHEMA = "doc_id long, text string, _low string, t int, score string, rank int"


def plain_features(text):
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    return words + [f"{a} {b}" for a, b in zip(words, words[1:])], len(words)


def plain_rows(docs, target):
    def counts(texts):
        out = [0] * 10_000
        for text in texts:
            for feature in plain_features(text)[0]:
                out[zlib.crc32(feature.encode()) % 10_000] += 1
        return out

    s, t = counts(text for _, text in docs), counts(target)
    big_s, big_t = sum(s), sum(t)
    gain = [math.floor(1000 * math.log(((y + 1) * (big_s + 10_000)) / ((x + 1) * (big_t + 10_000)))) for x, y in zip(s, t)]
    rows = []
    for doc, text in docs:
        features, words = plain_features(text)
        weight = sum(gain[zlib.crc32(f.encode()) % 10_000] for f in features) // len(features) if features else 0
        h = int(hashlib.sha256(f"7:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc, len(features), weight, score, None, words])
    fit = sorted((r for r in rows if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, row in enumerate(fit[:len(fit) * 25 // 100], 1):
        row[4] = rank
    return sorted((tuple(r[:5]) for r in rows), key=repr)


def documents(seed=5, n=300):
    draw = random.Random(seed)
    vocabulary = ["Été", "naïve", "日本語", "A1", "x" * 70, *[f"Wort{i}" for i in range(80)]]
    texts = [None, "", "...", "a", "A b", "é-É", "y" * 200_000, "long text " * 40_000, "\x00\x7f a{b}c 9"]
    texts += [" ,;'"[draw.randrange(4)].join(draw.choices(vocabulary, k=draw.choice([5, 19, 20, 60]))) for _ in range(n)]
    rows = list(enumerate(texts, -3)) + [(9, texts[30]), (None, texts[40])]
    draw.shuffle(rows)
    return rows


def test_equals_a_plain_loop(spark):
    docs, target = documents(), [None, "", "Wort1 Wort2 wort3", "Été naïve " * 30]
    frame = spark.createDataFrame([(*r, "clash", 1, "clash", 2) for r in docs], SCHEMA).repartition(5)
    wanted = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    found = importance.importance_resample(frame, wanted)
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert {kind for _, kind in found.dtypes} == {"bigint"}
    assert sorted((tuple(r) for r in found.collect()), key=repr) == plain_rows(docs, target)


def test_buckets_of_many_lengths():
    draw = random.Random(8)
    texts = [" ".join("a" * n for n in range(1, 400)).encode(), b"", None, "é b".encode(),
             " ".join("z" * draw.randint(1, 90) for _ in range(500)).encode()]
    found, offsets = importance.feature_buckets(texts)
    for i, text in enumerate(texts):
        wanted = sorted(zlib.crc32(f.encode()) % 10_000 for f in plain_features((text or b"").decode())[0])
        assert sorted(found[offsets[i]:offsets[i + 1]].tolist()) == wanted


@pytest.mark.parametrize("n,chunk", [(1, 7), (9, 4), (3_000, 100), (3_000, 1_000_000)])
def test_cutoff_equals_sorting(spark, n, chunk):
    draw = random.Random(n)
    keys = [(draw.randrange(-6, 6), draw.randrange(40), i) for i in range(n)]
    table = stage(spark.createDataFrame(keys, "_low long, _id long, _row long").repartition(5), "keys")
    ordered = sorted(keys)
    for k in {1, 2, n // 4, n // 2, n - 1, n}:
        assert importance.cutoff(table, k, chunk=chunk, base=3) == (ordered[k - 1] if 0 < k <= n else None)
    assert importance.cutoff(table, n + 1) is None


def test_equal_rows_are_drawn_up_to_the_share(spark):
    rows = [(1, "same words again and again " * 5)] * 4_000 + [(2, "short")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    ranks = [r.rank for r in importance.importance_resample(frame, frame.limit(3)).collect()]
    assert sorted(r for r in ranks if r) == list(range(1, 1_001)) and len(ranks) == 4_001


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert importance.importance_resample(empty, empty).collect() == []
    one = spark.createDataFrame([(1, "w " * 30)], "doc_id long, text string")
    assert [tuple(r)[4] for r in importance.importance_resample(one, empty).collect()] == [None]


def test_each_round_discards_a_quarter():
    draw = np.random.default_rng(2)
    keys = draw.integers(0, 10 ** 6, (5_000, 3))
    parts = np.array_split(keys, [10, 400, 410, 3_000])
    middle = [importance.weighted_median(p, np.ones(len(p), np.int64)) for p in parts]
    pivot = importance.weighted_median(np.array(middle), np.array([len(p) for p in parts]))
    before = sum(tuple(k) <= pivot for k in keys.tolist())
    assert 1_250 <= before <= 3_750
