"""SimHash components against a plain loop over all pairs."""

import random
import re

import numpy as np
import pytest
import xxhash

from klinark.llm import simhash

SCHEMA = "doc_id long, text string, fp int, meeting string, t int"


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not words:
        return 0
    size = min(4, len(words))
    values = [xxhash.xxh64_intdigest(" ".join(words[i:i + size]).encode(), 42) for i in range(len(words) - size + 1)]
    return sum(1 << bit for bit in range(64) if 2 * sum(v >> bit & 1 for v in values) > len(values))


def plain_components(rows, limit=4):
    marks = [(doc, plain_fingerprint(text)) for doc, text in rows]
    group = list(range(len(rows)))
    for i, (_, a) in enumerate(marks):
        for j in range(i):
            if (a ^ marks[j][1]).bit_count() <= limit and group[i] != group[j]:
                old, new = max(group[i], group[j]), min(group[i], group[j])
                group = [new if g == old else g for g in group]
    least = {}
    for g, (doc, _) in zip(group, marks):
        if doc is not None:
            least[g] = min(doc, least.get(g, doc))
    return sorted(((doc, f"{mark:016x}", least.get(g)) for g, (doc, mark) in zip(group, marks)), key=repr)


def documents(seed=3):
    """Copies, near copies of long and short texts, empty, null and very long texts, repeated and null ids."""
    draw = random.Random(seed)
    vocabulary = ["Été", "naïve", "日本", *[f"w{i}" for i in range(400)]]
    texts = [None, "", " \t\n", "one", "ONE", "one two three", "É é", "x" * 100_000, " ".join(["again and"] * 60_000)]
    for _ in range(60):
        words = draw.choices(vocabulary, k=draw.choice([3, 20, 300, 1500]))
        texts.append(" ".join(words))
        for _ in range(draw.randint(0, 4)):
            words = list(words)
            words[draw.randrange(len(words))] = draw.choice(vocabulary)
            texts.append(" ".join(words))
    rows = list(enumerate(texts, -5)) + [(7, texts[20]), (7, "other words of one id"), (None, None), (None, "alone and null")]
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("block", [simhash.GROUP_ROWS, 3])
def test_equals_all_pairs(spark, monkeypatch, block):
    rows = documents()
    monkeypatch.setattr(simhash.links, "__defaults__", (4, 6, block, 24))
    frame = spark.createDataFrame([(*r, 1, "clash", 2) for r in rows], SCHEMA).repartition(5)
    found = simhash.simhash_components(frame)
    assert found.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted((tuple(r) for r in found.collect()), key=repr) == plain_components(rows)


def test_clusters_larger_than_a_block(spark):
    """Chains around common centres: every meeting is large, links are few bits wide."""
    draw = random.Random(9)
    marks = set()
    for _ in range(4):
        mark = draw.getrandbits(64)
        for _ in range(220):
            mark ^= sum(1 << b for b in draw.sample(range(64), draw.randint(1, 5)))
            marks.add(mark)
            marks.add(mark ^ (1 << draw.randrange(64)))
    marks = np.array(sorted(marks), np.uint64)
    frame = spark.createDataFrame([(int(m),) for m in marks.view(np.int64)], "fp long")
    edges = simhash.links(frame, group_rows=16).collect()
    place = {int(m): i for i, m in enumerate(marks.view(np.int64))}
    a, b = (np.array([place[e[k]] for e in edges], np.int64) for k in (0, 1))
    left, right = np.nonzero(np.triu(np.bitwise_count(marks[:, None] ^ marks[None, :]) <= 4, 1))
    assert (simhash.rooted(len(marks), a, b) == simhash.rooted(len(marks), left, right)).all()


def test_coordinates_never_discard_a_link():
    draw = np.random.default_rng(1)
    marks = draw.integers(0, 2 ** 64, 500, np.uint64)
    moved = marks.copy()
    for _ in range(4):
        moved ^= np.uint64(1) << draw.integers(0, 64, 500, np.uint64)
    references, masks = simhash.reference_fingerprints(), simhash.segment_masks()
    bounds = simhash.lower_bounds(simhash.distance_table(marks, references, masks),
                                  simhash.distance_table(moved, references, masks))
    assert (bounds <= np.bitwise_count(marks ^ moved)).all()
    assert (np.bitwise_or.reduce(masks) == 2 ** 64 - 1) and np.bitwise_count(masks).sum() == 64


def test_one_fingerprint_in_thousands_of_rows_and_empty_table(spark):
    rows = [(i, "the same few words") for i in range(20_000)] + [(50_000, "and another text here")]
    found = {(r.component_id, r.n) for r in simhash.simhash_components(spark.createDataFrame(rows, "doc_id long, text string"))
             .groupBy("component_id").count().toDF("component_id", "n").collect()}
    assert found == {(0, 20_000), (50_000, 1)}
    assert simhash.simhash_components(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_too_few_segments_are_refused(spark):
    with pytest.raises(ValueError):
        simhash.links(spark.createDataFrame([(1,)], "fp long"), limit=6)
