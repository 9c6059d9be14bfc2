"""Nodes of the conversation trie against a plain dictionary of prefixes."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from klinark.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, seq string, words int, base int"


def plain_nodes(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32]
            own[conv].append(((turn is not None, turn or 0), digest, role, text))
    turns = {c: [(r, t) for _, _, r, t in sorted(v, key=lambda x: x[:2])] for c, v in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c, mine in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        sign = -1 if c < 0 else 1
        base = c - sign * (abs(c) % 20)
        path = tuple(turns.get(base, [])[:h] + mine[h:])
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
        ends[path].append(c)
    saved, leaves, children = defaultdict(int), defaultdict(int), defaultdict(int)
    for path in members:
        if path:
            children[path[:-1]] += 1
    for path, found in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", path[-1][1])) if path else 0
        for d in range(len(path) + 1):
            saved[path[:d]] += (len(found) - 1) * words
            leaves[path[:d]] += not children[path]
    return sorted(((min(found), len(path), min(members[path[:-1]]) if path else None, len(found), children[path], leaves[path],
                    saved[path], hashlib.sha256(",".join(map(str, sorted(ends[path]))).encode()).hexdigest())
                   for path, found in members.items()), key=repr)


def conversations(seed):
    """Shared beginnings, equal conversations, missing numbers, null fields, repeated rows, a long text."""
    draw = random.Random(seed)
    openings = [("user", "hello there"), ("user", "Hello there"), ("system", ""), (None, None), ("us", "er x"), ("use", "r x")]
    rows = []
    for conv in draw.sample(range(-60, 400), 220):
        kind = draw.random()
        if kind < 0.3:
            turns = [("user", "the same"), ("bot", "as always"), ("user", "bye")]
        else:
            turns = [draw.choice(openings) for _ in range(draw.randint(1, 7))]
        numbers = [None, *range(1, len(turns))] if kind > 0.9 else list(range(len(turns)))
        rows += [(conv, n, *t) for n, t in zip(numbers, turns)]
    rows += [(3, 9, "user", "long " * 50_000), (None, 0, "user", "lost"), (500, None, None, None), rows[0], rows[0]]
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,block", [(1, 20_000), (2, 7), (3, 1)])
def test_equals_plain_prefixes(spark, monkeypatch, seed, block):
    monkeypatch.setattr(prefix_trie, "BLOCK_ROWS", block)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", min(block, 10_000))
    try:
        rows = conversations(seed)
        frame = spark.createDataFrame([(*r, "clash", 1, 2) for r in rows], SCHEMA)
        found = prefix_trie.trie_nodes(frame)
        assert found.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                                 "ends_sha256"]
        assert sorted((tuple(r) for r in found.collect()), key=repr) == plain_nodes(rows)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_one_conversation_in_thousands(spark):
    rows = [(c, t, "user", f"turn {t}") for c in range(6_000) for t in range(3)] + [(7, 3, "user", "and more words")]
    found = sorted((tuple(r) for r in prefix_trie.trie_nodes(
        spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(8)).collect()), key=repr)
    assert found == plain_nodes(rows)


def test_empty_table_and_turnless_root(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert prefix_trie.trie_nodes(spark.createDataFrame([], schema)).collect() == []
    # the one turn of each is taken away and the conversation they begin with is absent
    turnless = [c for c in range(1, 200) if c % 20 and zlib.crc32(str(c).encode()) % 4][:3]
    rows = [(c, 0, "user", "gone") for c in turnless]
    found = [tuple(r) for r in prefix_trie.trie_nodes(spark.createDataFrame(rows, schema)).collect()]
    assert found == plain_nodes(rows) and len(found) == 1


def test_extents_equal_a_plain_walk():
    draw = np.random.default_rng(4)
    values = draw.integers(0, 5, 300)
    table = prefix_trie.RangeMinimum(values)
    at, least = draw.integers(0, 300, 500), draw.integers(0, 6, 500)
    for p, v, right, left in zip(at, least, table.right_extent(at, least), table.left_extent(at, least)):
        r = l = p
        while r + 1 < 300 and values[r + 1] >= v:
            r += 1
        while l > 0 and values[l] >= v:
            l -= 1
        # at the first position there is no value before it to stop at
        assert right == r and (left == l or (l == 0 and left == -1))
    a = np.minimum(at[:250], at[250:])
    b = np.maximum(at[:250], at[250:])
    assert (table.minimum(a, b) == [values[x:y + 1].min() for x, y in zip(a, b)]).all()
