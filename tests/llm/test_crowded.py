"""N-grams outside the frequent list with many members, and one id with many texts."""

import random

import pyarrow as pa
import pytest

from klinark.llm import ngram_join
from klinark.llm.ngram_join import ngram_components
from klinark.llm.shared import bounded_groups
from klinark.llm.sharding import shard_documents


@pytest.mark.parametrize("rows", [1, 3, 7, 50])
@pytest.mark.parametrize("limit", [1, 4, 100])
def test_groups_come_whole_or_in_pieces(rows, limit):
    draw = random.Random(rows * limit)
    keys = [k for k in range(12) for _ in range(draw.choice([1, 2, 5, 30]))]
    batches = [pa.record_batch([pa.array(keys[i:i + rows]), pa.array(range(i, min(i + rows, len(keys))))], names=["k", "at"])
               for i in range(0, len(keys), rows)]
    seen, pieces = [], set()
    for tab, bounds in bounded_groups(iter(batches), ["k"], limit):
        own = tab["k"].to_pylist()
        seen += tab["at"].to_pylist()
        assert tab.num_rows <= limit + rows + 30 or bounds is not None
        if bounds is None:
            assert len(set(own)) == 1
            pieces.add(own[0])
        else:
            assert bounds[0] == 0 and bounds[-1] == len(own)
            for a, b in zip(bounds[:-1], bounds[1:]):
                assert own[a:b] == [own[a]] * keys.count(own[a])
    assert seen == list(range(len(keys)))
    assert all(keys.count(k) > limit for k in pieces)
    assert list(bounded_groups(iter([]), ["k"], limit)) == []


def brute_force(texts, size, percent):
    sets = []
    for text in texts:
        words = text.lower().split()
        sets.append({tuple(words[i:i + size]) for i in range(max(len(words) - size + 1, 1))} if words else set())
    label = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                low, high = sorted((label[a], label[b]))
                label = [low if x == high else x for x in label]
    return label


def test_crowded_ngrams_outside_the_list_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "HEAVY_GRAMS", 0)
    monkeypatch.setattr(ngram_join, "GROUP_ROWS", 6)
    monkeypatch.setattr(ngram_join, "BATCH_ROWS", 5)
    levels, real = [], ngram_join.stage
    monkeypatch.setattr(ngram_join, "stage", lambda df, label, *rest: levels.append(label) or real(df, label, *rest))
    draw, texts = random.Random(7), []
    passage = [f"p{k}" for k in range(20)]  # all share it, few are alike
    for k in range(150):
        own = [f"w{draw.randrange(60)}" for _ in range(draw.choice([1, 1, 2, 12]))]
        texts.append(" ".join(passage + own if k % 2 else own + passage))
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.component_id for r in ngram_components(docs, 3, 80).collect()}
    assert [got[k] for k in range(len(texts))] == brute_force(texts, 3, 80)
    assert "ngram-crowded-1" in levels


def test_one_id_with_many_texts_is_numbered_in_order(spark):
    rows = [(5, "a" * (k % 40) + str(k % 90)) for k in range(400)] + [(None, str(k)) for k in range(30)]
    rows += [(k, "same") for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = shard_documents(docs, 2).collect()
    assert len(got) == len(rows)
    for shard in {r.shard for r in got}:
        slots = sorted((r for r in got if r.shard == shard), key=lambda r: r.slot)
        assert [r.slot for r in slots] == list(range(len(slots)))
        hot = [(r["size"], r.text_crc32) for r in slots if r.doc_id == 5]
        assert hot == sorted(hot)
