"""Graphs of the vector search: shards, reach, recall."""

import numpy as np

from klinark.llm import graph_ann


def test_shards_grow_as_the_root_of_the_table():
    """A query meets every shard, so shards as many as the table has blocks of one size would make the work quadratic."""
    assert graph_ann.shard_count(4_096, 256) == 1
    small, large = graph_ann.shard_count(600_000, 256), graph_ann.shard_count(4 * 600_000, 256)
    assert large <= 2 * small + 1 < 60
    assert 32_768 >= 10_000_000 / graph_ann.shard_count(10_000_000, 8 * 128)  # wide vectors: bounded by their bytes


def test_several_shards_find_the_nearest(spark, monkeypatch):
    monkeypatch.setattr(graph_ann, "SHARD_ROWS", 300)
    monkeypatch.setattr(graph_ann, "SHARD_GROWTH", 1)
    draw = np.random.default_rng(3)
    x = draw.normal(size=(2_000, 24))
    x[::7] = x[3] + draw.normal(size=x[::7].shape) * 0.01  # a crowd far from the others
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    assert graph_ann.shard_count(2_000, 96) == 7
    unit = x.astype(np.float32).astype(float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    like = unit @ unit.T
    np.fill_diagonal(like, -2)
    hits, seen = 0, set()
    for r in graph_ann.nearest_cosine(frame).collect():
        seen.add(r.query_id)
        assert abs(like[r.query_id, r.vec_id] - r.score) < 1e-12
        hits += r.score >= np.sort(like[r.query_id])[-5] - 1e-12
    assert seen == set(range(0, 2_000, 50)) and hits >= 0.97 * 5 * len(seen)


def test_every_node_can_be_reached():
    """Crowds closer to each other than to anything else keep no edge to the rest, so each needs an entry."""
    draw = np.random.default_rng(4)
    x = (np.repeat(draw.normal(size=(40, 16)), 50, axis=0) + draw.normal(size=(2_000, 16)) * 1e-3).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    edges, entries = graph_ann.build_graph(x)
    known, fresh = set(entries.tolist()), set(entries.tolist())
    while fresh:
        fresh = set(edges[list(fresh)].ravel().tolist()) - {len(x)} - known
        known |= fresh
    assert len(known) == len(x)
    found, scores = graph_ann.beam_search(x, edges, entries, x[:200])
    assert (np.abs(scores[:, 0] - 1) < 1e-5).all() and (found[:, :5] // 50 == np.arange(200)[:, None] // 50).all()


def test_few_and_collinear_nodes():
    for n in (1, 2, 3, 30):
        x = np.ones((n, 4), np.float32) / 2
        edges, entries = graph_ann.build_graph(x)
        found, scores = graph_ann.beam_search(x, edges, entries, x)
        assert all(sorted(f[f >= 0].tolist()) == list(range(n)) for f in found) and np.allclose(scores[found >= 0], 1)
