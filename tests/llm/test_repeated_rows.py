"""Rows that are repeated very often neither multiply meetings nor change a result."""

from pyspark.sql import functions as F

from klinark.llm import ngram_join


def test_one_row_repeated_many_times(spark):
    base = " ".join(f"w{i}" for i in range(60))
    near = base.replace("w30 ", "x30 ")
    rows = [(1, base), (2, near), (3, "something else altogether here")]
    once = spark.createDataFrame(rows, "doc_id long, text string")
    many = once.union(spark.range(30_000).select(F.lit(1).cast("long").alias("doc_id"), F.lit(base).alias("text")).repartition(8))
    found = {(r.doc_id, r.n_shingles, r.component_id, r["count"]) for r in ngram_join.ngram_components(many, size=3, percent=85)
             .groupBy("doc_id", "n_shingles", "component_id").count().collect()}
    assert found == {(1, 58, 1, 30_001), (2, 58, 1, 1), (3, 2, 3, 1)}


def test_repeated_rows_send_their_set_once(spark):
    import numpy as np
    import pyarrow as pa
    import xxhash

    text = " ".join(f"w{i}" for i in range(20))
    grams = ngram_join.shingle_sets(pa.array([text]), 3)[0]
    cls = xxhash.xxh3_128_digest(grams.tobytes())

    class Shared:
        value = ngram_join._heavy(spark.createDataFrame([], "gram long, hits long"))

    run, _ = ngram_join._sets(3, Shared)
    place = [{"grp": b"g", "block": 0}]
    batch = pa.record_batch({"text": [text] * 5_000, "cls": [cls] * 5_000, "root": [cls] * 5_000, "places": [place] * 5_000})
    out = [b for b in run(iter([batch, batch]))]
    assert sum(b.num_rows for b in out) == 1 and len(np.frombuffer(out[0]["grams"][0].as_py(), np.uint64)) >= len(grams)
