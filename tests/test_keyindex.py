"""The key index finds every loaded key and reads only what a batch may hit."""

import pytest
from pyspark.sql import functions as F

from klinark.session import staging_path
from klinark.streaming import keyindex
from klinark.streaming.keyindex import KeyIndex


def batch(spark, index, first, last, extra=()):
    rows = [(str(i), None if i % 7 == 0 else i) for i in range(first, last)] + list(extra)
    return keyindex.keyed(spark.createDataFrame(rows, "num string, jour int"), index, ["num", "jour"])


def files(known):
    """Number of key files that the scan of a plan opens, by its own metric."""
    if known is None:
        return 0
    execution = known._jdf.queryExecution()
    known.collect()
    plan = execution.executedPlan()
    plan.executeCollect()
    leaves, found = plan.collectLeaves(), 0
    for i in range(leaves.size()):
        found += leaves.apply(i).metrics().apply("numFiles").value()
    return found


@pytest.fixture
def index(spark):
    return KeyIndex(staging_path(spark, "index"), buckets=16, pages=2)


def test_every_loaded_key_is_found_and_no_other(spark, index):
    for number in range(4):
        rows = batch(spark, index, number * 100, number * 100 + 100)
        keyindex.add_keys(spark, index, rows, number)
    asked = batch(spark, index, 350, 450, [("350", 999)])
    known = keyindex.known_keys(spark, index, asked, 9)
    met = asked.join(known, ["_cle", "seau"], "left_semi")
    assert sorted(int(r.num) for r in met.collect()) == list(range(350, 400))
    # a batch that is loaded again does not meet its own keys
    again = batch(spark, index, 300, 400)
    own = keyindex.known_keys(spark, index, again, 3)
    assert again.join(own, ["_cle", "seau"], "left_semi").count() == 0


def test_files_read_do_not_grow_with_the_history(spark, index):
    read = []
    for number in range(6):
        fresh = batch(spark, index, number * 50, number * 50 + 50)
        known = keyindex.known_keys(spark, index, fresh, number)
        read.append(files(known))
        keyindex.add_keys(spark, index, fresh, number)
    assert read == [0] * 6 or max(read) <= 6  # new keys hit no bucket but by chance
    one = batch(spark, index, 10, 11)
    known = keyindex.known_keys(spark, index, one, 99)
    bucket = one.first().seau
    places = {r[0] for r in spark.read.parquet(index.keys).filter(F.col("seau") == bucket).select("lot").distinct().collect()}
    assert 0 < files(known) <= len(places)
    assert {r.seau for r in known.collect()} == {bucket}
    plan = known._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "valides" not in plan
    packed = keyindex.compact(spark, index)
    small = keyindex.known_keys(spark, packed, one, 99)
    assert files(small) == 1 and one.join(small, ["_cle", "seau"], "left_semi").count() == 1
    assert len(spark.read.parquet(packed.filters).inputFiles()) <= packed.buckets


def test_full_filters_miss_nothing(spark):
    index = KeyIndex(staging_path(spark, "index"), buckets=2, pages=1, probes=1)
    rows = keyindex.keyed(spark.range(200_000).select(F.col("id").cast("string").alias("num"), F.lit(1).alias("jour")),
                          index, ["num", "jour"])
    keyindex.add_keys(spark, index, rows, 0)
    asked = rows.filter("num % 1000 = 0")
    assert asked.join(keyindex.known_keys(spark, index, asked, 1), ["_cle", "seau"], "left_semi").count() == 200


def test_rebuilt_from_the_loaded_rows(spark, index):
    rows = batch(spark, index, 0, 60).withColumn("lot", F.lit(5))
    keyindex.rebuild(spark, index, rows.drop("_cle", "seau"), ["num", "jour"])
    asked = batch(spark, index, 55, 65)
    assert asked.join(keyindex.known_keys(spark, index, asked, 6), ["_cle", "seau"], "left_semi").count() == 5


def test_empty_batches(spark, index):
    empty = batch(spark, index, 0, 0)
    assert keyindex.known_keys(spark, index, empty, 0) is None
    keyindex.add_keys(spark, index, empty, 0)
    keyindex.add_keys(spark, index, batch(spark, index, 0, 5), 1)
    assert files(keyindex.known_keys(spark, index, empty, 2)) == 0
