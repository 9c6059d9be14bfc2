"""Surrogate keys survive reloads."""

from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from klinark.operators.keymap import stable_keys
from klinark.plans.standins import load_inputs
from klinark.plans.warehouse import build_gold
from klinark.session import stage, staging_path

SCHEMA = "num string, valeur int, annee int"


def keys(df, name="cle"):
    return {(r.num, r.annee): r[name] for r in df.collect()}


def test_known_rows_keep_their_key_and_new_ones_follow(spark):
    table = "cles_" + staging_path(spark, "t").rsplit("-", 1)[1]
    first = [(str(i), i, 2000 + i % 3) for i in range(50)] + [(None, 1, 2000), ("", 2, 2000)]
    before = keys(stable_keys(spark.createDataFrame(first, SCHEMA).repartition(7), "cle", ["num", "annee"], table))
    assert sorted(before.values()) == list(range(1, 53))
    # a reload in another order, with changed values, rows gone and rows added
    second = [(n, v + 1, y) for n, v, y in reversed(first[:40])] + [(f"n{i}", 0, 2001) for i in range(9)]
    after = keys(stable_keys(spark.createDataFrame(second, SCHEMA).repartition(3), "cle", ["num", "annee"], table))
    assert all(after[n, y] == before[n, y] for n, _, y in first[:40])
    assert sorted(v for k, v in after.items() if k not in before) == list(range(53, 62))
    # rows that were gone come back under the key they had
    again = keys(stable_keys(spark.createDataFrame(first, SCHEMA), "cle", ["num", "annee"], table))
    assert again == before


def test_equal_rows_without_a_key_are_counted(spark):
    table = "cles_" + staging_path(spark, "t").rsplit("-", 1)[1]
    rows = [("a", 1, 2000)] * 1_000 + [("b", 1, 2000)]
    one = stable_keys(spark.createDataFrame(rows, SCHEMA).repartition(4), "cle", None, table).collect()
    assert sorted(r.cle for r in one) == list(range(1, 1_002))
    more = stable_keys(spark.createDataFrame(rows + [("a", 1, 2000)] * 2, SCHEMA), "cle", None, table).collect()
    held = {r.cle for r in one if r.num == "a"}
    assert held < {r.cle for r in more if r.num == "a"} and {1_002, 1_003} == {r.cle for r in more} - {r.cle for r in one}


def test_empty_frames(spark):
    table = "cles_" + staging_path(spark, "t").rsplit("-", 1)[1]
    empty = spark.createDataFrame([], SCHEMA)
    assert stable_keys(empty, "cle", ["num"], table).collect() == []
    assert keys(stable_keys(spark.createDataFrame([("a", 1, 1)], SCHEMA), "cle", ["num"], table)) == {("a", 1): 1}
    assert stable_keys(empty, "cle", ["num"], table).collect() == []


@pytest.mark.parametrize("year", [1999])
def test_reloading_one_year_keeps_every_key(spark, folder, tmp_path, year):
    sources, settings = load_inputs(spark, folder, str(tmp_path))
    settings.gold, settings.staging = "gold_cles", "staging_cles"
    build_gold(spark, sources, settings).collect()
    table = spark.table(f"{settings.gold}.fait_hospitalisation")
    before = {r.hosp_key: r for r in table.collect()}
    sources.stays = sources.stays.filter(f"year(date_entree_typee) = {year}")
    sources.consultations = sources.consultations.filter(f"annee = {year}")
    build_gold(spark, sources, settings).collect()
    spark.catalog.refreshTable(f"{settings.gold}.fait_hospitalisation")
    assert {r.hosp_key: r for r in spark.table(f"{settings.gold}.fait_hospitalisation").collect()} == before


def test_buckets_of_the_map_follow_its_rows(spark, monkeypatch):
    """A reload reads the map bucket by bucket, so a large first load must not be dealt over a fixed number of them."""
    from klinark.operators import keymap
    monkeypatch.setattr(keymap, "BUCKET_ROWS", 10)
    table = "cles_" + staging_path(spark, "t").rsplit("-", 1)[1]
    first = spark.range(205).select(F.col("id").cast("string").alias("num"))
    before = keys_of(stable_keys(first, "cle", ["num"], table))
    assert keymap.map_buckets(spark, table) == 21
    after = keys_of(stable_keys(spark.range(300).select(F.col("id").cast("string").alias("num")), "cle", ["num"], table))
    assert {n: after[n] for n in before} == before and sorted(after.values()) == list(range(1, 301))
    assert spark.table(table).count() == 300 and len(spark.table(table).inputFiles()) <= 2 * 21


def keys_of(df):
    return {r.num: r.cle for r in df.collect()}


def test_rows_travel_without_digests_and_pseudonyms_as_bytes(spark, monkeypatch):
    """Staged rows hold no digest of their own, a reload moves each row once and the map not at all."""
    from klinark.operators import keymap
    seen = {}

    def watched(df, label, *args, **options):
        seen.setdefault(label, (dict(df.dtypes), df._jdf.queryExecution().executedPlan().toString()))
        return stage(df, label, *args, **options)

    monkeypatch.setattr(keymap, "stage", watched)
    table = "cles_" + staging_path(spark, "t").rsplit("-", 1)[1]
    rows = spark.range(400).select(F.sha2(F.col("id").cast("string"), 256).alias("patient_id"), F.col("id").alias("num"))
    rows = rows.unionByName(spark.createDataFrame([(None, 7), (None, 8)], rows.schema))
    natural, known = ["patient_id", "num"], lambda df: {(r.patient_id, r.num): r.cle for r in df.collect()}
    with conf(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"), conf(spark, "spark.sql.adaptive.autoBroadcastJoinThreshold", "-1"):
        first = stable_keys(rows.filter("num < 300"), "cle", natural, table, hexadecimal=("patient_id",))
        again = stable_keys(rows, "cle", natural, table, hexadecimal=("patient_id",))
        before, after = known(first), known(again)
        assert known(stable_keys(rows, "cle", natural, table)) == after  # the map holds the digests of the texts
    assert first.dtypes[0][0] == "cle" and dict(again.dtypes)["patient_id"] == "string"
    assert set(after) == {(r.patient_id, r.num) for r in rows.collect()}
    assert all(after[k] == v for k, v in before.items()) and sorted(after.values()) == list(range(1, 403))
    types, plan = seen["cle-connus"]
    assert keymap.KEY not in types and keymap.KEY not in seen["cle-places"][0] and types["patient_id"] == "binary"
    assert plan.count("Exchange") == 1


def test_rows_without_a_key_travel_with_bytes_too(spark):
    table = "cles_" + staging_path(spark, "t").rsplit("-", 1)[1]
    rows = spark.createDataFrame([("0a" * 32, 1)] * 30 + [("ff" * 32, 1), (None, 1)], "patient_id string, n int")
    one = stable_keys(rows, "cle", None, table, hexadecimal=("patient_id",)).collect()
    two = stable_keys(rows, "cle", None, table, hexadecimal=("patient_id",)).collect()
    assert sorted(r.cle for r in one) == list(range(1, 33)) and sorted(map(tuple, one), key=str) == sorted(map(tuple, two), key=str)


@contextmanager
def conf(spark, name, value):
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)
