"""Hot keys and runs of equal rows, against brute force on small fixtures."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from klinark.operators import checks
from klinark.operators.joins import event_within, lookup, readmission, resolve_keys
from klinark.operators.rankings import lump_other, share_of_total, top_n_per_group, year_on_year
from klinark.operators.rows import classify, keep_first, surrogate_key

START = datetime.date(2019, 1, 1)


def stays(seed: int, n: int = 600):
    """Stays of few patients; one patient holds a third of them and one day of it many."""
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        patient = 0 if i % 3 == 0 else draw.randrange(1, 40)
        day = 100 if i % 9 == 0 else draw.randrange(0, 400)
        admission = START + datetime.timedelta(days=day)
        length = draw.choice([0, 0, 1, 5, 40, None])
        discharge = None if length is None else admission + datetime.timedelta(days=length)
        rows.append((i, patient, admission, discharge))
    return rows


STAY = "id int, patient int, entree date, sortie date"


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_readmission(spark, seed):
    rows = stays(seed)
    expected = {}
    for patient in {r[1] for r in rows}:
        own = sorted([r for r in rows if r[1] == patient], key=lambda r: (r[2], r[0]))
        for stay, following in zip(own, own[1:] + [None]):
            gap = (following[2] - stay[3]).days if following and stay[3] else None
            expected[stay[0]] = gap is not None and 0 < gap <= 30
    found = readmission(spark.createDataFrame(rows, STAY).repartition(5), "patient", "entree", "sortie", "id", 30, "r")
    assert {r.id: r.r for r in found.collect()} == expected
    assert any(expected.values())


@pytest.mark.parametrize("days", [1, 7, 30])
def test_event_within(spark, days):
    rows, draw = stays(5), random.Random(9)
    events = [(p, START + datetime.timedelta(days=draw.randrange(0, 500))) for p in range(0, 40, 2) for _ in range(4)]
    expected = {r[0]: any(p == r[1] and 0 <= (d - r[2]).days <= days for p, d in events) for r in rows}
    found = event_within(spark.createDataFrame(rows, STAY), spark.createDataFrame(events, "patient int, fin date"),
                         "patient", "entree", "fin", days, "f")
    assert {r.id: r.f for r in found.collect()} == expected
    assert len(set(expected.values())) == 2


def test_surrogate_keys_are_dense_ordered_and_split_equal_rows(spark):
    rows = [("2019-01-01", "75101")] * 4000 + [(f"2019-02-{i % 28 + 1:02d}", f"{i % 90:05d}") for i in range(8000)]
    random.Random(4).shuffle(rows)
    df = spark.createDataFrame(rows, "jour string, lieu string").repartition(6)
    numbered = surrogate_key(df, "cle", ["jour", "lieu"], unique=False)
    found = [(r.jour, r.lieu) for r in numbered.orderBy("cle").collect()]
    assert found == sorted(rows)
    assert numbered.agg(F.min("cle"), F.max("cle"), F.count_distinct("cle")).first()[:] == (1, 12000, 12000)
    assert [c for c in surrogate_key(df, "cle", ["jour", "lieu"], drop=("lieu",),
                                        unique=False).columns] == ["cle", "jour"]


def test_numbering_of_a_unique_order_equals_a_global_row_number(spark):
    rows = [(i * 7919 % 10007, i) for i in range(10000)]
    df = spark.createDataFrame(rows, "a int, b int").repartition(7)
    found = {(r.a, r.b): r.cle for r in surrogate_key(df, "cle", ["a", "b"]).collect()}
    assert found == {row: i for i, row in enumerate(sorted(rows), 1)}


def test_equal_rows_do_not_share_one_range(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame([("a",)] * 9000, "x string")
        ranged = df.withColumn("_split", F.rand(1)).repartitionByRange("x", "_split")
        sizes = [r["count"] for r in ranged.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert max(sizes) < 9000 / 3


def test_first_row_of_a_hot_key(spark, rows):
    data = [(1 if i % 3 else i, i) for i in range(3000)]
    kept = keep_first(spark.createDataFrame(data, "k int, v int").repartition(8), ["k"], [F.desc("v")])
    expected = {}
    for k, v in data:
        expected[k] = max(v, expected.get(k, -1))
    assert rows(kept) == sorted(expected.items(), key=repr)


def test_every_row_is_accounted_for(spark):
    data = [(i % 7 if i % 3 else 0, None if i % 11 == 0 else i) for i in range(2000)]
    df = classify(spark.createDataFrame(data, "k int, v int"), [("NUL", F.col("v").isNull())])
    line = checks.reconcile(df, ["k"]).first()
    assert line.bronze == 2000 and line.charge == 7 and line.ecart == 0
    assert line.rejets == sum(v is None for _, v in data)
    assert line.bronze == line.charge + line.doublons + line.rejets


def test_lookup_gives_the_same_rows_by_broadcast_and_by_shuffle(spark, rows):
    fact = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"))
    dim = spark.range(0, 2000, 2).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    small = rows(lookup(fact, dim, "k"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert rows(lookup(fact, dim, "k")) == small
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_events_of_a_null_key_never_follow(spark):
    day = START
    stay = spark.createDataFrame([(None, day), (1, day), (1, None)], "patient int, jour date")
    events = spark.createDataFrame([(None, day), (1, day)], "patient int, fin date")
    found = event_within(stay, events, "patient", "jour", "fin", 30, "suivi").collect()
    assert sorted((r.patient is None, r.jour is None, r.suivi) for r in found) == [
        (False, False, True), (False, True, False), (True, False, False)]


def test_a_frequent_null_takes_no_place_in_a_top_list(spark):
    df = spark.createDataFrame([(None,)] * 9 + [("a",)] * 5 + [("b",)], "k string")
    assert {r.k: r["count"] for r in lump_other(df, "k", 1).groupBy("k").count().collect()} == {"a": 5, "Autres": 10}


def test_foreign_keys_of_missing_and_unknown_values(spark, rows):
    fact = spark.createDataFrame([("a",), ("z",), (None,)], "fk string")
    dim = spark.createDataFrame([("a",), ("a",), (None,)], "code string")
    assert {r.fk: r.fk_connu for r in resolve_keys(fact, {"fk": (dim, "code")}).collect()} == {
        "a": True, "z": False, None: False}


def test_top_lists_settle_ties_by_key(spark, rows):
    totals = spark.createDataFrame([(1, "b", 5), (1, "a", 5), (1, "c", 9), (2, "a", 1)], "y int, k string, n long")
    assert rows(top_n_per_group(totals, "y", "n", "k", 2).select("y", "k", "rang")) == [
        (1, "a", 2), (1, "c", 1), (2, "a", 1)]
    lumped = lump_other(totals, "k", 1, weight="n").groupBy("k").agg(F.sum("n"))
    assert rows(lumped) == [("Autres", 11), ("c", 9)]
    assert {r.k: r.part_pct for r in share_of_total(totals.filter("y = 1"), "n", 1).collect()} == {
        "a": 26.3, "b": 26.3, "c": 47.4}


def test_change_needs_the_year_before(spark):
    totals = spark.createDataFrame([(2015, 100), (2016, 150), (2018, 10), (2019, 0), (2020, 5)], "a int, n long")
    found = {r.a: r.evolution_pct for r in year_on_year(totals, "a", "n").collect()}
    assert found == {2015: None, 2016: 50, 2018: None, 2019: -100, 2020: None}


def test_rows_dealt_by_number_stay_small_parts(spark):
    """Narrow rows are not merged into parts of many millions by their bytes."""
    from klinark.operators.layout import ROWS_PER_TASK, deal
    rows = 4 * ROWS_PER_TASK
    dealt = deal(spark.range(rows), rows, "id").groupBy("id").agg(F.count("*").alias("n")).filter("n = 1")
    parts = dealt.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(parts) == 4 and sum(r["count"] for r in parts) == rows and max(r["count"] for r in parts) < 1.1 * ROWS_PER_TASK


def test_order_lines_are_dealt_by_their_number(spark, folder, rows, monkeypatch):
    from klinark.plans import standins
    before = rows(standins.visits(spark, folder, with_code=False).select("num_consultation", "line_no", "id_patient"))
    monkeypatch.setattr(standins, "DEALT_FROM", 100)
    dealt = standins.visits(spark, folder, with_code=False).select("num_consultation", "line_no", "id_patient")
    assert "REPARTITION_BY_NUM" in dealt._jdf.queryExecution().executedPlan().toString() and rows(dealt) == before


def test_uniqueness_is_counted_along_the_sort_not_in_a_table_of_all_keys(spark):
    from klinark.operators.checks import check_fact
    fact = spark.range(1_000).select((F.col("id") % 990).alias("k"), F.when(F.col("id") % 100 > 0, F.col("id") % 3).alias("v"))
    checked = check_fact(fact, ["k"], "doublons", {"v_nul": F.col("v").isNull(), "v_un": F.col("v") == 1})
    assert {tuple(r) for r in checked.collect()} == {("doublons", 10), ("v_nul", 10), ("v_un", 330)}
    assert "keys=[k" not in checked._jdf.queryExecution().executedPlan().toString()
    none = check_fact(fact.limit(0), ["k"], "doublons", {"v_nul": F.col("v").isNull()})
    assert {tuple(r) for r in none.collect()} == {("doublons", 0), ("v_nul", 0)}


def test_file_profiles_need_no_sort(spark, tmp_path):
    from klinark.sources.files import profile_files
    for name, text in (("a.csv", "x;y;z\n1;2;3\n4;5;6\n"), ("b.csv", "\n1\n"), ("c.csv", "x,y;z\n1\n"), ("d.csv", "a|b\tc|d\n")):
        (tmp_path / name).write_text(text)
    found = profile_files(spark, str(tmp_path))
    assert "Sort" not in found._jdf.queryExecution().executedPlan().toString()
    assert {(r.file[-5:], r.separator, r.n_columns, r.n_rows) for r in found.collect()} == {
        ("a.csv", ";", 3, 2), ("b.csv", ";", 1, 0), ("c.csv", ";", 2, 1), ("d.csv", "|", 3, 0)}
