"""The complete load: contents, integrity, reruns, layout, cubes."""

import os

import pytest
from pyspark.sql import functions as F

from klinark.operators.checks import GateFailed
from klinark.operators.layout import (
    analyse, inventory, scanned_bytes, stale_partitions, write_fact, write_partitions,
)
from klinark.operators.profiling import run_summary
from klinark.plans import cubes, kpi
from klinark.plans.registry.steering import DIMS
from klinark.plans.standins import load_inputs, sites, table
from klinark.plans.warehouse import build_gold, integrity
from klinark.schemas import BUCKET_KEYS, DIMENSIONS, FACTS, FORBIDDEN
from klinark.session import staging_path


@pytest.fixture(scope="module")
def load(spark, folder, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("zones"))
    sources, settings = load_inputs(spark, folder, root)
    settings.gold, settings.staging = "gold_test", "staging_test"
    return settings, sources, {r.fait: r for r in build_gold(spark, sources, settings).collect()}


def gold(spark, load, name):
    return spark.table(f"{load[0].gold}.{name}")


def test_every_source_row_is_loaded_rejected_or_duplicate(load):
    for line in load[2].values():
        assert line.bronze == line.charge + line.doublons + line.rejets
        assert line.gold == line.charge and line.ecart == 0
        assert line.rejets > 0


def test_tables_have_the_declared_schema_and_no_personal_data(spark, load):
    for name, columns in {**FACTS, **DIMENSIONS}.items():
        df = gold(spark, load, name)
        assert dict(df.dtypes) == columns and df.count() > 0
        assert not set(df.columns) & set(FORBIDDEN)


def test_inventory_lists_the_columns(spark, load):
    found = {(r.table_name, r.colonne): r.type for r in inventory(spark, load[0].gold).collect()}
    for name, columns in {**FACTS, **DIMENSIONS}.items():
        assert {c: t for (t_name, c), t in found.items() if t_name == name} == columns


def test_run_summary(spark):
    runs = spark.createDataFrame([("q1", "opt", 1, 2.0), ("q1", "opt", 2, 4.0), ("q1", "opt", 3, None)],
                                 "query string, variant string, run int, duration_sec double")
    assert [tuple(r) for r in run_summary(runs).collect()] == [("q1", "opt", 3.0, 2.0, 4.0, 2)]


def test_controls_return_zero(spark, load):
    assert {r.controle: r.n_anomalies for r in integrity(spark, load[0]).collect() if r.n_anomalies} == {}


def test_facts_are_partitioned_by_year(spark, load):
    settings = load[0]
    for name in FACTS:
        folders = os.listdir(f"{settings.root}/{settings.gold}/{name}")
        assert any(f.startswith("annee=") for f in folders)


def test_reload_changes_nothing(spark, load):
    settings, sources, first = load
    before = {name: sorted(gold(spark, load, name).collect()) for name in ("fait_deces", "fait_satisfaction")}
    rejects = spark.read.parquet(f"{settings.root}/{settings.staging}/rejets").count()
    again = {r.fait: r for r in build_gold(spark, sources, settings).collect()}
    assert again == first
    assert spark.read.parquet(f"{settings.root}/{settings.staging}/rejets").count() == rejects
    for name, rows in before.items():
        assert sorted(gold(spark, load, name).collect()) == rows
    assert spark.read.parquet(f"{settings.root}/{settings.staging}/audit").count() == 2 * len(FACTS)


def test_a_failed_gate_stops_the_load(spark, load):
    settings, sources, _ = load
    settings.thresholds = {"part_chargee_pct": ("min", 100.0)}
    try:
        with pytest.raises(GateFailed):
            build_gold(spark, sources, settings)
    finally:
        settings.thresholds = {"ecart_pct": ("max", 0.0)}


def test_cube_adds_up_to_the_fact_and_filters_like_a_group_by(spark, load):
    deaths, geography = gold(spark, load, "fait_deces"), gold(spark, load, "dim_geographie")
    cube = cubes.deaths_cube(deaths, geography)
    assert cube.agg(F.sum("n")).first()[0] == deaths.count()
    unfiltered = cubes.cross_filter(cube, DIMS, {})
    for dim in DIMS:
        found = {r.valeur: r.n for r in unfiltered.filter(F.col("visuel") == dim).collect()}
        assert found == {str(r[dim]): r["sum(n)"] for r in cube.groupBy(dim).sum("n").collect()}


def test_benchmark_questions_return_rows(spark, load):
    stays, patients = gold(spark, load, "fait_hospitalisation"), gold(spark, load, "dim_patient")
    by_patient = kpi.stays_by_sex_and_age(stays, patients, 1999)
    assert by_patient.agg(F.sum("nb")).first()[0] == kpi.total(stays, "nb_hospitalisation", 1999).first()[0] > 0
    assert kpi.deaths_by_region(gold(spark, load, "fait_deces"), gold(spark, load, "dim_geographie"), 1999).count() == 5
    # one row per official region of the marked sites, whatever its spellings in the survey
    marks = gold(spark, load, "fait_satisfaction")
    regions = (sites(spark, "/root/testdata/sf0.001").join(marks, "etab_id").select("region").distinct())
    found = kpi.mean_mark_by_region(marks, gold(spark, load, "dim_etablissement"), 1999)
    assert sorted(r.region for r in found.collect()) == sorted(r.region for r in regions.collect())
    assert found.agg(F.sum("n_sites")).first()[0] == marks.count()


def test_exports(spark, load):
    cube = cubes.deaths_cube(gold(spark, load, "fait_deces"), gold(spark, load, "dim_geographie"))
    path = staging_path(spark, "export")
    cubes.export_cube(cube, path + "-json")
    cubes.export_cube(cube, path + "-csv", "csv")
    for read in (spark.read.json(path + "-json"), spark.read.csv(path + "-csv", header=True)):
        assert read.count() == cube.count() and set(read.columns) == set(cube.columns)


def test_overwriting_a_year_keeps_the_others_and_reports_stale_ones(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", F.year("o_orderdate").alias("annee"))
    path = staging_path(spark, "years")
    write_partitions(orders, path, ["annee"])
    newer = orders.filter("annee = 1999").limit(3)
    write_partitions(newer, path, ["annee"])
    after = spark.read.parquet(path)
    assert after.filter("annee = 1999").count() == 3
    assert after.filter("annee <> 1999").count() == orders.filter("annee <> 1999").count()
    stale = {r.annee for r in stale_partitions(after, newer, "annee").collect()}
    assert 1999 not in stale and 1998 in stale
    one = scanned_bytes(after.filter("annee = 1998")).first().octets
    assert 0 < one < scanned_bytes(after).first().octets


def test_facts_have_their_declared_buckets_and_keep_other_years(spark, load):
    fact = gold(spark, load, "fait_deces")
    write_fact(fact, "deces_petit", BUCKET_KEYS["fait_deces"], 8)
    shown = {r.col_name: r.data_type for r in spark.sql("DESCRIBE EXTENDED deces_petit").collect()}
    assert shown["Num Buckets"] == "8"
    write_fact(fact.filter("annee = 1999").limit(5), "deces_petit", BUCKET_KEYS["fait_deces"], 8)
    after = spark.table("deces_petit")
    assert after.filter("annee = 1999").count() == 5
    assert after.filter("annee <> 1999").count() == fact.filter("annee <> 1999").count()
    fact = after
    analyse(spark, "deces_petit")
    stats = [r.data_type for r in spark.sql("DESCRIBE EXTENDED deces_petit").collect() if r.col_name == "Statistics"]
    assert f"{fact.count()} rows" in stats[0]
