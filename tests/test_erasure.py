"""Erasure rewrites the tables that hold a patient, and nothing else."""

import os

import pytest
from pyspark.sql import functions as F

from klinark.functions.privacy import canonical_id, pseudonym
from klinark.plans import erasure
from klinark.plans.standins import MASTER, SEED, load_inputs
from klinark.plans.warehouse import build_gold
from klinark.session import staging_path


@pytest.fixture(scope="module")
def gold(spark, folder, tmp_path_factory):
    sources, settings = load_inputs(spark, folder, str(tmp_path_factory.mktemp("effacement")))
    settings.gold, settings.staging = "gold_efface", "staging_efface"
    build_gold(spark, sources, settings).collect()
    return settings


def files(root, name):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, found in os.walk(f"{root}/{name}")
            for f in found if f.endswith(".parquet")}


def secrets(spark, ids):
    frame = spark.createDataFrame([(i,) for i in ids], "id string")
    return [r[0] for r in frame.select(pseudonym(canonical_id(F.col("id")), MASTER, SEED)).collect()]


def held(spark, settings, ids):
    """Rows of the patients in every place that may hold them."""
    pseudos, root = secrets(spark, ids), settings.root
    table = lambda name: spark.table(f"{settings.gold}.{name}")
    counts = {name: table(name).filter(F.col("patient_id").isin(pseudos)).count()
              for name in ("fait_consultation", "fait_hospitalisation", "dim_patient")}
    counts["mapping"] = spark.read.parquet(f"{root}/secure/patient_mapping").filter(F.col("id_patient_original").isin(ids)).count()
    person = canonical_id(F.get_json_object("ligne_source", "$.id_patient"))
    counts["rejets"] = spark.read.parquet(f"{root}/{settings.staging}/rejets").filter(person.isin(ids)).count()
    return counts


def totals(spark, settings):
    return {name: spark.table(f"{settings.gold}.{name}").count()
            for name in ("fait_consultation", "fait_hospitalisation", "dim_patient", "fait_deces")}


def test_no_table_holds_the_erased_and_other_years_keep_their_files(spark, gold):
    stays = spark.table("gold_efface.fait_hospitalisation")
    years = stays.groupBy("patient_id").agg(F.collect_set("annee").alias("y")).filter(F.size("y") < 5)
    mapping = spark.read.parquet(f"{gold.root}/secure/patient_mapping")
    person = mapping.join(years.limit(1), mapping["id_patient_pseudo"] == years["patient_id"]).first()
    ids = [person.id_patient_original]
    before, rows = held(spark, gold, ids), totals(spark, gold)
    assert before["fait_hospitalisation"] and before["mapping"] == 1
    kept = {f: t for f, t in files(f"{gold.root}/{gold.gold}", "fait_hospitalisation").items()
            if int(f.split("annee=")[1].split("/")[0]) not in person.y}
    report = erasure.erase_from_gold(spark, gold, spark.createDataFrame([(f" {ids[0]} ",), (None,), ("nobody",)], "id_patient string"))
    erased = {}
    for r in report.collect():
        erased[r.cible.split(".")[-1].split("/")[-1]] = erased.get(r.cible.split(".")[-1].split("/")[-1], 0) + r.n_effaces
    assert set(held(spark, gold, ids).values()) == {0}
    assert {k.replace("patient_mapping", "mapping"): v for k, v in erased.items()} == {k: v for k, v in before.items() if v}
    after = totals(spark, gold)
    assert all(after[name] == rows[name] - before.get(name, 0) for name in rows)
    now = files(f"{gold.root}/{gold.gold}", "fait_hospitalisation")
    assert kept and all(now.get(f) == t for f, t in kept.items())
    assert erasure.erase_from_gold(spark, gold, spark.createDataFrame([(ids[0],)], "id_patient string")).collect() == []


@pytest.mark.parametrize("point", ["copy", "swap"])
def test_a_failure_half_way_leaves_readable_tables(spark, gold, monkeypatch, point):
    mapping = spark.read.parquet(f"{gold.root}/secure/patient_mapping")
    visited = spark.table(f"{gold.gold}.fait_consultation").select("patient_id").distinct()
    ids = [mapping.join(visited, F.col("id_patient_pseudo") == F.col("patient_id")).agg(F.max("id_patient_original")).first()[0]]
    rows, patients = totals(spark, gold), spark.createDataFrame([(i,) for i in ids], "id_patient string")
    before = held(spark, gold, ids)
    real, calls = erasure.swap, []

    def broken(spark, target, values, copy):
        calls.append(target.name)
        if len(calls) == (1 if point == "copy" else 2):
            raise OSError("the machine is gone")
        real(spark, target, values, copy)

    monkeypatch.setattr(erasure, "swap", broken)
    with pytest.raises(OSError):
        erasure.erase_from_gold(spark, gold, patients)
    monkeypatch.setattr(erasure, "swap", real)
    found = totals(spark, gold)  # every table can be read, each with all or none of its rows of the patient
    for name in ("fait_consultation", "fait_hospitalisation", "dim_patient"):
        assert found[name] in (rows[name], rows[name] - before[name])
    assert erasure.resume_in_gold(spark, gold) and erasure.resume_in_gold(spark, gold) == []
    erasure.erase_from_gold(spark, gold, patients)
    assert set(held(spark, gold, ids).values()) == {0}
    after = totals(spark, gold)
    assert all(after[name] == rows[name] - before.get(name, 0) for name in rows)


def test_a_year_that_held_nobody_else_is_left_empty(spark):
    name = "effacement_" + staging_path(spark, "t").rsplit("-", 1)[1]
    rows = [("a", 1, 2000), ("a", 2, 2001), ("b", 3, 2001), ("b", 4, 2002), (None, 5, 2001)]
    spark.createDataFrame(rows, "patient_id string, v int, annee int").write.partitionBy("annee").bucketBy(2, "patient_id").saveAsTable(name)
    target = erasure.Target(name, "table", ("annee",), F.col("patient_id"), ("patient_id",), 2)
    report = erasure.erase_from(spark, [target], spark.createDataFrame([("a",), (None,)], "personne string"), staging_path(spark, "journal"))
    assert {(r.partition, r.n_effaces) for r in report.collect()} == {("annee=2000", 1), ("annee=2001", 1)}
    assert sorted(r.v for r in spark.table(name).collect()) == [3, 4, 5]
