"""Gates against the load before, and lines that are followed from the files to the facts."""

import os

import pytest
from pyspark.sql import functions as F

from klinark.operators.checks import GateFailed
from klinark.operators.layout import ensure_zones
from klinark.operators.rows import REASON
from klinark.plans import facts, files
from klinark.plans.files import TextFile
from klinark.plans.standins import load_inputs
from klinark.plans.warehouse import Sources, build_gold, classified, load_fact, stage_source
from klinark.session import staging_path

MARKS = "etab_id string, geo_id string, note int, annee int"


@pytest.fixture
def settings(spark, folder, tmp_path):
    _, settings = load_inputs(spark, folder, str(tmp_path))
    suffix = staging_path(spark, "x").rsplit("-", 1)[1]
    settings.gold, settings.staging = f"gold_{suffix}", f"staging_{suffix}"
    ensure_zones(spark, settings.root, (settings.staging, settings.gold))
    return settings


def load(spark, settings, rows, known=("a", "b", "c")):
    source = spark.createDataFrame(rows, MARKS)
    staged = stage_source("fait_satisfaction", classified(source, [("NOTE_NEGATIVE", F.col("note") < 0)]))
    build = lambda valid: valid.select((F.col("annee") * 10000 + 101).alias("date_id"), "etab_id", "geo_id",
                                       F.col("note").cast("decimal(3,1)").alias("note_satisfaction"), "annee")
    return load_fact(spark, "fait_satisfaction", staged, build, ["etab_id", "annee"], ["etab_id"], settings,
                     dims={"etab_id": spark.createDataFrame([(k,) for k in known], "etab_id string")}).first()


def table(spark, settings):
    return sorted((r.etab_id, r.annee) for r in spark.table(f"{settings.gold}.fait_satisfaction").collect())


def rows(n, year=2019, first=0):
    return [("abc"[i % 3], "01", i % 10, year + i // 3) if first == 0 else (f"x{i}", "01", 1, year) for i in range(n)]


def test_a_load_that_shrinks_is_stopped(spark, settings):
    many = [("abc"[i % 3], "01", 5, 2000 + i // 3) for i in range(60)]
    load(spark, settings, many)
    before = table(spark, settings)
    fewer = [r for r in many if r[3] > 2003 or r[0] == "a"]  # 8 of 60 rows are gone from years that are loaded again
    with pytest.raises(GateFailed, match="variation_pct"):
        load(spark, settings, fewer)
    assert table(spark, settings) == before
    load(spark, settings, many[:-5])  # a year less 2 rows and one year not delivered: 2 of 57 rows of the loaded years
    load(spark, settings, [("a", "01", 5, 2030)])  # a new year is no change
    audit = spark.read.parquet(f"{settings.root}/{settings.staging}/audit").groupBy("statut").count().collect()
    assert {r[0]: r[1] for r in audit} == {"SUCCESS": 3, "FAILED": 1}


def test_a_load_of_unknown_members_is_stopped(spark, settings):
    good = [("abc"[i % 3], "01", 5, 2000 + i // 3) for i in range(30)]
    with pytest.raises(GateFailed, match="taux_min_pct"):
        load(spark, settings, good, known=("a", "b"))
    assert not spark.catalog.tableExists(f"{settings.gold}.fait_satisfaction")
    load(spark, settings, good)


def test_a_load_of_few_valid_rows_is_stopped_where_asked(spark, settings):
    settings.thresholds["part_chargee_pct"] = ("min", 80.0)
    bad = [("a", "01", -1, 2000), ("b", "01", 5, 2000), ("c", "01", 5, 2000)]
    with pytest.raises(GateFailed, match="part_chargee_pct"):
        load(spark, settings, bad)


def write(path, name, lines):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{name}.csv", "w", encoding="utf-8") as out:
        out.write("\n".join(lines) + "\n")


def test_every_line_of_planted_files_is_accounted_for(spark, settings, folder, tmp_path):
    root = str(tmp_path / "fichiers")
    stay = lambda num, who, site, day, length: f"{num};{who};{site};S52;;{day};{length}"
    head = "Num;Id;Org;Code;Suite;Date;Jour"
    write(f"{root}/stays", "a", [head, stay(1, "p1", "s1", "01/02/1999", 3), stay(1, " p1", "s1", "01/02/1999", 3),
                                 stay(2, "p2", "s2", "32/02/1999", 3), "3;p3", "", stay(4, "p4", "s1", "05/03/1999", 2) + ";x"])
    write(f"{root}/stays", "b", [head, stay(5, "", "s1", "05/03/1999", 2), stay(6, "p6", "s2", "05/03/1999", -1), stay(7, "p1", "s2", "05/03/1998", 4)])
    visit = lambda num, who, pro, day: f"{num};m;{who};{pro};S52;rien;{day};08:00:00;08:30:00"
    write(f"{root}/visits", "a", ["h;h;h;h;h;h;h;h;h", visit(1, "p1", "d1", "1999-01-01"), visit(1, "p1", "d1", "1999-01-01"),
                                  visit(2, "", "d1", "1999-01-01"), visit(3, "p9", "d1", "1970-01-01"), "x;y"])
    write(f"{root}/surveys", "a", [";".join(["h"] * 9), "E1;x;s1;Site;AFRICA;;;3;80,5", "E1;x;s1;Site;AFRICA;;;3;81", "E2;x;s2;Deux;AFRICA;;;3;",
                                   "E2;x;s2;Deux;AFRICA;;;3;abc", "E3;court", "E9;x;s9;Neuf;AFRICA;;;3;50"])
    death = lambda day, act: f"N,P,1,1930-01-01,01001,,,{day},01001,{act}"
    write(f"{root}/deaths", "a", [",".join(["h"] * 10), death("1999-05-05", "a1"), death("1999-05-05", "a1"), death("X", "a2"), "N,P"])
    places = {name: TextFile(f"{root}/{name}", sep) for name, sep in (("stays", ";"), ("visits", ";"), ("surveys", ";"), ("deaths", ","))}
    full, _ = load_inputs(spark, folder, str(tmp_path))
    sources = Sources(
        consultations=files.read_consultations(spark, places["visits"]), stays=files.read_stays(spark, places["stays"]),
        surveys=files.read_one_campaign(spark, places["surveys"]), deaths=files.read_deaths(spark, places["deaths"]),
        departments=full.departments, patients=full.patients,
        professionals=spark.createDataFrame([("d1", "M", "1")], "identifiant string, categorie_professionnelle string, code_specialite string"),
        specialties=full.specialties, sites=spark.createDataFrame([("s1",), ("s2",)], "etab_id string"))
    settings.consultation_key, settings.consultation_order = tuple(facts.CONSULTATION_KEY), facts.CONSULTATION_ORDER
    settings.stay_order = ("identifiant_organisation", "code_diagnostic", "jours")
    found = {r.fait: r for r in build_gold(spark, sources, settings).collect()}
    for fact, name in (("fait_hospitalisation", "stays"), ("fait_consultation", "visits"), ("fait_satisfaction", "surveys"), ("fait_deces", "deaths")):
        line = found[fact]
        assert files.count_lines(spark, places[name]) == line.bronze == line.charge + line.doublons + line.rejets, fact
        assert line.gold == line.charge == spark.table(f"{settings.gold}.{fact}").count()
    assert [(found[f].bronze, found[f].charge, found[f].doublons, found[f].rejets) for f in sorted(found)] == [
        (5, 1, 1, 3), (4, 2, 0, 2), (8, 2, 1, 5), (6, 1, 1, 4)]
    rejects = spark.read.parquet(f"{settings.root}/{settings.staging}/rejets")
    reasons = {(r.source, r[REASON]): r.n for r in rejects.groupBy("source", REASON).agg(F.count("*").alias("n")).collect()}
    assert reasons["fait_hospitalisation", "LIGNE_COURTE"] == reasons["fait_hospitalisation", "LIGNE_LONGUE"] == 1
    assert reasons["fait_satisfaction", "ETAB_INCONNU"] == 1 and reasons["fait_consultation", "HORS_PLAGE"] == 1
    short = rejects.filter("raison_rejet = 'LIGNE_COURTE' and source = 'fait_hospitalisation'").select(
        F.get_json_object("ligne_source", "$.fichier"), F.get_json_object("ligne_source", "$.ligne_brute")).first()
    assert tuple(short) == ("a.csv", "3;p3")
    mapping = {r[0] for r in spark.read.parquet(f"{settings.root}/secure/patient_mapping").select("id_patient_original").collect()}
    assert "p1" in mapping  # a patient of the facts who is in no list
