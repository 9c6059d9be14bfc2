"""One injected row per cleaning rule, with its expected effect."""

import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from klinark.functions.bands import age_band, age_band_legacy, band_of_age, band_rank, stay_type
from klinark.functions.codes import (
    chapter_letter, department_code, fold_label, icd_chapter, known_or, sex_code, standard_region,
)
from klinark.functions.values import (
    clock_seconds, decimal_comma, discharge_date, duration_minutes, local_seconds, mark_out_of_ten,
    parse_dmy, whole_percent,
)
from klinark.operators import checks
from klinark.operators.rows import REASON, classify, duplicates
from klinark.plans import dimensions, facts
from klinark.schemas import RAW_CONSULTATIONS, RAW_DEATHS, RAW_STAYS
from klinark.sources.delimited import read_departments

DAY = datetime.date


def values(spark, expression, inputs, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("x"))).collect()]


def test_dates_and_numbers(spark):
    assert values(spark, parse_dmy, [
        "5/3/1999", "05/03/1999", " 5/3/1999 ", "29/02/2020", "32/01/1999", "30/02/2020", "1999-03-05", "1999",
        "5/3/99", "5/3/19999", "x5/3/1999", "05/03/1999 08:00", "x", "", None]) == [
        DAY(1999, 3, 5), DAY(1999, 3, 5), DAY(1999, 3, 5), DAY(2020, 2, 29)] + [None] * 11
    assert values(spark, decimal_comma, ["74,25", "1000,0", "12.5", "n/a", "", None]) == [
        Decimal("74.2500"), Decimal("1000.0000"), Decimal("12.5000"), None, None, None]
    assert values(spark, lambda x: mark_out_of_ten(decimal_comma(x)), ["74,25", "87,5"]) == [
        Decimal("7.4"), Decimal("8.8")]
    assert values(spark, clock_seconds, ["08:30:05", "25:00:00", None]) == [30605, None, None]
    assert values(spark, duration_minutes, [90, 0, -1, None], "int") == [1.5, 0.0, None, None]
    assert values(spark, lambda x: whole_percent(x, F.lit(200)), [5, -5], "int") == [3, -2]
    assert values(spark, lambda x: whole_percent(F.lit(1), x), [0], "int") == [None]
    assert values(spark, lambda x: discharge_date(F.lit(DAY(1999, 12, 30)), x), [3, None], "int") == [
        DAY(2000, 1, 2), None]


def test_local_seconds_ignore_the_time_zone(spark):
    pair = spark.sql("SELECT TIMESTAMP_NTZ'2024-03-30 12:00:00' AS a, TIMESTAMP_NTZ'2024-04-01 11:59:59' AS b")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")
    try:
        assert pair.select(local_seconds(F.col("a"), F.col("b"))).first()[0] == 2 * 86400 - 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_bands(spark):
    def both(expression):
        df = spark.createDataFrame(
            [("2019-05-01", "2000-01-01"), ("2019-05-01", "1999-12-31"), ("2019-05-01", None),
             ("2019-05-01", "2020-01-01"), ("2019-05-01", "1898-01-01"), ("2019-05-01", "abcd")], "d string, b string")
        return [r[0] for r in df.select(expression(F.col("d"), F.col("b"))).collect()]
    assert both(age_band) == ["0-19", "20-39", "Inconnu", "Inconnu", "Inconnu", "Inconnu"]
    assert both(age_band_legacy) == ["0-19", "20-39", "85+", "0-19", "85+", "Inconnu"]
    assert values(spark, band_of_age, [0, 19, 20, 59, 60, 74, 75, 84, 85, 120, 121, -1], "int") == [
        "0-19", "0-19", "20-39", "40-59", "60-74", "60-74", "75-84", "75-84", "85+", "85+", "Inconnu", "Inconnu"]
    assert values(spark, band_rank, ["0-19", "85+", "Inconnu"]) == [1, 6, 7]
    assert values(spark, stay_type, [0, 1, 2, 3, None], "int") == [
        "Ambulatoire", "Court séjour", "Court séjour", "Séjour standard", "Séjour standard"]


def test_codes(spark):
    assert values(spark, sex_code, ["1", "2", "male", "Female", "9", "", None]) == ["M", "F", "M", "F", "?", "?", "?"]
    assert values(spark, known_or, ["J45", "", " ", None]) == ["J45", "UNKNOWN", "UNKNOWN", "UNKNOWN"]
    assert values(spark, icd_chapter, ["a01", "B99", "UNKNOWN", "", "9X"]) == [
        "Infectieuses & parasitaires", "Infectieuses & parasitaires", "Inconnu", "Inconnu", "Autres"]
    assert values(spark, chapter_letter, ["j45", "UNKNOWN", None]) == ["J", "?", "?"]
    assert values(spark, department_code, ["20004", "2A004", "97105", "98818", "99999", "01001"]) == [
        "20", "2A", "971", "988", "99", "01"]
    assert values(spark, lambda x: fold_label(standard_region(x)),
                  ["PACA", "Provence-Alpes-Côte d'Azur", "Ile de France", "Île-de-France"]) == [
        "provencealpescotedazur", "provencealpescotedazur", "iledefrance", "iledefrance"]


def test_department_reference(spark):
    reference = read_departments(spark)
    assert reference.count() == 109 and reference.select("code_departement").distinct().count() == 109
    assert reference.select("code_region").distinct().count() == 19
    regions = {r.geo_id: r.region for r in dimensions.geography(reference).collect()}
    assert len(regions) == 20 and regions["00"] == "Collectivités d'outre-mer"
    assert regions["INCONNU"] == "INCONNU" and regions["11"] == "Île-de-France"


def reasons(df, rules, key):
    return {r[key]: r[REASON] for r in classify(df, rules).collect()}


def test_consultation_rules(spark):
    raw = spark.createDataFrame([
        ("1", "m", "7", "p1", "J45", "toux", "2019-03-04", "08:00:00", "08:30:00"),
        ("1", "m", "7", "p1", "J45", "toux", "2019-03-04", "08:00:00", "08:30:00"),
        ("2", "m", "007", None, "", "toux", "2019-03-05", "09:00:00", "08:30:00"),
        ("3", "m", None, "p1", "J45", "toux", "2019-03-05", "08:00:00", "08:30:00"),
        ("4", "m", "8", "p1", "J45", "toux", None, "08:00:00", "08:30:00"),
        ("5", "m", "8", "p1", "J45", "toux", "2014-12-31", "08:00:00", "08:30:00"),
        ("6", "m", " ", "p1", "J45", "toux", "2019-02-30", "08:00:00", None),
    ], RAW_CONSULTATIONS)
    typed = facts.type_consultations(raw)
    assert reasons(typed, facts.consultation_rules(2015, 2023), "num_consultation") == {
        "1": None, "2": None, "3": "PATIENT_NULL", "4": "DATE_INVALIDE", "5": "HORS_PLAGE", "6": "PATIENT_NULL"}
    fact = facts.number_consultations(facts.clean_consultations(typed, "m", "s", 2015, 2023))
    first, second = fact.orderBy("consultation_key").collect()
    assert (first.consultation_key, first.date_id, first.duree_minutes, first.annee) == (1, 20190304, 30.0, 2019)
    assert (second.prof_id, second.diag_id, second.duree_minutes) == ("UNKNOWN", "UNKNOWN", None)
    assert first.patient_id == second.patient_id and len(first.patient_id) == 64
    assert "motif" not in fact.columns and "num_consultation" not in fact.columns
    counts = checks.reconcile(classify(typed, facts.consultation_rules(2015, 2023)), ["num_consultation"]).first()
    assert counts.asDict() == {"bronze": 7, "charge": 2, "doublons": 1, "rejets": 4, "ecart": 0}


def test_stay_rules(spark):
    raw = spark.createDataFrame([
        ("1", "7", "e1", "J45", "x", "5/3/1999", "3"), ("1", "7", "e1", "J45", "x", "5/3/1999", "3"),
        ("2", "7", "e1", "J45", "x", "32/01/1999", "3"), ("3", " ", "e1", "J45", "x", "05/03/1999", "3"),
        ("4", "7", None, "J45", "x", "05/03/1999", "3"), ("5", "7", "e1", "J45", "x", "05/03/1999", "-1"),
        ("6", "7", "e1", "", "x", "05/03/1999", None), ("7", "7", "e1", "J45", "x", "05/03/2001", "3"),
        ("8", None, None, "J45", "x", "x", "-3"),
    ], RAW_STAYS)
    typed = facts.type_stays(raw)
    rules = facts.stay_rules(1996, 2000)
    assert reasons(typed, rules, "num_hospitalisation") == {
        "1": None, "2": "DATE_INVALIDE", "3": "PATIENT_NULL", "4": "ETAB_NULL", "5": "DUREE_NEGATIVE", "6": None,
        "7": "HORS_PLAGE", "8": "PATIENT_NULL"}
    fact = facts.number_stays(facts.clean_stays(typed, "m", "s", 1996, 2000)).orderBy("hosp_key").collect()
    assert [(r.hosp_key, r.diag_id, r.duree_sejour) for r in fact] == [(1, "J45", 3), (2, "UNKNOWN", None)]
    extra = duplicates(typed, facts.STAY_KEY).collect()
    assert [(r.num_hospitalisation, r.n_doublons) for r in extra] == [("1", 1)]
    spelled = facts.type_stays(spark.createDataFrame([
        (n, p, e, d, "x", "05/03/1999", "3") for n, p, e, d in
        [("1", "7", "e1", "J45"), (" 1", "007", "e1 ", " J45"), ("1 ", " 7 ", " e1", "J45 ")]], RAW_STAYS))
    one = facts.clean_stays(spelled, "m", "s", 1996, 2000).collect()
    assert [(r.etab_id, r.diag_id) for r in one] == [("e1", "J45")]


def test_survey_rules(spark):
    raw = spark.createDataFrame([
        ("s1", "PACA", ""), ("s2", "PACA", "n/a"), ("s3", "PACA", "1000,0"), ("s4", "PACA", "101,0"),
        ("s5", "Ile de France", "74,25"), ("s6", "PACA", "80"), ("s7", "Ailleurs", "-1"), ("s7", "Ailleurs", "60,0"),
    ], "finess_geo string, region string, score_all_rea_ajust string")
    known = spark.createDataFrame([(f"s{i}",) for i in (1, 2, 3, 4, 5, 7)], "etab_id string")
    typed = facts.type_surveys(raw)
    found = classify(facts.flag_known_sites(typed, known), facts.survey_rules())
    assert sorted((r.finess_geo, r[REASON]) for r in found.filter(f"{REASON} IS NOT NULL").collect()) == [
        ("s1", "NOTE_NULLE"), ("s2", "NOTE_NON_NUMERIQUE"), ("s3", "NOTE_HORS_PLAGE"), ("s4", "NOTE_HORS_PLAGE"),
        ("s6", "ETAB_INCONNU"), ("s7", "NOTE_HORS_PLAGE")]
    geography = dimensions.geography(read_departments(spark))
    fact = facts.number_surveys(facts.clean_surveys(typed, known, geography, 2020)).orderBy("etab_id").collect()
    assert [(r.etab_id, r.geo_id, r.note_satisfaction, r.date_id, r.annee) for r in fact] == [
        ("s5", "11", Decimal("7.4"), 20200101, 2020), ("s7", "INCONNU", Decimal("6.0"), 20200101, 2020)]


def test_death_rules(spark):
    def death(act, place, date, birth="1950-01-01", sex="1"):
        return ("N", "P", sex, birth, "75001", "PARIS", "FRANCE", date, place, act)
    raw = spark.createDataFrame([
        death("1", "20004", "2019-01-01", None), death("2", "2A004", "2019-01-02", "2020-01-01", "9"),
        death("3", "97105", "2019-01-03", "1898-05-05", "2"), death("4", "98818", "2019-02-30"),
        death("5", "99350", "2019-01-05"), death("6", "75101", "1999-12-31"), death("7", "75101", "2019"),
    ], RAW_DEATHS)
    assert reasons(raw, facts.death_rules(2000), "numero_acte_deces") == {
        "1": None, "2": None, "3": None, "4": "DATE_INVALIDE", "5": None, "6": "HORS_PLAGE", "7": "DATE_INVALIDE"}
    fact = facts.number_deaths(facts.clean_deaths(raw, read_departments(spark), 2000)).orderBy("deces_key").collect()
    assert [(r.deces_key, r.geo_id, r.sexe, r.tranche_age) for r in fact] == [
        (1, "94", "M", "Inconnu"), (2, "94", "?", "Inconnu"), (3, "01", "F", "Inconnu"), (4, "INCONNU", "M", "60-74")]


def test_gates_and_schema_checks(spark):
    metrics = spark.createDataFrame([(79.0, 95.0)], "charge double, resolus double")
    rows = checks.gates(metrics, {"charge": ("min", 80), "resolus": ("min", 90)})
    assert {r.seuil: r.respecte for r in rows.collect()} == {"charge": False, "resolus": True}
    with pytest.raises(checks.GateFailed, match="charge"):
        checks.enforce(rows)
    with pytest.raises(ValueError, match="nom"):
        checks.assert_no_columns(spark.createDataFrame([("a",)], "nom string"), {"nom"})
