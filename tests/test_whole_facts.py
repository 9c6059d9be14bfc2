"""No fact leaves a steering question because its member is not resolved."""

import pytest

from klinark.plans import cubes, kpi
from klinark.plans.registry import QUERIES
from klinark.plans.standins import sites, specialties
from tests.oracle import connect

STAYS = "etab_id string, annee int, nb_hospitalisation int, duree_sejour int"


@pytest.fixture(scope="module")
def stays(spark):
    return spark.createDataFrame([("1", 1999, 1, 4), ("1", 1999, 1, 2), ("8", 1999, 1, 5), ("9", 1999, 1, 7)], STAYS)


def test_stand_ins_hold_every_supplier_and_nation(spark, folder):
    source = connect(folder)
    assert sites(spark, folder).count() == source.execute("SELECT count(*) FROM supplier").fetchone()[0]
    assert specialties(spark, folder).count() == source.execute("SELECT count(*) FROM nation").fetchone()[0]


def test_stays_of_unknown_sites_are_in_every_total(spark, stays):
    known = spark.createDataFrame([("1", "R", "P")], "etab_id string, region string, pays string")
    rolled = {(r.region, r.pays, r.etab_id, r.annee): (r.nb, r.dms)
              for r in kpi.drilldown(stays, known, ["region", "pays", "etab_id", "annee"]).collect()}
    assert rolled[None, None, None, None] == (4, 4.5)
    assert rolled["INCONNU", "INCONNU", "INCONNU", 1999] == (2, 6.0)
    assert rolled["R", "P", "1", 1999] == (2, 3.0)
    top = {r.etab_id: (r.nb, r.dms) for r in kpi.stays_by_establishment(stays, known, 1999).collect()}
    assert top == {"1": (2, 3.0), "INCONNU": (2, 6.0)}


def test_visits_without_a_specialty_count(spark):
    visits = spark.createDataFrame([(1999, 1, "a", "S1"), (1999, 2, "a", "S1"), (1999, 3, "b", "S1")],
                                   "annee int, id_prof int, id_patient string, code_diag string")
    labels = spark.createDataFrame([(1, "X"), (2, None)], "id_prof int, specialite string")
    patients = spark.createDataFrame([("a", "male")], "id_patient string, sexe string")
    cube = {(r.specialite, r.sexe): r.n for r in cubes.consultations_cube(visits, labels, patients).collect()}
    assert cube == {("X", "M"): 1, ("INCONNU", "M"): 1, ("INCONNU", "?"): 1}
    top = {r.specialite: r.n for r in kpi.top_labels_per_year(visits, "id_prof", labels, "specialite", 5).collect()}
    assert top == {"X": 1, "INCONNU": 2}


def test_totals_hold_every_fact(spark, folder):
    source = connect(folder)
    lines = source.execute("SELECT count(*) FROM lineitem JOIN orders ON o_orderkey = l_orderkey").fetchone()[0]
    cube = QUERIES["cube_consultation"](spark, folder).agg({"n": "sum"}).first()[0]
    stays = QUERIES["kpi_stays_total_year"](spark, folder).first().nb
    rolled = QUERIES["drilldown_rollup"](spark, folder).filter("annee = 1999").agg({"nb": "sum"}).first()[0]
    assert (cube, rolled) == (lines, stays)


def test_marks_stays_and_rates_of_unknown_members_count(spark, stays):
    patients = spark.createDataFrame([("a", "M", "0-19")], "patient_id string, sexe string, tranche_age string")
    visited = spark.createDataFrame([("a", 1999, 1), ("b", 1999, 1), (None, 1999, 1)], "patient_id string, annee int, nb_hospitalisation int")
    found = {(r.sexe, r.tranche_age): r.nb for r in kpi.stays_by_sex_and_age(visited, patients, 1999).collect()}
    assert found == {("M", "0-19"): 1, ("?", "Inconnu"): 2}
    marks = spark.createDataFrame([("1", 8.0, 1999), ("7", 4.0, 1999)], "etab_id string, note_satisfaction double, annee int")
    known = spark.createDataFrame([("1", "R")], "etab_id string, region string")
    assert {(r.region, r.satisf_moy, r.n_sites) for r in kpi.mean_mark_by_region(marks, known, 1999).collect()} == {
        ("R", 8.0, 1), ("INCONNU", 4.0, 1)}
    rates = {r.groupe: (r.numerateur, r.denominateur) for r in
             kpi.rate(stays, "etab_id", known, "region", stays["duree_sejour"] > 4, "x").collect()}
    assert rates == {"R": (0, 2), "INCONNU": (2, 2)}
    beds = spark.createDataFrame([("1", 2)], "etab_id string, lits int")
    used = {r.etab_id: (r.jours, r.taux_pct) for r in kpi.bed_occupancy(stays, beds, 1999).collect()}
    assert used == {"1": (6, 0.82), "INCONNU": (12, None)}


def test_json_rows_keep_numbers_and_quote_texts(spark):
    cube = spark.createDataFrame([(1999, 'a "b"', None, 3), (None, "", "é", 4)], "annee int, region string, sexe string, n long")
    assert {r.ligne for r in cubes.cube_as_json(cube).collect()} == {'[1999,"a \\"b\\"",null,3]', '[null,"","é",4]'}


def test_sites_without_a_region_are_only_in_the_national_total(spark):
    surveys = spark.createDataFrame([("R", 80), ("R", 60), (None, 10), (" ", 20)], "region string, score int")
    assert {(r.region, r.moyenne, r.diffuses, r.total) for r in cubes.satisfaction_summary(surveys).collect()} == {
        ("R", 7.0, 2, 2), ("FRANCE", 7.0, 2, 4)}


def test_spellings_of_one_consultation_are_one_row(spark):
    from klinark.plans import facts
    from klinark.schemas import RAW_CONSULTATIONS
    visit = lambda number, patient: (number, "m", patient, " d1", "S52", "", "1999-01-01", "08:00:00", "08:30:00")
    raw = spark.createDataFrame([visit("1", "p1"), visit(" 1 ", "P1 "), visit("2", "p1")], RAW_CONSULTATIONS)
    fact = facts.clean_consultations(facts.type_consultations(raw), "m", "s", 1990, 2000)
    assert sorted((r.num_consultation, r.prof_id) for r in fact.collect()) == [("1", "d1"), ("2", "d1")]


def test_deaths_outside_the_dimension_count(spark):
    deaths = spark.createDataFrame([("01", 2, 1999), ("77", 1, 1999)], "geo_id string, nb_deces int, annee int")
    geography = spark.createDataFrame([("01", "R")], "geo_id string, region string")
    assert {(r.region, r.nb_deces) for r in kpi.deaths_by_region(deaths, geography, 1999).collect()} == {("R", 2), ("INCONNU", 1)}
