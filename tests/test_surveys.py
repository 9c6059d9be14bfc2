"""Survey files of different widths, and campaigns that are replaced one by one."""

import os

import pytest
from pyspark.sql import functions as F

from klinark.functions.fixed_values import SUB_SCORES
from klinark.operators.layout import ensure_zones, write_table
from klinark.plans import campaigns, cubes, dimensions
from klinark.plans.standins import load_inputs
from klinark.session import staging_path
from klinark.sources.surveys import read_surveys, sub_score_rows

NAMES = ["finess", "rs_finess", "finess_geo", "rs_finess_geo", "region", "participation", "depot", "nb_rep_score_all",
         "score_all_rea_ajust", *[f"c{i}" for i in range(9, 23)]]


def line(site, score, region="AFRICA", width=23, name="Clinique"):
    fields = [f"E{site}", "", site, name, region, "", "", "12", score, *[""] * 14]
    for rank, at in enumerate(SUB_SCORES.values()):
        fields[at] = f"{10 * rank + int(site)},5"
    return ";".join(fields + ["81", "40"][:width - 23])


def write(root, year, name, lines, header=None, width=23, encoding="utf-8"):
    folder = f"{root}/annee={year}"
    os.makedirs(folder, exist_ok=True)
    header = header or NAMES + ["taux_reco_brut", "nb_reco_brut"][:width - 23]
    with open(f"{folder}/{name}.csv", "w", encoding=encoding) as out:
        out.write("\n".join([";".join(header), *lines]) + "\n")


@pytest.fixture
def root(tmp_path):
    return str(tmp_path)


def test_both_widths_give_equal_rows_and_bad_lines_are_named(spark, root):
    write(root, 2017, "a", [line("1", "80,5"), line("2", "", name='"Clinique; du ""Lac"""'), "1;2;3", line("3", "70") + ";x", "", '1;"open' + ";" * 21])
    write(root, 2019, "b", [line("1", "80,5", width=25), line("2", "60", width=25), line("4", "50")], width=25)
    write(root, 2019, "c", ["a;b"], header=["x", "y"])
    read = read_surveys(spark, root)
    good = read.filter("motif is null")
    assert {(r.annee, r.finess_geo, r.score_all_rea_ajust) for r in good.collect()} == {
        (2017, "1", "80,5"), (2017, "2", None), (2019, "1", "80,5"), (2019, "2", "60")}
    assert {r.rs_finess_geo for r in good.filter("finess_geo = '2'").collect()} == {'Clinique; du "Lac"', "Clinique"}
    bad = {(r.annee, r.motif): r.ligne for r in read.filter("motif is not null").collect()}
    assert set(bad) == {(2017, "LIGNE_COURTE"), (2017, "LIGNE_LONGUE"), (2017, "LIGNE_ILLISIBLE"), (2019, "LIGNE_COURTE"), (2019, "ENTETE_INCONNU")}
    assert bad[2017, "LIGNE_COURTE"] == "1;2;3"


def test_columns_are_found_by_the_header_of_their_file(spark, root):
    moved = list(NAMES)
    moved[2], moved[5] = moved[5], moved[2]
    fields = line("7", "90").split(";")
    fields[2], fields[5] = fields[5], fields[2]
    write(root, 2018, "a", [";".join(fields)], header=moved)
    renamed = [{"region": "Region_site", "score_all_rea_ajust": "score_all_rea_ajust_2019"}.get(n, n.upper()) for n in NAMES]
    write(root, 2019, "b", [line("8", "91", region="Île")], header=renamed)
    found = {(r.annee, r.finess_geo, r.score_all_rea_ajust, r.region) for r in read_surveys(spark, root).collect()}
    assert found == {(2018, "7", "90", "AFRICA"), (2019, "8", "91", "Île")}


def test_windows_files(spark, root):
    write(root, 2017, "a", [line("1", "80", region="Auvergne-Rhône-Alpes")], encoding="cp1252")
    assert read_surveys(spark, root, encoding="windows-1252").first().region == "Auvergne-Rhône-Alpes"


def test_sub_scores_of_a_wide_file(spark, root):
    write(root, 2020, "a", [line("1", "80", width=25), line("3", "60", width=25), line("5", "", width=25), line("9", "101", width=25)], width=25)
    means = {r.sous_score: (r.moyenne, r.n) for r in cubes.sub_score_means(sub_score_rows(read_surveys(spark, root))).collect()}
    assert means == {label: (rank + 0.25, 2) for rank, label in enumerate(SUB_SCORES)}


def test_each_campaign_is_replaced_alone(spark, folder, root):
    sources, settings = load_inputs(spark, folder, f"{root}/entrepot")
    suffix = staging_path(spark, "x").rsplit("-", 1)[1]
    settings.gold, settings.staging = f"gold_{suffix}", f"staging_{suffix}"
    settings.thresholds = {"ecart_pct": ("max", 0.0)}  # campaigns change as they like here
    ensure_zones(spark, settings.root, (settings.staging, settings.gold))
    geography = dimensions.geography(sources.departments)
    known = spark.createDataFrame([(str(i),) for i in range(1, 9)], "etab_id string")
    files = f"{root}/enquetes"
    for year, width in ((2017, 23), (2018, 25), (2019, 25)):
        write(files, year, "a", [line(str(i), f"{i + year - 2000},5", width=width) for i in range(1, 10)] + ["1;2"], width=width)
    table = f"{settings.gold}.fait_satisfaction"
    rows = lambda: {(r.annee, r.etab_id): r for r in spark.table(table).collect()}
    load = lambda: campaigns.load_campaigns(spark, read_surveys(spark, files), known, geography, settings)

    summary = load().first()
    assert (summary.bronze, summary.charge, summary.rejets, summary.ecart) == (30, 24, 6, 0)
    reasons = spark.read.parquet(f"{settings.root}/{settings.staging}/rejets").groupBy("raison_rejet").count().collect()
    assert {r[0]: r[1] for r in reasons} == {"LIGNE_COURTE": 3, "ETAB_INCONNU": 3}
    first = rows()
    assert len(first) == 24 and load() is None  # nothing changed, nothing is loaded

    write(files, 2018, "a", [line("1", "99", width=25), line("2", "19,5", width=25)], width=25)
    assert load().first().charge == 2
    second = rows()
    assert {k for k in second if k[0] == 2018} == {(2018, "1"), (2018, "2")}
    assert {k: v for k, v in second.items() if k[0] != 2018} == {k: v for k, v in first.items() if k[0] != 2018}
    assert second[2018, "1"].satisfaction_key == first[2018, "1"].satisfaction_key

    write(files, 2017, "a", [line("1", "not a mark")])  # no line of it is loaded
    assert load().first().charge == 0
    assert {k[0] for k in rows()} == {2018, 2019}
    os.remove(f"{files}/annee=2019/a.csv")
    write(files, 2020, "a", [line("1", "50", width=25)], width=25)
    load()
    assert {k[0] for k in rows()} == {2018, 2020} and load() is None


def test_attributes_come_from_the_best_source(spark):
    geography = spark.createDataFrame([("01", "Île-de-France"), ("02", "Grand Est"), ("INCONNU", "INCONNU")], "geo_id string, region string")
    surveyed = spark.createDataFrame([("1", "B", "ile de france"), ("1", "A", "Ile de France"), ("2", "", "grand-est"),
                                      ("2", "Z", None), ("3", "C", "Atlantide"), (" ", "x", "y")], "etab_id string, nom_etab string, region string")
    admitting = spark.createDataFrame([("1",), (" 4 ",), (None,), ("4",)], "etab_id string")
    found = {(r.etab_id, r.nom_etab, r.region) for r in dimensions.establishment(surveyed, admitting, geography).collect()}
    assert found == {("1", "A", "Île-de-France"), ("2", "Z", "Grand Est"), ("3", "C", "INCONNU"), ("4", None, "INCONNU"),
                     ("INCONNU", "INCONNU", "INCONNU")}
