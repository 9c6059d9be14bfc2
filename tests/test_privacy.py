"""Pseudonyms, minimisation, role views, erasure and text scans."""

import pytest
from pyspark.sql import functions as F

from klinark.functions.privacy import has_mojibake, pseudonym
from klinark.operators.privacy import (
    attach_pseudonym, build_mapping, erase, minimise, scan_text, touched_partitions, view_for_role,
)


def test_pseudonyms_are_stable_unique_and_spelling_independent(spark):
    df = spark.createDataFrame([("7",), ("007",), (" 7 ",), ("8",), ("A-1",), ("",), (None,)], "id string")
    found = [r[0] for r in df.select(pseudonym(F.col("id"), "m", "s")).collect()]
    assert found[0] == found[1] == found[2] and len({*found[:5]}) == 3
    assert found[5] is None and found[6] is None and all(len(p) == 64 for p in found[:5])
    other = [r[0] for r in df.select(pseudonym(F.col("id"), "m", "t")).collect()]
    assert not set(found[:5]) & set(other[:5])


def test_mapping_has_one_row_per_patient_and_joins_like_the_hash(spark):
    df = spark.createDataFrame([("7", 1), ("007", 2), ("8", 3)], "id string, v int")
    mapping = build_mapping(df, "id", "m", "s", F.lit("2024-01-01").cast("timestamp"))
    assert mapping.count() == 2
    joined = {r.v: r.patient_id for r in attach_pseudonym(df, "id", mapping).collect()}
    direct = {r.v: r.p for r in df.select("v", pseudonym(F.col("id"), "m", "s").alias("p")).collect()}
    assert joined == direct


def test_direct_identifiers_cannot_be_kept(spark):
    df = spark.createDataFrame([("A", "1")], "nom string, sexe string")
    assert minimise(df, ["sexe"]).columns == ["sexe"]
    with pytest.raises(ValueError, match="nom"):
        minimise(df, ["nom", "sexe"])


def test_roles(spark):
    df = spark.createDataFrame([("A", "p1", "84", 1), ("B", "p2", "11", 1), ("C", "p3", "84", 1)],
                               "nom string, patient_id string, geo_id string, nb int")
    assert view_for_role(df, "admin").columns == df.columns
    assert view_for_role(df, "analyste").columns == ["patient_id", "geo_id", "nb"]
    inside = view_for_role(df, "praticien", F.col("geo_id") == "84", ["geo_id"], {"nb": F.sum("nb")})
    assert [tuple(r) for r in inside.collect()] == [("84", 2)]
    with pytest.raises(ValueError):
        view_for_role(df, "praticien")
    with pytest.raises(ValueError):
        view_for_role(df, "gestionnaire", axes=["patient_id"], measures={"nb": F.sum("nb")})


def test_erasure(spark, rows):
    df = spark.createDataFrame([("p1", 2019), ("p2", 2019), ("p1", 2020), ("p3", 2021)], "patient_id string, annee int")
    erased = spark.createDataFrame([("p1",), ("p1",)], "patient_id string")
    assert rows(erase(df, "patient_id", erased)) == [("p2", 2019), ("p3", 2021)]
    assert rows(touched_partitions(df, "patient_id", erased, "annee")) == [(2019,), (2020,)]


def test_text_scan(spark):
    df = spark.createDataFrame([
        (1, "écrire à jean.dupont@hopital.fr ou a@b.org, tél 01 23 45 67 89"), (2, "+1 (743) 555-3824"),
        (3, "rien, 12 kg, 192.168.10.12"), (4, None),
        (5, "0123456789, 01.23.45.67.89"), (6, "du 2019-01-02 au 03/04/2020")], "id int, t string")
    found = {r.id: (r.n_emails, r.n_telephones) for r in scan_text(df, "id", "t").collect()}
    assert found == {1: (2, 1), 2: (0, 1), 3: (0, 0), 4: (None, None), 5: (0, 2), 6: (0, 0)}
    assert [r[0] for r in df.select(has_mojibake(F.lit("Auvergne-RhÃ´ne"))).limit(1).collect()] == [True]
