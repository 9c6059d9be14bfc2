"""Delimited sources: quarantine, schema drift, encodings, file profile."""

import pytest
from pyspark.sql import functions as F

from klinark.schemas import CORRUPT, text_schema
from klinark.session import staging_path, staging_root
from klinark.sources.delimited import (
    malformed_reason, read_delimited, resolve_column, split_malformed, union_campaigns, write_text_export,
)
from klinark.sources.files import profile_files
from klinark.sources.relational import to_bronze

SCHEMA = text_schema("a", "b", "c")


def test_malformed_lines_are_quarantined_with_a_reason(spark, tmp_path):
    (tmp_path / "x.csv").write_text('a,b,c\n1,"x, y",z\n2,x\n3,x,y,z\n4,"u, v",w,t\n', encoding="utf-8")
    read = read_delimited(spark, str(tmp_path), SCHEMA)
    good, bad = split_malformed(read)
    assert [tuple(r) for r in good.collect()] == [("1", "x, y", "z")]
    found = bad.select(CORRUPT, malformed_reason(SCHEMA, ",").alias("m")).collect()
    assert sorted((r[CORRUPT], r.m) for r in found) == [
        ("2,x", "LIGNE_COURTE"), ("3,x,y,z", "LIGNE_LONGUE"), ('4,"u, v",w,t', "LIGNE_LONGUE")]


@pytest.mark.parametrize("columns", [["a"], ["c"], ["a", "b", "c"], []])
def test_the_columns_in_use_do_not_change_which_lines_are_kept(spark, tmp_path, columns):
    (tmp_path / "x.csv").write_text("a,b,c\n1,x,z\n2,x\n3,x,y,z\n", encoding="utf-8")
    skipped = read_delimited(spark, str(tmp_path), SCHEMA, skip_malformed=True)
    assert skipped.select(*columns).count() == 1
    good, _ = split_malformed(read_delimited(spark, str(tmp_path), SCHEMA))
    assert good.select(*columns).count() == 1


def test_column_lookup_prefers_the_exact_name_and_skips_counts():
    header = ["finess", "nb_rep_score_all_rea_ajust", " Score_All_Rea_Ajust ", "Région"]
    assert resolve_column(header, "score_all_rea_ajust") == " Score_All_Rea_Ajust "
    assert resolve_column(["nb_score", "taux_score"], "score") == "taux_score"
    assert resolve_column(["nb_score"], "score") is None


def test_campaigns_with_drifting_columns(spark, rows):
    first = spark.createDataFrame([("s1", "50")], "finess_geo string, score string")
    second = spark.createDataFrame([("s2", 3, "x")], "finess_geo string, nb_score int, region string")
    stacked = union_campaigns([first, second], ["finess_geo", "score", "region"])
    assert rows(stacked.select("finess_geo", "score", "region")) == [("s1", "50", None), ("s2", None, "x")]


def test_windows_encoding(spark, tmp_path):
    text = "a;b;c\r\nCôte – œuvre;€;É\r\n"
    (tmp_path / "x.csv").write_bytes(text.encode("cp1252"))
    good, _ = split_malformed(read_delimited(spark, str(tmp_path), SCHEMA, sep=";", encoding="windows-1252"))
    assert [tuple(r) for r in good.collect()] == [("Côte – œuvre", "€", "É")]


def test_files_are_selected_by_name_at_any_depth(spark, tmp_path):
    (tmp_path / "2020").mkdir()
    (tmp_path / "2020" / "donnees_enquete.csv").write_text("a,b,c\n1,2,3\n", encoding="utf-8")
    (tmp_path / "2020" / "lisez_moi.csv").write_text("a,b,c\n4,5,6\n", encoding="utf-8")
    good, _ = split_malformed(read_delimited(spark, str(tmp_path), SCHEMA, pattern="*enquete*.csv"))
    assert [tuple(r) for r in good.collect()] == [("1", "2", "3")]


def test_file_profile(spark, tmp_path):
    (tmp_path / "u.csv").write_text("a,b,c\né,2,3\n\n4,5,6\n", encoding="utf-8")
    (tmp_path / "l.csv").write_bytes("a;b\né;x\n".encode("latin-1"))
    (tmp_path / "t.csv").write_text("a\tb\tc\td\n", encoding="utf-8")
    found = {r.file.rsplit("/", 1)[1]: tuple(r)[1:] for r in profile_files(spark, str(tmp_path)).collect()}
    assert found == {"u.csv": ("utf-8", ",", 3, 2), "l.csv": ("latin-1", ";", 2, 1), "t.csv": ("utf-8", "\t", 4, 0)}


def test_exports_keep_blanks_and_separators(spark, rows):
    path = staging_path(spark, "export")
    source = spark.createDataFrame([(" a ", "x;y", "é"), ('"q"', None, "z")], SCHEMA)
    write_text_export(source, path, sep=";")
    good, _ = split_malformed(read_delimited(spark, path, SCHEMA, sep=";"))
    assert rows(good) == rows(source)


def test_bronze_copies(spark, rows):
    source = spark.range(5).select(F.col("id").cast("string").alias("a"))
    path = staging_path(spark, "bronze")
    to_bronze(source, path)
    assert rows(spark.read.parquet(path)) == rows(source)
    to_bronze(source, path + "-text", sep=";")
    assert rows(spark.read.csv(path + "-text", header=True)) == rows(source)


def test_staging_folder_is_the_one_of_the_session(spark):
    assert staging_root(spark) == spark.conf.get("spark.checkpoint.dir")
