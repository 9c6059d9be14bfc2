"""What an erasure shuffles and writes, and that the shorter ways give the same rows."""

import glob
import json
import os
import subprocess
import sys

from pyspark.sql import functions as F

from klinark.operators.layout import write_fact
from klinark.operators.rows import accepted, classify, unrejected
from klinark.plans import erasure
from klinark.plans.facts import clean_stays, number_stays, stay_rules, type_stays
from klinark.plans.standins import FIRST_YEAR, LAST_YEAR, MASTER, SEED, STAY_TIE, stays
from klinark.session import staging_path

ROWS, ERASED = 60_000, 10_000
JOB = f"""
import sys
from pyspark.sql import SparkSession, functions as F
from klinark.operators.layout import write_fact
from klinark.plans.erasure import Target, erase_from
path = sys.argv[1]
spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4")
         .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", "file://" + path + "/log")
         .config("spark.eventLog.compress", "false").config("spark.eventLog.rolling.enabled", "false")
         .config("spark.checkpoint.dir", path + "/checkpoint").config("spark.sql.warehouse.dir", path + "/warehouse")
         .config("spark.sql.autoBroadcastJoinThreshold", "300k").getOrCreate())  # the digests fit, the texts do not
person = F.sha2(F.col("id").cast("string"), 256).alias("patient_id")
rows = spark.range({ROWS}).select(person, F.col("id").alias("v"), (F.col("id") % 40).cast("string").alias("etab_id"),
                                  (F.lit(1996) + F.col("id") % 5).cast("int").alias("annee"))
write_fact(rows, "sejours_mesure", ("etab_id",), 4)
spark.sparkContext.setJobGroup("effacement", "")
erase_from(spark, [Target("sejours_mesure", "table", ("annee",), F.col("patient_id"), ("etab_id",), 4)],
           spark.range({ERASED}).select(person.alias("personne")), path + "/journal")
spark.sparkContext.setJobGroup("fin", "")
assert [r.v for r in spark.table("sejours_mesure").orderBy("v").collect()] == list(range({ERASED}, {ROWS}))
spark.stop()
"""


def test_an_erasure_shuffles_the_rows_it_finds_and_not_the_table(tmp_path):
    os.makedirs(tmp_path / "log")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", JOB, str(tmp_path)], check=True, cwd=root, timeout=300,
                   env={**os.environ, "PYTHONPATH": root})
    events = [json.loads(line) for line in open(glob.glob(f"{tmp_path}/log/*")[0])]
    ours = {s for e in events if e["Event"] == "SparkListenerJobStart"
            and e["Properties"].get("spark.jobGroup.id") == "effacement" for s in e["Stage IDs"]}
    done = [e["Task Metrics"] for e in events if e["Event"] == "SparkListenerTaskEnd" and e["Stage ID"] in ours]
    shuffled = sum(m["Shuffle Write Metrics"]["Shuffle Bytes Written"] for m in done)
    written = sum(m["Output Metrics"]["Bytes Written"] for m in done)
    # found rows and wanted persons meet by their texts: 64 digits each, a few times; a pass of the table is 70 bytes a row
    assert shuffled < 64 * 7 * ERASED, shuffled
    assert written < 2 * 50 * (ROWS - ERASED) + 150 * ERASED, written  # copy and table, and what was staged of the persons


def test_persons_that_share_a_digest_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(erasure, "_digest", lambda person: F.length(person).cast("long"))
    name = "effacement_" + staging_path(spark, "t").rsplit("-", 1)[1]
    rows = [("a", 1, 2000), ("b", 2, 2000), ("cc", 3, 2001), (None, 4, 2001), ("dd", 5, 2002), ("eee", 6, 2002)]
    spark.createDataFrame(rows, "patient_id string, v int, annee int").write.partitionBy("annee").saveAsTable(name)
    persons = spark.createDataFrame([("a",), ("dd",), (None,), ("zz",)], "personne string")
    report = erasure.erase_from(spark, [erasure.Target(name, "table", ("annee",), F.col("patient_id"))], persons, staging_path(spark, "journal"))
    assert {(r.partition, r.n_effaces) for r in report.collect()} == {("annee=2000", 1), ("annee=2002", 1)}
    assert sorted(r.v for r in spark.table(name).collect()) == [2, 3, 4, 6]


def test_files_do_not_multiply_over_erasures(spark, folder):
    name = "effacement_" + staging_path(spark, "t").rsplit("-", 1)[1]
    rows = spark.range(4000).select(F.sha2(F.col("id").cast("string"), 256).alias("patient_id"), (F.col("id") % 7).alias("etab_id"),
                                    (F.lit(2000) + F.col("id") % 3).cast("int").alias("annee"))
    write_fact(rows, name, ("etab_id",), 2)
    target = erasure.Target(name, "table", ("annee",), F.col("patient_id"), ("etab_id",), 2)
    before = len(spark.table(name).inputFiles())
    for turn in range(3):
        gone = rows.limit(0).unionAll(rows.filter(F.col("etab_id") == turn)).select(F.col("patient_id").alias("personne"))
        erasure.erase_from(spark, [target], gone, staging_path(spark, "journal"))
        assert len(spark.table(name).inputFiles()) <= before + 8 * (turn + 1)
    assert {r.etab_id for r in spark.table(name).select("etab_id").distinct().collect()} == {3, 4, 5, 6}


def test_stays_numbered_from_clear_identifiers_are_the_same_stays(spark, folder, rows):
    typed = type_stays(stays(spark, folder))
    plain = number_stays(clean_stays(typed, MASTER, SEED, FIRST_YEAR, LAST_YEAR, STAY_TIE))
    late = number_stays(clean_stays(typed, MASTER, SEED, FIRST_YEAR, LAST_YEAR, STAY_TIE, clear=True), MASTER, SEED)
    assert late.schema == plain.schema and rows(late) == rows(plain)
    # patients that differ only in their pseudonym keep its order
    day = [("1", 1, 1, str(p), "7", "d", "01/02/1999", "3") for p in range(200)]
    same = type_stays(spark.createDataFrame(day, stays(spark, folder).schema))
    plain = number_stays(clean_stays(same, MASTER, SEED, FIRST_YEAR, LAST_YEAR, STAY_TIE))
    late = number_stays(clean_stays(same, MASTER, SEED, FIRST_YEAR, LAST_YEAR, STAY_TIE, clear=True), MASTER, SEED)
    assert rows(late) == rows(plain)
    assert [r.patient_id for r in late.orderBy("hosp_key").collect()] == sorted(r.patient_id for r in plain.collect())


def test_valid_rows_are_those_without_a_reason(spark, folder, rows):
    typed, rules = type_stays(stays(spark, folder)), stay_rules(FIRST_YEAR, LAST_YEAR)
    assert rows(unrejected(typed, rules)) == rows(accepted(classify(typed, rules)))
    odd = spark.createDataFrame([(None, 1), (1, None), (None, None), (5, 5)], "a int, b int")
    rules = [("A", F.col("a") > 3), ("B", F.col("b") > 3)]
    assert rows(unrejected(odd, rules)) == rows(accepted(classify(odd, rules))) and unrejected(odd, rules).count() == 3
