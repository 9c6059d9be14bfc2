"""Incremental loads give the rows of one batch load."""

from klinark.operators.rows import accepted, classify, rejected
from klinark.plans.facts import shape_stays, stay_rules, type_stays
from klinark.plans.standins import FIRST_YEAR, LAST_YEAR, MASTER, SEED, STAY_TIE, stays
from klinark.session import staging_path
from klinark.streaming import incremental
from klinark.streaming.incremental import incremental_load

KEYS = ["patient_id", "num_hospitalisation", "date_entree"]


def test_files_arriving_in_turn(spark, folder, rows):
    raw = stays(spark, folder)
    landing, root = staging_path(spark, "landing"), staging_path(spark, "increments")
    rules = stay_rules(FIRST_YEAR, LAST_YEAR)
    shape = lambda valid: shape_stays(valid, MASTER, SEED, STAY_TIE)
    run = lambda: incremental_load(spark, landing, raw.schema, root, rules, type_stays, shape, KEYS)

    for part in range(3):
        raw.filter(f"pmod(hash(num_hospitalisation), 3) = {part}").coalesce(1).write.mode("append").parquet(landing)
        run()
    run()  # nothing new

    expected = shape(accepted(classify(type_stays(raw), rules)))
    loaded = spark.read.parquet(f"{root}/valides")
    assert rows(loaded.select(expected.columns)) == rows(expected)
    assert loaded.select("lot").distinct().count() == 3
    refused = spark.read.parquet(f"{root}/rejets")
    assert refused.count() == rejected(classify(type_stays(raw), rules)).count()


def test_a_key_loaded_by_an_earlier_file_is_not_loaded_again(spark, folder):
    raw = stays(spark, folder)
    landing, root = staging_path(spark, "landing"), staging_path(spark, "increments")
    for _ in range(2):  # the same rows are delivered twice
        raw.coalesce(1).write.mode("append").parquet(landing)
        incremental_load(spark, landing, raw.schema, root, stay_rules(FIRST_YEAR, LAST_YEAR), type_stays,
                         lambda valid: shape_stays(valid, MASTER, SEED, STAY_TIE), KEYS)
    loaded = spark.read.parquet(f"{root}/valides")
    assert loaded.count() == loaded.select(KEYS).distinct().count() > 0
    assert loaded.select("lot").distinct().count() == 1


def test_a_batch_of_new_and_loaded_keys_is_not_shuffled_as_a_whole(spark, folder, rows):
    """One partition per batch: its rows are written where they lie, and only keys meet the history."""
    raw = stays(spark, folder)
    landing, root, plans = staging_path(spark, "landing"), staging_path(spark, "increments"), []
    rules, half = stay_rules(FIRST_YEAR, LAST_YEAR), "pmod(hash(num_hospitalisation), 2) = 0"
    shape = lambda valid: shape_stays(valid, MASTER, SEED, STAY_TIE)
    explain = incremental.replace_batch

    def noted(df, path, batch):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        explain(df, path, batch)

    incremental.replace_batch = noted
    try:
        for part in (raw.filter(half), raw, raw):  # new keys, some of them new, none of them new
            part.coalesce(1).write.mode("append").parquet(landing)
            incremental_load(spark, landing, raw.schema, root, rules, type_stays, shape, KEYS)
    finally:
        incremental.replace_batch = explain
    expected = shape(accepted(classify(type_stays(raw), rules)))
    assert rows(spark.read.parquet(f"{root}/valides").select(expected.columns)) == rows(expected)
    joined = ["Join" in plan for plan in plans[::2]]  # every second write is that of the rejects
    assert joined == [False, True, False] and not any("Rebalance" in plan for plan in plans)
