"""Shape of the physical plans: what is pruned, broadcast, pre-reduced or not shuffled."""

import re

from pyspark.sql import functions as F

from klinark.operators.rows import keep_first, surrogate_key
from klinark.plans import kpi
from klinark.plans.registry.sources import bucketed_pair
from klinark.plans.standins import deaths, table, visits
from klinark.session import staging_path


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_year_filter_reaches_the_partition(spark, folder):
    path = staging_path(spark, "by-year")
    (table(spark, folder, "orders").withColumn("annee", F.year("o_orderdate")).withColumn("nb", F.lit(1))
     .write.partitionBy("annee").parquet(path))
    shown = plan(kpi.total(spark.read.parquet(path), "nb", 1999))
    assert re.search(r"PartitionFilters: \[.*annee#\d+ = 1999", shown)


def test_raw_year_filter_reaches_the_scan_and_columns_are_pruned(spark, folder):
    shown = plan(visits(spark, folder, with_code=False, year=1999).groupBy("annee").count())
    assert "GreaterThanOrEqual(o_orderdate,1999-01-01" in shown
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", shown)
    assert {tuple(sorted(p.split(":")[0] for p in s.split(","))) for s in schemas} == {
        ("l_orderkey",), ("o_orderdate", "o_orderkey")}


def test_deaths_are_not_shuffled_by_the_region_lookup(spark, folder):
    from klinark.plans.registry.quality import death_fact
    located = death_fact(spark, folder).select("geo_id")
    located.collect()
    assert re.search(r"BroadcastHashJoin \[_dept", plan(located))


def test_duplicates_are_reduced_before_the_shuffle(spark, folder):
    shown = plan(keep_first(table(spark, folder, "lineitem").select("l_orderkey", "l_partkey"),
                            ["l_orderkey"], ["l_partkey"]))
    below = shown[shown.index("Exchange hashpartitioning"):]
    assert "WindowGroupLimit" in below and "WindowGroupLimit" in shown[:shown.index("Exchange")]


def test_surrogate_key_never_gathers_the_rows(spark, folder):
    numbered = surrogate_key(table(spark, folder, "orders").select("o_orderkey", "o_orderdate"), "k",
                             ["o_orderdate", "o_orderkey"])
    shown = plan(numbered)
    assert "BroadcastHashJoin" in shown and "SortMergeJoin" not in shown
    # The only single partition holds one counted row per range.
    single = shown[shown.index("Exchange SinglePartition"):]
    assert "HashAggregate(keys=[_range" in single


def test_bucketed_join_and_count_need_no_exchange(spark, folder):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines, suppliers = bucketed_pair(spark, folder)
        shown = plan(lines.join(suppliers, "l_suppkey").groupBy("l_suppkey").count())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in shown and "SelectedBucketsCount: 8 out of 8" in shown


def test_year_filter_on_deaths_reads_three_columns_of_orders(spark, folder):
    shown = plan(deaths(spark, folder, 1999).select("code_lieu_deces"))
    assert "o_orderpriority" not in shown and "o_totalprice" not in shown
