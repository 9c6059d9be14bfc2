"""Timed runs at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

First the gold tables are loaded from the raw stand-ins (`load_gold`). Then the
steering questions run on them, as in the published baseline: over a flat copy
(`*_flat`) and over the table by year (`*_part`). Last come jobs that start from the
raw tables. Questions run once cold and BENCH_RUNS times warm over the noop sink (jobs from raw tables once warm);
the warm median is reported.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from klinark.operators.layout import scanned_bytes  # noqa: E402
from klinark.operators.rows import shift_years  # noqa: E402
from klinark.plans import kpi, standins  # noqa: E402
from klinark.plans.registry import QUERIES  # noqa: E402
from klinark.plans.warehouse import build_gold  # noqa: E402
from klinark.session import local_session  # noqa: E402

YEAR = standins.YEAR
FROM_RAW = ("profile_histograms", "fact_deaths", "fact_consultation", "fact_hospitalisation", "cube_deaths",
            "cube_consultation", "kpi_yearly_overview", "readmission_30d", "event_within_30d", "dq_reconcile",
            "pii_scan", "accent_fold")


def noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(job, runs: int) -> tuple[float, float]:
    """Cold time and median warm time of a job."""
    times = []
    for _ in range(runs + 1):
        start = time.perf_counter()
        job()
        times.append(time.perf_counter() - start)
    return times[0], statistics.median(times[1:])


def gold_queries(fact, dim, suffix: str) -> dict:
    """The benchmark questions of the baseline over one layout; `fact` maps a name to a frame."""
    return {
        f"deaths_q1_year_{suffix}": lambda: kpi.total(fact("fait_deces"), "nb_deces", YEAR),
        f"deaths_q2_top_regions_{suffix}": lambda: kpi.top_by_axis(fact("fait_deces"), "geo_id", "nb_deces", YEAR, 5),
        f"deaths_q3_join_region_{suffix}": lambda: kpi.deaths_by_region(fact("fait_deces"), dim("dim_geographie"), YEAR),
        f"deaths_q4_sex_age_{suffix}": lambda: kpi.by_sex_and_band(fact("fait_deces"), "nb_deces", YEAR),
        f"consultations_q1_year_{suffix}": lambda: kpi.total(fact("fait_consultation"), "nb_consultation", YEAR),
        f"consultations_q2_professional_{suffix}":
            lambda: kpi.by_axis(fact("fait_consultation"), "prof_id", "nb_consultation", YEAR),
        f"consultations_q3_diagnosis_{suffix}":
            lambda: kpi.top_by_axis(fact("fait_consultation"), "diag_id", "nb_consultation", YEAR, 10),
        f"stays_q1_year_{suffix}": lambda: kpi.total(fact("fait_hospitalisation"), "nb_hospitalisation", YEAR),
        f"stays_q2_diagnosis_{suffix}":
            lambda: kpi.top_by_axis(fact("fait_hospitalisation"), "diag_id", "nb_hospitalisation", YEAR, 10),
        f"stays_q3_establishment_{suffix}":
            lambda: kpi.stays_by_establishment(fact("fait_hospitalisation"), dim("dim_etablissement"), YEAR),
        f"stays_q4_sex_age_{suffix}":
            lambda: kpi.stays_by_sex_and_age(fact("fait_hospitalisation"), dim("dim_patient"), YEAR),
        f"satisfaction_r1_region_{suffix}":
            lambda: kpi.mean_mark_by_region(fact("fait_satisfaction"), dim("dim_etablissement"), YEAR),
        f"satisfaction_r2_all_{suffix}": lambda: kpi.mean_mark(fact("fait_satisfaction"), "geo_id"),
    }


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cpus, app="bench")
    root = tempfile.mkdtemp(prefix="run-bench-")
    times, cold = {}, {}

    sources, settings = standins.load_inputs(spark, folder, f"{root}/warehouse")
    start = time.perf_counter()
    build_gold(spark, sources, settings).count()
    cold["load_gold"] = times["load_gold"] = time.perf_counter() - start

    table = lambda name: spark.table(f"{settings.gold}.{name}")
    facts = {"fait_deces": ("deces_key", "nb_deces"), "fait_consultation": ("consultation_key", "nb_consultation"),
             "fait_hospitalisation": ("hosp_key", "nb_hospitalisation"), "fait_satisfaction": ("satisfaction_key", None)}
    for name, (key, _) in facts.items():  # five shifted years, as in the baseline
        five = shift_years(table(name), 5, key, "date_id", "annee")
        spread = five.repartition(int(cpus), key)  # both copies from one frame, in one order
        spread.sortWithinPartitions("date_id").write.parquet(f"{root}/flat/{name}")
        spread.repartition("annee").sortWithinPartitions("date_id").write.partitionBy("annee").parquet(f"{root}/part/{name}")
    layouts = {layout: (lambda name, layout=layout: spark.read.parquet(f"{root}/{layout}/{name}"))
               for layout in ("flat", "part")}
    for layout, fact in layouts.items():
        for name, question in gold_queries(fact, table, layout).items():
            cold[name], times[name] = timed(lambda: noop(question()), runs)
    for name in FROM_RAW:
        cold[name], times[name] = timed(lambda: noop(QUERIES[name](spark, folder)), 1)

    scanned = {f"{name}_{layout}": scanned_bytes(fact(name).filter(f"annee = {YEAR}")).first()["octets"]
               for layout, fact in layouts.items() for name in facts}
    rows = {name: layouts["flat"](name).count() for name in facts}
    print(json.dumps({
        "metric": "warehouse_total_warm_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": {name: round(t, 3) for name, t in times.items()},
        "cold": {name: round(t, 3) for name, t in cold.items()},
        "bytes_one_year": scanned, "rows": rows, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "cpus": cpus}))


if __name__ == "__main__":
    main()
