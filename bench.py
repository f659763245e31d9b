"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the folder of the test tables, BENCH_CPUS the number of local cores. Each
query is planned and run in full twice; the faster run counts. One run before that warms up the JVM.

With BENCH_JOBS=1, ``jobs`` holds, once each and outside the total, a first ``refresh`` into an empty lake, a second one that finds
only the rows of the last two days, and a ``report`` of the checks of the stored tables.
"""

from __future__ import annotations

import json
import os
import time

from starloom.operators.checks import report
from starloom.plans import quality
from starloom.plans.star import refresh, stored
from starloom.registry.queries import QUERIES
from starloom.session import local_session, work_folder
from starloom.sources import adapters
from starloom.sources.lake import Lake

HEADLINES = (
    "star_rollup",
    "dedup_latest",
    "reconcile",
    "entity_360",
    "period_enrich",
    "fk_lookup",
    "rep_min",
    "surrogate_key",
    "hwm_read",
    "upsert",
    "model_stg_customer_support_events",
    "model_int_customer_monthly_360",
    "model_fct_customer_monthly_snapshot",
    "model_fct_support_event",
    "chk_not_null_staging",
    "chk_relationship_fact",
)
RUNS = 2


def timed(spark, folder: str, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def jobs(spark, folder: str) -> dict[str, float]:
    raw, lake = adapters.bronze(spark, folder), Lake(spark, work_folder(spark, "bench"))
    steps = {
        "refresh_first": lambda: refresh(spark, raw, lake),
        "refresh_again": lambda: refresh(spark, raw, lake),
        "report": lambda: report(stored(lake, raw), quality.production_checks()).collect(),
    }
    seconds = {}
    for name, step in steps.items():
        start = time.perf_counter()
        step()
        seconds[name] = round(time.perf_counter() - start, 3)
    return seconds


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores=cores, memory=os.environ.get("BENCH_MEMORY", "16g"))
    spark.sparkContext.setLogLevel("ERROR")
    timed(spark, folder, "model_fct_customer_monthly_snapshot")
    seconds = {name: round(min(timed(spark, folder, name) for _ in range(RUNS)), 3) for name in HEADLINES}
    whole = jobs(spark, folder) if os.environ.get("BENCH_JOBS") == "1" else {}
    spark.stop()
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "total_seconds", "value": total, "unit": "sec", "queries": seconds, "jobs": whole, "sf": float(scale)}))


if __name__ == "__main__":
    main()
