"""Benchmark: registered queries + the end-to-end job at $BENCH_SF_DIR.

Runs on local[$BENCH_CPUS] in one warm session: every query is executed once
to warm up, then timed (median of 5 for the headline queries, of 3 for others). Execution goes to Spark's
``noop`` sink, so the whole plan runs but no rows travel to the driver.
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from liftlens.config import build_session  # noqa: E402
from liftlens.plans.catalog import QUERIES  # noqa: E402
from liftlens.plans.job import run_all  # noqa: E402
from liftlens.sources.events import driver_events  # noqa: E402

HEADLINE = ("conversions_7d", "daily_metrics", "summary_metrics", "significance",
            "filtered_summary_slice", "summary_enriched")
RUNS = int(os.environ.get("BENCH_RUNS", "5"))


def _run(df) -> float:
    t = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(cores=cpus, app_name="liftlens-bench")
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

    timings: dict[str, float] = {}
    for name, fn in QUERIES.items():
        if only and name not in only:
            continue
        df = fn(spark, sf_dir)
        _run(df)  # warm-up: codegen, file listing, JIT
        runs = RUNS if name in HEADLINE else min(RUNS, 3)
        timings[name] = statistics.median(_run(df) for _ in range(runs))

    if not only or "run_all" in only:
        # $BENCH_SCRATCH, else the shared folder of the cluster, else the session's warehouse
        shared = (os.environ.get("BENCH_SCRATCH") or spark.conf.get("spark.checkpoint.dir", None)
                  or spark.conf.get("spark.sql.warehouse.dir"))
        scratch = f"{shared.rstrip('/')}/liftlens-bench-{int(time.time())}"
        runs = []
        for i in range(max(2, RUNS // 2) + 1):
            t = time.perf_counter()
            run_all(driver_events(spark, sf_dir), f"{scratch}/wh{i}", f"{scratch}/rep{i}")
            runs.append(time.perf_counter() - t)
        timings["run_all"] = statistics.median(runs[1:])

    headline = {q: timings[q] for q in HEADLINE if q in timings}
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({
        "metric": "headline_query_seconds_sum",
        "value": round(sum(headline.values()), 4),
        "unit": "sec",
        "queries": {k: round(v, 4) for k, v in timings.items()},
        "headline": sorted(headline),
        "all_queries_sum": round(sum(v for k, v in timings.items() if k != "run_all"), 4),
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": cpus,
        "shuffle_partitions": int(spark.conf.get("spark.sql.shuffle.partitions")),
        "runs": RUNS,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
