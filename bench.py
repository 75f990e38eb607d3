"""Benchmark: the full report and its heaviest steps on $BENCH_SF_DIR.

the ``noop`` sink; the median per query is reported.  Prints one JSON line:
``{"metric": ..., "value": total_sec, "unit": "sec", "queries": {...}, "sf": ...}``.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from perfmart.plans.catalog import QUERIES  # noqa: E402
from perfmart.session import get_session  # noqa: E402

HEADLINE = (
    "report_mart",        # the whole job, C1-C28 (all later steps run inside it)
    "pivot_sum",          # C1-C7 alone: recode + distinct + 26-key pivot
    "latest_per_key",     # C1-C10: + report date + newest row per 20 keys
    "unpivot_columns",    # C11+C13: reference feed to long periods
    "dedup_subset",       # A6 on lineitem: deterministic row per key
    "unpivot_measures",   # C13 operator on lineitem (4 measures)
    "join_left_multi",    # J2 on orders x lineitem aggregate
    "group_sum",          # A3 on lineitem
)


def _sf(path: str) -> str:
    base = os.path.basename(path.rstrip("/"))
    return base[2:] if base.startswith("sf") else base


def run_once(spark, fn, sf_dir) -> float:
    t = time.perf_counter()
    df = fn(spark, sf_dir)
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    keys = [k for k in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if k]
    spark = get_session(app="perfmart-bench")
    times: dict[str, float] = {}
    for key in keys:
        fn = QUERIES[key]
        run_once(spark, fn, sf_dir)
        times[key] = round(statistics.median(run_once(spark, fn, sf_dir) for _ in range(runs)), 3)
        print(f"# {key}: {times[key]}s", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "report_queries_median_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": _sf(sf_dir),
        "master": spark.sparkContext.master,
        "spark": spark.version,
    }))


if __name__ == "__main__":
    main()
