"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is executed in full with the ``noop`` sink (every row computed,
nothing collected to the driver) and timed ``BENCH_RUNS`` times (default 2);
the JSON line on stdout reports each query's best time and their sum.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from dialtone.plans.queries import ALL_QUERIES  # noqa: E402
from dialtone.session import build_session  # noqa: E402

HEADLINE = [
    "ivr_detail",                 # three-level flatten, skew-safe joins
    "summary_max",                # flagship: fused summary, skew-safe repeat flags
    "summary_best_row",           # method 2, fused
    "recency_flags",              # repeat flags, dense positions (skew-safe, default)
    "ranked_values",              # rank in call, range-partitioned
    "call_flags",
    "values_per_key_histogram",
    "collect_parallel",
    "validate_model",
    "assign_key",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    extra = {"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "8g"),
             "spark.sql.files.maxPartitionBytes": str(32 * 1024 * 1024)}
    if os.environ.get("BENCH_EVENT_LOG_DIR"):
        # stage/task times for tools/stage_times.py (a scratch folder, never the UI)
        extra.update({"spark.eventLog.enabled": "true",
                      "spark.eventLog.dir": os.environ["BENCH_EVENT_LOG_DIR"]})
    spark = build_session(f"local[{cpus}]", shuffle_partitions=2 * cpus,
                          app_name="dialtone-bench", extra=extra)
    spark.sparkContext.setLogLevel("ERROR")
    # Warm the JVM (class loading, code generation caches) on a small query.
    ALL_QUERIES["date_id"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    times: dict[str, float] = {}
    for name in names:
        best = None
        for _ in range(runs):
            df = ALL_QUERIES[name](spark, sf_dir)
            t0 = time.perf_counter()
            df.write.format("noop").mode("overwrite").save()
            t = time.perf_counter() - t0
            best = t if best is None else min(best, t)
        times[name] = round(best, 3)
    spark.stop()
    sf = os.path.basename(os.path.normpath(sf_dir)).replace("sf", "")
    print(json.dumps({"metric": "headline_total_sec", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus,
                      "stat": f"best of {runs} runs"}))


if __name__ == "__main__":
    main()
