"""Benchmark: run every registered query at one scale factor, print one JSON line.

Environment:
  BENCH_SF_DIR   source folder (default /root/testdata/sf0.1)
  BENCH_CPUS     local cores (default 8)
  BENCH_QUERIES  optional comma-separated subset of query names
  BENCH_REPEAT   timed runs per query, the median is kept (default 1)

Each query is built and executed into Spark's ``noop`` sink, so the whole
plan runs without shipping rows to the driver. A warm-up query runs first.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from martlet.plans.catalog import CATALOG  # noqa: E402
from martlet.session import build_session  # noqa: E402


def run_once(spark, fn, sf_dir: str) -> float:
    t0 = time.perf_counter()
    df = fn(spark, sf_dir)
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = max(1, int(os.environ.get("BENCH_REPEAT", "1")))
    wanted = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    names = wanted or list(CATALOG)

    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=cpus, app_name="martlet-bench")
    run_once(spark, CATALOG["sales_by_category"], sf_dir)  # warm-up: JIT, file listing, class loading

    timings: dict[str, float] = {}
    failed: dict[str, str] = {}
    for name in names:
        try:
            runs = [run_once(spark, CATALOG[name], sf_dir) for _ in range(repeat)]
            timings[name] = round(statistics.median(runs), 3)
        except Exception as exc:  # noqa: BLE001 - report and keep benchmarking the rest
            failed[name] = f"{type(exc).__name__}: {str(exc)[:200]}"
    spark.stop()

    sf = os.path.basename(sf_dir).removeprefix("sf")
    out = {
        "metric": "total_query_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "repeat": repeat,
    }
    if failed:
        out["failed"] = failed
    print(json.dumps(out))


if __name__ == "__main__":
    main()
