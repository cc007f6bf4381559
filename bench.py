"""Benchmark the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS
(default 8), BENCH_RUNS (warm runs, default 3). Each query is built from
the raw tables and executed in full with the ``noop`` sink (no driver
collection); the reported time per query is the median of the warm runs
after one cold run.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from stationwise.plans.queries import QUERIES  # noqa: E402
from stationwise.session import local_session  # noqa: E402

HEADLINE = ("clean_properties", "enrich_properties", "gold_detail", "gold_overview", "bucket_summary", "nearest_supplier")


def run_once(spark, name: str, sf_dir: str) -> float:
    spark.catalog.clearCache()  # no cached small side carried between runs
    t0 = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or list(HEADLINE)
    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, app="stationwise-bench")
    cold, warm = {}, {}
    for name in names:
        cold[name] = run_once(spark, name, sf_dir)
        warm[name] = statistics.median(run_once(spark, name, sf_dir) for _ in range(runs))
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    out = {
        "metric": "median_warm_seconds_total",
        "value": round(sum(warm.values()), 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in warm.items()},
        "cold": {k: round(v, 3) for k, v in cold.items()},
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "spark": spark.version,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
