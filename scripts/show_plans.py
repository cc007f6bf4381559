"""Print the physical-plan facts that matter at scale for the batch path.

Writes the bronze/silver layers for the given scale into a fresh scratch
folder, then for each step prints the scans (columns read, pushed
filters), join strategies, exchanges and aggregate modes of the final
adaptive plan.

Usage: python scripts/show_plans.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stationwise.operators import enrich_properties, gold_detail, gold_overview, load_stations  # noqa: E402
from stationwise.plans.jobs import Layout, run_batch  # noqa: E402
from stationwise.session import local_session  # noqa: E402
from stationwise.sources import fixtures as fx  # noqa: E402
from stationwise.sources import read_parquet_checked, read_partitioned  # noqa: E402

KEEP = re.compile(
    r"(Scan parquet|ReadSchema|PushedFilters|PartitionFilters|BroadcastHashJoin|SortMergeJoin|"
    r"BroadcastNestedLoopJoin|CartesianProduct|Exchange|HashAggregate|ObjectHashAggregate|SortAggregate|"
    r"Window|InMemoryTableScan)"
)


def facts(title: str, df) -> None:
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    print(f"\n### {title}\n```")
    seen = set()
    for line in plan.splitlines():
        m = KEEP.search(line)
        if not m:
            continue
        text = re.sub(r"#\d+L?", "", line.strip().lstrip("+-:* ").strip())
        text = re.sub(r"\[plan_id=\d+\]", "", text)[:180]
        if text not in seen:
            seen.add(text)
            print(text)
    print("```")


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session()
    base = tempfile.mkdtemp(prefix="stationwise-plans-")
    layout = Layout(base)
    fx.properties_raw(spark, sf).write.parquet(layout.bronze_properties)
    fx.stops_raw(spark, sf).where("stop_name LIKE '%Station%'").write.parquet(layout.bronze_stations)
    run_batch(spark, base, stages=["transform", "gold"], skip_ingestion=True, centroids=fx.centroids(spark, sf))

    props = read_partitioned(spark, layout.silver_properties, "neighbourhood_code")
    stations = load_stations(read_parquet_checked(spark, layout.bronze_stations))
    facts("enrich: cleaned silver x nearest station", enrich_properties(props, fx.centroids(spark, sf), stations))
    silver = read_partitioned(spark, layout.silver_transit, "transit_proximity_category")
    facts("gold overview over written silver", gold_overview(silver))
    facts("gold detail (exact median) over written silver", gold_detail(silver))
    spark.stop()


if __name__ == "__main__":
    main()
