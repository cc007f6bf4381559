"""Final plans of registered queries: what is scanned, and how often."""

import os
import re

import pytest

from stationwise.operators import dq_report, dq_report_by_code, enrich_properties, nearest_station, of_named
from stationwise.plans import queries as q
from stationwise.sources import fixtures as fx

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def scans(plan: str, table: str) -> int:
    return len(re.findall(rf"FileScan parquet[^\n]*/{table}\.parquet", plan))


@pytest.mark.parametrize("name", ["gold_detail", "bucket_summary", "dq_report", "detail_by_name"])
def test_orders_is_scanned_once_and_aggregates_hash(spark, name):
    plan = final_plan(q.QUERIES[name](spark, SF))
    assert scans(plan, "orders") == 1
    assert "SortAggregate" not in plan


def test_stations_need_no_sort_aggregate(spark):
    plan = final_plan(q.QUERIES["stations"](spark, SF))
    assert "SortAggregate" not in plan and "WindowGroupLimit" in plan


def test_name_filter_lies_below_the_aggregates(spark):
    df = q.QUERIES["detail_by_name"](spark, SF)
    logical = df._jdf.queryExecution().optimizedPlan().toString()
    found = [i for i, line in enumerate(logical.splitlines()) if "Filter " in line and re.search(r"= 2\)|\bIN \(2\)", line)]
    aggregates = [i for i, line in enumerate(logical.splitlines()) if "Aggregate" in line]
    assert len(found) >= 2 and min(found) > max(aggregates[:2])  # on both sides of the join that the aggregates read
    assert {r["neighbourhood_name"] for r in df.collect()} == {q.SERVE_NAME}


def test_named_rows_by_mapping_and_by_table(spark):
    silver = spark.createDataFrame([("1", 1), ("2", 2), ("3", 3), (None, 4)], "neighbourhood_code string, v int")
    names = {"1": "a", "2": "b", "3": "a"}
    table = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "code int, name string")
    for known in (names, table):
        assert sorted(r["v"] for r in of_named(silver, "a", known).collect()) == [1, 3]
        assert of_named(silver, "none", known).count() == 0


def test_report_by_code_equals_report(spark):
    properties = spark.createDataFrame([("1", 5.0), ("1", -2.0), ("2", None), (None, 9.0), ("7", 1.0)], "neighbourhood_code string, current_land_value double")
    centroids = spark.createDataFrame([("1", 49.0, -123.0), ("2", 10.0, 10.0), ("3", None, 2.0)], "neighbourhood_code string, neighbourhood_lat double, neighbourhood_lon double")
    stations = spark.createDataFrame([(1, "A", 49.0, -123.01), (2, "B", 49.0, -122.99), (3, "C", 12.0, 10.0)], "station_id long, station_name string, station_lat double, station_long double")
    for world in (stations, stations.limit(0)):
        want = dq_report(properties, enrich_properties(properties, centroids, world)).collect()
        got = dq_report_by_code(properties, nearest_station(centroids, world)).collect()
        assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, want), key=repr)
    empty = dq_report_by_code(properties.limit(0), nearest_station(centroids, stations)).collect()
    assert [(r["failures"], r["min_value"], r["passed"]) for r in empty] == [(0, None, True)] * 2


def test_nearest_has_no_exchange_on_a_constant_key(spark):
    plan = nearest_station(fx.centroids(spark, SF), fx.stops_raw(spark, SF).selectExpr("stop_id AS station_id", "stop_name AS station_name", "stop_lat AS station_lat", "stop_lon AS station_long"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    keys = set(re.findall(r"hashpartitioning\((.*?), \d+\)", text))
    assert not any("kind" in k for k in keys)
    assert "CartesianProduct" not in text and "NestedLoop" not in text
