import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from stationwise.functions import haversine_km
from stationwise.operators import candidate_pairs, nearest_station

CENT = "neighbourhood_code string, neighbourhood_lat double, neighbourhood_lon double"
ST = "station_id long, station_name string, station_lat double, station_long double"


def brute(cents, stations, ties="all"):
    """Every pair, ranked: the definition the grid search must reproduce."""
    pairs = cents.crossJoin(stations).withColumn(
        "distance_km", haversine_km("neighbourhood_lat", "neighbourhood_lon", "station_lat", "station_long")
    )
    order = F.col("distance_km").asc_nulls_first()
    if ties == "one":
        w = Window.partitionBy("neighbourhood_code").orderBy(order, "station_name", "station_id")
        fn = F.row_number().over(w)
    else:
        fn = F.rank().over(Window.partitionBy("neighbourhood_code").orderBy(order))
    return pairs.withColumn("r", fn).where("r = 1").select(
        "neighbourhood_code", "station_id", "station_name", "station_lat", "station_long", "distance_km"
    )


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def random_world(seed, n_cent=60, n_st=300):
    rnd = random.Random(seed)
    cents, stations = [], []
    for i in range(n_cent):
        kind = rnd.random()
        if kind < 0.3:  # city-sized cluster
            lat, lon = 49.2 + rnd.random() * 0.1, -123.2 + rnd.random() * 0.2
        elif kind < 0.4:  # near a pole
            lat, lon = rnd.choice([-1, 1]) * (89.0 + rnd.random()), rnd.uniform(-180, 180)
        elif kind < 0.5:  # across the antimeridian
            lat, lon = rnd.uniform(-60, 60), rnd.choice([-179.999, 179.999, 180.0, -180.0])
        else:
            lat, lon = rnd.uniform(-90, 90), rnd.uniform(-180, 180)
        cents.append((str(i % 45), lat, lon))  # codes repeat: several points per code
    for j in range(n_st):
        kind = rnd.random()
        if kind < 0.5:
            lat, lon = 49.2 + rnd.random() * 0.1, -123.2 + rnd.random() * 0.2
        elif kind < 0.6:
            lat, lon = rnd.choice([-1, 1]) * (88.0 + 2 * rnd.random()), rnd.uniform(-180, 180)
        else:
            lat, lon = rnd.uniform(-90, 90), rnd.uniform(-180, 180)
        stations.append((j, f"S{j % 250}", lat, lon))
    # exact duplicates and co-located twins make rank ties
    stations += [(10_000 + j, f"T{j}", s[2], s[3]) for j, s in enumerate(stations[:20])]
    cents += cents[:5]
    return cents, stations


def test_grid_search_equals_all_pairs(spark):
    for seed in (1, 2, 3):
        cents, stations = random_world(seed)
        c = spark.createDataFrame(cents, CENT)
        s = spark.createDataFrame(stations, ST)
        assert rows(nearest_station(c, s)) == rows(brute(c, s)), seed


def test_grid_search_ties_one(spark):
    cents, stations = random_world(7)
    c = spark.createDataFrame(cents, CENT)
    s = spark.createDataFrame(stations, ST)
    got = rows(nearest_station(c, s, ties="one"))
    assert got == rows(brute(c, s, ties="one"))
    assert len(got) == len({r[0] for r in cents})


def test_sparse_far_stations(spark):
    c = spark.createDataFrame([("a", 0.0, 0.0), ("b", -45.0, 170.0), ("c", 89.9, 10.0)], CENT)
    s = spark.createDataFrame([(1, "x", 10.0, 100.0), (2, "y", -80.0, -170.0), (3, "z", 0.0, -179.0)], ST)
    assert rows(nearest_station(c, s)) == rows(brute(c, s))


def test_equal_distance_both_kept(spark):
    c = spark.createDataFrame([("1", 49.25, -123.1)], CENT)
    s = spark.createDataFrame([(1, "A", 49.26, -123.1), (2, "B", 49.24, -123.1), (3, "C", 49.3, -123.1)], ST)
    got = nearest_station(c, s).collect()
    assert sorted(r.station_id for r in got) == [1, 2]


def test_null_coordinate_station_ranks_first(spark):
    c = spark.createDataFrame([("1", 49.25, -123.1), ("2", 49.2, -123.0)], CENT)
    s = spark.createDataFrame([(1, "A", 49.25, -123.1), (2, "N", None, -123.0)], ST)
    got = rows(nearest_station(c, s))
    assert [(r[0], r[1], r[5]) for r in got] == [("1", 2, None), ("2", 2, None)]
    assert got == rows(brute(c, s))


def test_null_coordinate_centroid_ties_with_all(spark):
    c = spark.createDataFrame([("1", None, -123.1), ("2", 49.2, -123.0)], CENT)
    s = spark.createDataFrame([(1, "A", 49.25, -123.1), (2, "B", 49.2, -123.0)], ST)
    got = rows(nearest_station(c, s))
    assert got == rows(brute(c, s))
    assert sum(1 for r in got if r[0] == "1") == 2


def test_no_stations_no_rows(spark):
    c = spark.createDataFrame([("1", 49.25, -123.1)], CENT)
    s = spark.createDataFrame([], ST)
    assert nearest_station(c, s).count() == 0


def test_plan_has_no_cartesian_product_for_placeable_rows(spark):
    c = spark.createDataFrame([("1", 49.25, -123.1)], CENT)
    s = spark.createDataFrame([(1, "A", 49.26, -123.1)], ST)
    plan = nearest_station(c, s)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_driver_tables_with_a_hot_cell_match_all_pairs(spark):
    import importlib.util
    import os

    from conftest import SF_SMALL

    path = os.path.join(os.path.dirname(os.path.dirname(__file__)), "scripts", "scale_nearest.py")
    spec = importlib.util.spec_from_file_location("scale_nearest", path)
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    # a key range keeps the all-pairs reference below small and deterministic
    c = mod.points(spark, SF_SMALL).where("CAST(neighbourhood_code AS BIGINT) < 300")
    s = mod.stations(spark, SF_SMALL)
    assert rows(nearest_station(c, s)) == rows(brute(c, s))


def test_ties_one_removes_fan_out_on_tied_stops(spark):
    from conftest import SF_CHECK
    from stationwise.operators import clean_properties, enrich_properties, load_stations
    from stationwise.sources import fixtures as fx

    clean = clean_properties(fx.properties_raw(spark, SF_CHECK))
    stations = load_stations(fx.stops_tied(spark, SF_CHECK), "Station")
    cents = fx.centroids(spark, SF_CHECK)
    assert enrich_properties(clean, cents, stations).count() == 28655
    assert enrich_properties(clean, cents, stations, ties="one").count() == 14435


@pytest.mark.parametrize("n_points,n_stations", [(100, 1000), (100, 4000)])
def test_points_outside_a_dense_cluster(spark, n_points, n_stations):
    """Seen from 3 km away, a cluster costs a point a few candidates, however many stations it holds."""
    rnd = random.Random(4)
    stations = spark.createDataFrame([(i, f"S{i}", 49.28 + rnd.random() * 0.004, -123.12 + rnd.random() * 0.004) for i in range(n_stations)], ST)
    cents = spark.createDataFrame([(str(i), 49.25 + rnd.random() * 0.002, -123.12 + rnd.random() * 0.004) for i in range(n_points)], CENT)
    points = cents.selectExpr("neighbourhood_lat AS plat", "neighbourhood_lon AS plon")
    assert candidate_pairs(points, stations).count() < 5 * n_points
    assert rows(nearest_station(cents, stations)) == rows(brute(cents, stations))


def joined_rows(df):
    """Rows that the joins of the executed plan gave out."""
    df.collect()

    def walk(node):
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            below = [node.executedPlan()]
        elif "QueryStage" in name:
            below = [node.plan()]
        else:
            below = [node.children().apply(i) for i in range(node.children().size())] if not name.startswith("ReusedExchange") else []
        own = node.metrics().apply("numOutputRows").value() if "Join" in name else 0
        return own + sum(map(walk, below))

    return walk(df._jdf.queryExecution().executedPlan())


def test_work_of_a_point_does_not_grow_with_the_stations(spark):
    """One station in each of 64 x 64 cells: a point meets a part of those near it, not a whole block of a thousand."""
    rnd = random.Random(9)
    stations = spark.createDataFrame([(i, f"S{i}", 49.0 + (i // 64 + rnd.random()) / 128, -123.0 + (i % 64 + rnd.random()) / 128) for i in range(4096)], ST)
    cents = spark.createDataFrame([(str(i), 49.0 + rnd.random() / 2, -123.0 + rnd.random() / 2) for i in range(400)], CENT)
    found = nearest_station(cents, stations)
    assert joined_rows(found) < 600 * 400
    assert rows(found) == rows(brute(cents, stations))


def test_ties_one_searches_a_place_once(spark):
    """Stations at one place, and points at one place, do not meet pair by pair."""
    stations = spark.createDataFrame([(i, f"S{i % 50}", 49.28, -123.12) for i in range(2000)] + [(9999, None, 49.3, -123.12), (5000, "N", 49.3, -123.12)], ST)
    cents = spark.createDataFrame([(str(i), 49.25 + i % 2 / 10, -123.12) for i in range(400)], CENT)
    found = nearest_station(cents, stations, ties="one")
    assert joined_rows(found) < 10 * 400
    assert rows(found) == rows(brute(cents, stations, ties="one"))
