import pytest

from stationwise.operators import (
    NeighbourhoodNotFound,
    add_neighbourhood_names,
    bucket_summary,
    gold_detail,
    gold_overview,
    serve_one,
    serve_overview,
    serve_transit_analysis,
    top_neighbourhoods,
)

SILVER = (
    "property_id string, neighbourhood_code string, transit_proximity_category string, "
    "current_land_value double, total_assessed_value double, distance_km double, "
    "station_name string, land_value_change_pct double"
)


def silver(spark, rows):
    return spark.createDataFrame(rows, SILVER)


def test_detail_median_is_lower_middle_and_station_is_mode(spark):
    rows = [
        ("a", "2", "< 500m", 1.0, 2.0, 0.1, "B", 1.0),
        ("b", "2", "< 500m", 2.0, 3.0, 0.1, "A", None),
        ("c", "2", "< 500m", 3.0, 4.0, 0.1, "B", 3.0),
        ("d", "2", "< 500m", 4.0, 5.0, 0.1, "A", None),
        ("e", "2", "< 500m", 4.0, 5.0, 0.1, "B", None),
    ]
    for median in ("exact", "approx"):
        r = gold_detail(silver(spark, rows[:4]), median=median).first()
        assert r.median_land_value == 2.0
        assert r.primary_station == "A"  # tie between A and B: smallest name
    r = gold_detail(silver(spark, rows)).first()
    assert (r.property_count, r.median_land_value, r.primary_station, r.avg_yoy_change_pct) == (5, 3.0, "B", 2.0)
    assert r.neighbourhood_name == "Kitsilano"


def test_null_code_is_a_group(spark):
    rows = [(None, None, "> 5km", 5.0, 5.0, None, None, None), ("x", "99", "> 5km", 7.0, 7.0, None, None, None)]
    got = {r.neighbourhood_code: r for r in gold_detail(silver(spark, rows)).collect()}
    assert got[None].property_count == 0 and got[None].median_land_value == 5.0
    assert got["99"].neighbourhood_name is None


def test_share_within_500m(spark):
    rows = [
        ("a", "1", "< 500m", 1.0, 1.0, 0.2, "S", None),
        (None, "1", "< 500m", 1.0, 1.0, 0.2, "S", None),
        (None, "3", "< 500m", 1.0, 1.0, 0.2, "S", None),
    ]
    got = {r.neighbourhood_code: r.pct_within_500m_station for r in gold_overview(silver(spark, rows)).collect()}
    assert got == {"1": 200.0, "3": None}  # null ids count in the numerator only; zero ids -> null


def test_overview_order_and_names(spark):
    rows = [("a", "1", "< 500m", 1.0, 1.0, 0.2, "S", None), ("b", "26", "> 5km", 9.0, 9.0, 7.0, "T", None)]
    out = gold_overview(silver(spark, rows)).collect()
    assert [r.neighbourhood_code for r in out] == ["26", "1"]
    assert [r.neighbourhood_name for r in out] == ["Downtown", "West Point Grey"]


def test_names_from_dataframe(spark):
    df = spark.createDataFrame([("1",), ("7",)], "neighbourhood_code string")
    names = spark.createDataFrame([(1, "one")], "code int, name string")
    got = {r[0]: r[1] for r in add_neighbourhood_names(df, names).collect()}
    assert got == {"1": "one", "7": None}


def test_bucket_summary_true_median(spark):
    rows = [(str(i), "1", "< 500m", float(v), 0.0, 0.1, "S", None) for i, v in enumerate([1, 2, 3, 4])]
    r = bucket_summary(silver(spark, rows)).first()
    assert (r.property_count, r.avg_land_value, r.median_land_value) == (4, 2.5, 2.5)


def overview(spark):
    rows = [
        ("1", "A", 10, 5.0, 1.0, 0.0, 1.0),
        ("2", "B", 20, None, 2.0, 0.0, 2.0),
        ("3", "C", 30, 7.0, None, 100.0, 3.0),
    ]
    return spark.createDataFrame(
        rows,
        "neighbourhood_code string, neighbourhood_name string, total_properties long, avg_land_value double, "
        "avg_distance_to_station_km double, pct_within_500m_station double, avg_yoy_change_pct double",
    )


def test_serving_sort_nulls_last_and_unknown_field(spark):
    ov = overview(spark)
    assert [r[0] for r in serve_overview(ov).collect()] == ["3", "1", "2"]
    assert [r[0] for r in serve_overview(ov, sort_by="avg_distance_to_station_km").collect()] == ["2", "1", "3"]
    assert sorted(r[0] for r in serve_overview(ov, sort_by="no_such_field").collect()) == ["1", "2", "3"]
    assert [r[0] for r in serve_overview(ov, min_properties=15).collect()] == ["3", "2"]
    assert serve_overview(ov).columns[:3] == ["neighbourhood_code", "neighbourhood_name", "total_properties"]


def test_serving_lookup(spark):
    ov = overview(spark)
    assert serve_one(ov, "2").first().neighbourhood_name == "B"
    with pytest.raises(NeighbourhoodNotFound):
        serve_one(ov, "42")
    assert serve_one(ov, "42", strict=False).count() == 0


def test_transit_analysis_lookup(spark):
    rows = [("a", "2", "< 500m", 1.0, 1.0, 0.2, "S", None), ("b", "2", "> 5km", 3.0, 1.0, None, None, None)]
    detail = gold_detail(silver(spark, rows))
    got = serve_transit_analysis(detail, "2").collect()
    assert [r.transit_proximity_category for r in got] == ["< 500m", "> 5km"]
    assert len(got[0]) == 9
    with pytest.raises(NeighbourhoodNotFound):
        serve_transit_analysis(detail, "5")


def test_top_k(spark):
    assert [r[0] for r in top_neighbourhoods(overview(spark), 2).collect()] == ["3", "1"]


def test_order_holds_with_a_names_table_and_shuffle_joins(spark):
    rows = [(str(i), str(i % 40), "< 500m", float((i * 37) % 20 + 1), 1.0, 0.2, "S", None) for i in range(400)]
    names = spark.createDataFrame([(str(i), f"name {i}") for i in range(40)], "code string, name string").repartition(7)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = gold_overview(silver(spark, rows), names).collect()
        assert [(-r.avg_land_value, r.neighbourhood_code) for r in got] == sorted((-r.avg_land_value, r.neighbourhood_code) for r in got)
        assert all(r.neighbourhood_name == f"name {r.neighbourhood_code}" for r in got)
        detail = [r.neighbourhood_code for r in gold_detail(silver(spark, rows), names).collect()]
        assert detail == sorted(detail) and len(detail) == 40
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_two_names_for_a_code_raise(spark):
    df = spark.createDataFrame([("1",)], "neighbourhood_code string")
    names = spark.createDataFrame([("1", "a"), ("1", "b")], "code string, name string")
    with pytest.raises(Exception, match="two names for code 1"):
        add_neighbourhood_names(df, names).collect()
