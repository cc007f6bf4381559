import math

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stationwise.functions import haversine_km, name_lookup, normalize_code, proximity_bucket, to_double, to_int


def py_haversine(lat1, lon1, lat2, lon2):
    if None in (lat1, lon1, lat2, lon2):
        return None
    r = 6371.0
    p1, l1, p2, l2 = map(math.radians, (lat1, lon1, lat2, lon2))
    a = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin((l2 - l1) / 2) ** 2
    return round(r * 2 * math.asin(min(1.0, math.sqrt(a))), 4)


def test_bucket_edges(spark):
    vals = [0.5, 0.50001, 1.0, 2.0, 5.0, 5.1, None]
    df = spark.createDataFrame([(v,) for v in vals], "d double")
    got = [r[0] for r in df.select(proximity_bucket("d")).collect()]
    assert got == ["< 500m", "500m - 1km", "500m - 1km", "1km - 2km", "2km - 5km", "> 5km", "> 5km"]


def test_haversine_same_point_and_nulls(spark):
    df = spark.createDataFrame(
        [(49.2, -123.1, 49.2, -123.1), (None, -123.1, 49.2, -123.1), (49.2, None, 49.2, -123.1)],
        "a double, b double, c double, d double",
    )
    got = [r[0] for r in df.select(haversine_km("a", "b", "c", "d")).collect()]
    assert got == [0.0, None, None]


def test_haversine_antipodes_not_nan(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.0, 180.0), (90.0, 0.0, -90.0, 0.0)], "a double, b double, c double, d double")
    got = [r[0] for r in df.select(haversine_km("a", "b", "c", "d")).collect()]
    assert got == [round(math.pi * 6371.0, 4)] * 2


coord = st.tuples(
    st.floats(-90, 90, allow_nan=False),
    st.floats(-180, 180, allow_nan=False),
    st.floats(-90, 90, allow_nan=False),
    st.floats(-180, 180, allow_nan=False),
)


@settings(max_examples=5, deadline=None)
@given(st.lists(coord, min_size=1, max_size=200))
def test_haversine_matches_python(spark, rows):
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    got = [r[0] for r in df.select(haversine_km("a", "b", "c", "d")).collect()]
    want = [py_haversine(*r) for r in rows]
    assert all(abs(g - w) <= 1e-4 for g, w in zip(got, want))


def test_normalize_code(spark):
    df = spark.createDataFrame([("002",), ("010",), ("0",), ("1.0",), (None,)], "c string")
    assert [r[0] for r in df.select(normalize_code("c")).collect()] == ["2", "10", "0", "1.0", None]


def test_normalize_code_from_int(spark):
    df = spark.createDataFrame([(2,), (10,)], "c int")
    assert [r[0] for r in df.select(normalize_code("c")).collect()] == ["2", "10"]


def test_to_double(spark):
    df = spark.createDataFrame([("12",), ("x",), ("",), ("1,234",), ("NaN",), (None,)], "c string")
    assert [r[0] for r in df.select(to_double("c")).collect()] == [12.0, None, None, None, None, None]


def test_to_int(spark):
    df = spark.createDataFrame([("1987",), ("1987.0",), ("1987.9",), (" 1987 ",), ("x",), ("NaN",)], "c string")
    assert [r[0] for r in df.select(to_int("c")).collect()] == [1987, 1987, 1987, 1987, None, None]


def test_name_lookup(spark):
    df = spark.createDataFrame([("2",), ("99",), (None,)], "c string")
    assert [r[0] for r in df.select(name_lookup("c")).collect()] == ["Kitsilano", None, None]
    df = spark.createDataFrame([(26,)], "c int")
    assert df.select(name_lookup(F.col("c"))).first()[0] == "Downtown"
