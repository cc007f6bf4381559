from stationwise.operators import cast_types, clean_properties, derive_values, filter_valid, rename_columns


def test_rename_ignores_absent_and_keeps_extra(spark):
    df = spark.createDataFrame([("1", "a", "x")], "PID string, STREET_NAME string, EXTRA string")
    assert rename_columns(df).columns == ["property_id", "street_name", "EXTRA"]


def test_rename_all_25(spark):
    from stationwise.constants import RENAME_MAP

    cols = list(RENAME_MAP)
    df = spark.createDataFrame([tuple("v" for _ in cols)], ", ".join(f"{c} string" for c in cols))
    assert rename_columns(df).columns == list(RENAME_MAP.values())


def test_cast_only_present_columns(spark):
    df = spark.createDataFrame([("12.5", "1987.0", "007")], "current_land_value string, year_built string, neighbourhood_code string")
    r = cast_types(df).first()
    assert (r.current_land_value, r.year_built, r.neighbourhood_code) == (12.5, 1987, "7")
    assert dict(cast_types(df).dtypes) == {"current_land_value": "double", "year_built": "int", "neighbourhood_code": "string"}


def test_filter_edges(spark):
    vals = [None, 0.0, 499999999.0, 500000000.0, -1.0]
    df = spark.createDataFrame([(v,) for v in vals], "current_land_value double")
    assert [r[0] for r in filter_valid(df).collect()] == [499999999.0]


def test_percent_change(spark):
    rows = [(110.0, None, 1.0, None), (110.0, 0.0, 1.0, None), (110.0, -5.0, 1.0, None), (110.0, 100.0, 1.0, None)]
    df = spark.createDataFrame(rows, "current_land_value double, previous_land_value double, current_improvement_value double, year_built int")
    got = [r.land_value_change_pct for r in derive_values(df).collect()]
    assert got == [None, None, None, 10.0]


def test_age(spark):
    years = [1800, 1801, 2024, 2030, None]
    df = spark.createDataFrame(
        [(1.0, 1.0, 1.0, y) for y in years],
        "current_land_value double, previous_land_value double, current_improvement_value double, year_built int",
    )
    assert [r.property_age_years for r in derive_values(df).collect()] == [None, 223, 0, -6, None]


def test_total_value_null_when_part_missing(spark):
    df = spark.createDataFrame(
        [(10.0, None, 5.0, None)],
        "current_land_value double, current_improvement_value double, previous_land_value double, year_built int",
    )
    r = derive_values(df).first()
    assert r.total_assessed_value is None and r.land_value_change == 5.0


def test_clean_counts_match_fixture_table(spark):
    from conftest import SF_CHECK
    from stationwise.sources import fixtures as fx

    assert clean_properties(fx.properties_raw(spark, SF_CHECK)).count() == 14435
