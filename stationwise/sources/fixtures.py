"""Pipeline inputs derived from the driver's TPC-H-like tables.

An order plays a property (its customer's nation is the neighbourhood),
a nation plays a neighbourhood centroid and a supplier plays a transit
stop. Dirt is injected by key arithmetic, so every row of ``orders``
is kept and the work grows with the table. The same derivations are
written in SQL in ``stationwise.plans.oracle`` for the DuckDB check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c: Column) -> Column:
    return c.cast("string")


def _d(x) -> Column:
    return F.lit(x).cast("double") if not isinstance(x, Column) else x.cast("double")


def properties_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze property roll: upper-case source names, every value as text."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority"
    )
    customer = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", "c_acctbal", "c_name", "c_mktsegment"
    )
    k = "o_orderkey"
    code = "CAST(c_nationkey + 1 AS STRING)"
    columns = {
        "PID": f"CASE WHEN {k} % 211 = 0 THEN NULL ELSE concat('P', CAST({k} AS STRING)) END",
        "LEGAL_TYPE": "o_orderpriority",
        "ZONING_DISTRICT": "c_mktsegment",
        "FROM_CIVIC_NUMBER": "CAST(o_custkey AS STRING)",
        "STREET_NAME": "c_name",
        "NEIGHBOURHOOD_CODE": f"CASE WHEN {k} % 131 = 0 THEN '99' WHEN {k} % 137 = 0 THEN NULL "
        f"WHEN {k} % 7 = 0 THEN concat('0', {code}) ELSE {code} END",
        "REPORT_YEAR": f"CAST(2019 + {k} % 6 AS STRING)",
        "CURRENT_LAND_VALUE": f"CASE WHEN {k} % 101 = 0 THEN 'n/a' WHEN {k} % 103 = 0 THEN NULL "
        f"WHEN {k} % 107 = 0 THEN '0' WHEN {k} % 109 = 0 THEN '500000000' "
        f"WHEN {k} % 113 = 0 THEN '499999999' ELSE CAST(o_totalprice AS STRING) END",
        "CURRENT_IMPROVEMENT_VALUE": f"CASE WHEN {k} % 23 = 0 THEN NULL ELSE CAST(c_acctbal AS STRING) END",
        "TAX_ASSESSMENT_YEAR": f"CAST(CAST(2019 + {k} % 6 AS DOUBLE) AS STRING)",
        "PREVIOUS_LAND_VALUE": f"CASE WHEN {k} % 17 = 0 THEN '0' WHEN {k} % 19 = 0 THEN NULL "
        f"ELSE CAST(o_totalprice * (CAST(80 + {k} % 41 AS DOUBLE) / CAST(100 AS DOUBLE)) AS STRING) END",
        "PREVIOUS_IMPROVEMENT_VALUE": f"CASE WHEN {k} % 29 = 0 THEN 'NaN' ELSE CAST(c_acctbal AS STRING) END",
        "YEAR_BUILT": f"CAST(1780 + {k} % 250 AS STRING)",
        "BIG_IMPROVEMENT_YEAR": f"CAST(1990 + {k} % 30 AS STRING)",
        "TAX_LEVY": "CAST(CAST(o_totalprice AS DOUBLE) / CAST(250 AS DOUBLE) AS STRING)",
    }
    joined = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    return joined.selectExpr(*[f"{expr} AS {name}" for name, expr in columns.items()])


def centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Neighbourhood centroids: one per nation, spread over a city-sized box."""
    n = F.col("n_nationkey")
    return table(spark, sf_dir, "nation").select(
        _s(n + 1).alias("neighbourhood_code"),
        (_d(F.lit(49200) + (n * 37) % 100) / _d(1000)).alias("neighbourhood_lat"),
        (_d(F.lit(-123220) + ((n * 53) % 100) * 2) / _d(1000)).alias("neighbourhood_lon"),
    )


STOP_LAT = "CAST(49200 + (s_suppkey * 29) % 103 AS DOUBLE) / CAST(1000 AS DOUBLE)"
STOP_LON = "CAST(-123220 + ((s_suppkey * 61) % 107) * 2 AS DOUBLE) / CAST(1000 AS DOUBLE)"


def stops_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transit stops: every fifth supplier is a 'Station', names repeat every 40."""
    return table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey AS stop_id",
        "CASE WHEN s_suppkey % 5 = 0 THEN concat('Station ', CAST(s_suppkey % 40 AS STRING)) "
        "ELSE concat('Stop ', CAST(s_suppkey AS STRING)) END AS stop_name",
        f"{STOP_LAT} AS stop_lat",
        f"{STOP_LON} AS stop_lon",
    )


def stops_with_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stop with the neighbourhood code of its supplier's nation."""
    return table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey AS stop_id",
        "CAST(s_nationkey + 1 AS STRING) AS neighbourhood_code",
        f"{STOP_LAT} AS stop_lat",
        f"{STOP_LON} AS stop_lon",
    )


def stops_tied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stops plus a co-located twin of every station (distance ties)."""
    stops = stops_raw(spark, sf_dir)
    twins = stops.where(F.col("stop_name").like("%Station%")).select(
        (F.col("stop_id") + 1_000_000).alias("stop_id"),
        F.concat(F.lit("Twin "), F.col("stop_name")).alias("stop_name"),
        "stop_lat",
        "stop_lon",
    )
    return stops.unionByName(twins)


def customer_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer as a point of its own code: the point table grows with the data."""
    return table(spark, sf_dir, "customer").selectExpr(
        "CAST(c_custkey AS STRING) AS neighbourhood_code",
        "CAST(49100 + (c_custkey * 7919) % 997 AS DOUBLE) / CAST(1000 AS DOUBLE) AS neighbourhood_lat",
        "CAST(-123300 + (c_custkey * 6271) % 1499 AS DOUBLE) / CAST(1000 AS DOUBLE) AS neighbourhood_lon",
    )


def supplier_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every supplier as a station with a name of its own; nine in ten lie in one small cluster."""
    return table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey AS station_id",
        "s_name AS station_name",
        "CASE WHEN s_suppkey % 10 = 0 THEN CAST(49100 + (s_suppkey * 577) % 991 AS DOUBLE) / CAST(1000 AS DOUBLE) "
        "ELSE CAST(49280000 + (s_suppkey * 389) % 4999 AS DOUBLE) / CAST(1000000 AS DOUBLE) END AS station_lat",
        "CASE WHEN s_suppkey % 10 = 0 THEN CAST(-123300 + (s_suppkey * 613) % 1493 AS DOUBLE) / CAST(1000 AS DOUBLE) "
        "ELSE CAST(-123120000 + (s_suppkey * 677) % 4993 AS DOUBLE) / CAST(1000000 AS DOUBLE) END AS station_long",
    )
