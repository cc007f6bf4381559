"""Data-quality checks as Spark aggregates over whole tables (one pass each)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stationwise.constants import MAX_LAND_VALUE, RENAME_MAP
from stationwise.operators.clean import cast_types, rename_columns, valid_land_value

MAX_DISTANCE_KM = 100.0


def filter_counts(raw: DataFrame, max_land_value: float = MAX_LAND_VALUE) -> DataFrame:
    """Rows before and after cleaning, and rows dropped, in one pass over ``raw``."""
    typed = raw.transform(rename_columns, RENAME_MAP).transform(cast_types)
    return typed.agg(
        F.count(F.lit(1)).alias("raw_rows"),
        F.count_if(valid_land_value(max_land_value)).alias("clean_rows"),
    ).withColumn("dropped_rows", F.col("raw_rows") - F.col("clean_rows"))


def observe_counts(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Attach a row-count metric, filled by whatever action runs ``df`` next.

    Lets a job log counts without a separate counting pass.
    """
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def unmatched_count(enriched: DataFrame) -> DataFrame:
    """Properties whose neighbourhood found no station (null distance)."""
    return enriched.agg(
        F.count(F.lit(1)).alias("enriched_rows"),
        F.count_if(F.col("distance_km").isNull()).alias("unmatched_rows"),
    )


def dq_report(cleaned: DataFrame, enriched: DataFrame, max_distance_km: float = MAX_DISTANCE_KM) -> DataFrame:
    """One row per check: failures, observed range and a pass flag.

    * no negative land value in the cleaned properties;
    * every non-null distance lies in [0, max_distance_km).
    """
    land = F.col("current_land_value")
    dist = F.col("distance_km")
    land_check = cleaned.agg(
        F.lit("no_negative_land_value").alias("check_name"),
        F.count_if(land < 0).alias("failures"),
        F.min(land).alias("min_value"),
        F.max(land).alias("max_value"),
    )
    dist_check = enriched.agg(
        F.lit("distance_within_range").alias("check_name"),
        F.count_if((dist < 0) | (dist >= max_distance_km)).alias("failures"),
        F.min(dist).alias("min_value"),
        F.max(dist).alias("max_value"),
    )
    return land_check.unionByName(dist_check).withColumn("passed", F.col("failures") == 0)


def dq_report_by_code(cleaned: DataFrame, nearest: DataFrame, max_distance_km: float = MAX_DISTANCE_KM, code: str = "neighbourhood_code") -> DataFrame:
    """``dq_report`` in one pass over the cleaned properties, before they are enriched.

    A distance depends on the code alone. So properties are summed up by code, and each
    code's rows count as often as it has stations out of range; nothing fans out.
    """
    land = F.col("current_land_value")
    dist = F.col("distance_km")
    lands = cleaned.groupBy(F.col(code).alias("_code")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(land < 0).alias("land_failures"),
        F.min(land).alias("land_low"),
        F.max(land).alias("land_high"),
    )
    distances = nearest.groupBy(code).agg(
        F.count_if((dist < 0) | (dist >= max_distance_km)).alias("out_of_range"),
        F.min(dist).alias("low"),
        F.max(dist).alias("high"),
    )
    both = lands.join(distances, F.col("_code") == F.col(code), "left").agg(
        F.coalesce(F.sum("land_failures"), F.lit(0)).alias("land_failures"),
        F.min("land_low").alias("land_low"),
        F.max("land_high").alias("land_high"),
        F.coalesce(F.sum(F.col("rows") * F.col("out_of_range")), F.lit(0)).alias("distance_failures"),
        F.min("low").alias("distance_low"),
        F.max("high").alias("distance_high"),
    )
    checks = [("no_negative_land_value", "land"), ("distance_within_range", "distance")]
    rows = F.array(*(F.struct(F.lit(n).alias("check_name"), F.col(f"{c}_failures").alias("failures"), F.col(f"{c}_low").alias("min_value"), F.col(f"{c}_high").alias("max_value")) for n, c in checks))
    return both.select(F.explode(rows).alias("r")).select("r.*").withColumn("passed", F.col("failures") == 0)


HEALTHY_MESSAGE = "gold data is available"
DEGRADED_MESSAGE = "gold data is missing: run the batch job first"


def gold_health(overview: DataFrame) -> DataFrame:
    """Health of an existing gold overview, one row: available, with its full row count (0 is a count too)."""
    return overview.agg(
        F.lit("healthy").alias("status"),
        F.lit(True).alias("gold_data_available"),
        F.count(F.lit(1)).alias("neighbourhood_count"),
        F.lit(HEALTHY_MESSAGE).alias("message"),
    )


def gold_health_at(spark: SparkSession, path: str) -> DataFrame:
    """``gold_health`` of a stored overview table; a folder that is absent or holds no data file is 'degraded'."""
    from stationwise.sources.files import read_parquet_checked

    try:
        return gold_health(read_parquet_checked(spark, path))
    except FileNotFoundError:
        schema = "status string, gold_data_available boolean, neighbourhood_count bigint, message string"
        return spark.createDataFrame([("degraded", False, None, DEGRADED_MESSAGE)], schema)
