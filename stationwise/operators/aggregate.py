"""Gold aggregates over properties with transit (silver)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stationwise.constants import NEAR_BUCKET, NEIGHBOURHOOD_NAMES, SKETCH_ACCURACY
from stationwise.functions.labels import name_lookup
from stationwise.operators.quantile import percentile_of_counts, shared

CODE = "neighbourhood_code"
BUCKET = "transit_proximity_category"


def add_neighbourhood_names(
    df: DataFrame,
    names: Mapping[str, str] | DataFrame = NEIGHBOURHOOD_NAMES,
    code: str = CODE,
    out: str = "neighbourhood_name",
) -> DataFrame:
    """Attach a display name per code; unknown or null code -> null.

    A mapping becomes a constant map expression (no join). A DataFrame of
    (code, name) is left-joined, whatever way Spark sizes the join; a code
    that it lists with different names is an error, not extra rows.
    """
    if isinstance(names, DataFrame):
        cols = names.columns
        known = names.select(F.col(cols[0]).cast("string").alias("_name_code"), F.col(cols[1]).alias(out))
        one = F.when(F.min(out).eqNullSafe(F.max(out)), F.min(out)).otherwise(
            F.raise_error(F.concat(F.lit("two names for code "), F.col("_name_code"))).cast("string")
        )
        dim = known.groupBy("_name_code").agg(one.alias(out))
        joined = df.join(dim, F.col(code).cast("string") == F.col("_name_code"), "left")
        return joined.drop("_name_code")
    return df.withColumn(out, name_lookup(code, names))


def _with_groups(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left join on grouping keys, null keys matching."""
    renamed = right.select(*(F.col(k).alias(f"_r_{k}") for k in keys), *(c for c in right.columns if c not in keys))
    condition = F.lit(True)
    for k in keys:
        condition = condition & left[k].eqNullSafe(renamed[f"_r_{k}"])
    return left.join(renamed, condition, "left").drop(*(f"_r_{k}" for k in keys))


def gold_detail(
    silver: DataFrame,
    names: Mapping[str, str] | DataFrame = NEIGHBOURHOOD_NAMES,
    median: str = "exact",
    accuracy: int = SKETCH_ACCURACY,
    order: bool = True,
) -> DataFrame:
    """Per code x proximity bucket: counts, value statistics, station.

    Land values are counted per group and station first; all figures are computed from
    that table, so silver is read once. ``median="exact"`` (default) gives the lower middle value exactly
    without gathering a group in one task (operators/quantile.py);
    ``median="approx"`` takes a ``percentile_approx`` pass over silver besides.
    ``primary_station`` is the most common station name of the group
    (ties -> the smallest name).
    """
    if median not in ("exact", "approx"):
        raise ValueError("median must be 'exact' or 'approx'")
    keys = [CODE, BUCKET]
    measures = {"total": "total_assessed_value", "distance": "distance_km", "change": "land_value_change_pct"}
    land = "current_land_value"
    if median == "approx":
        sketch = silver.groupBy(*keys).agg(F.round(F.percentile_approx(land, 0.5, accuracy), 0).alias("median_land_value"))
    # silver is read once: everything else comes from its counted land values
    parts = [F.count("property_id").alias("ids"), F.count(F.lit(1)).alias("rows")]
    for name, column in measures.items():
        parts += [F.sum(column).alias(f"{name}_sum"), F.count(column).alias(f"{name}_n")]
    numbers = [land, "ids", "rows", *(f"{name}_{x}" for name in measures for x in ("sum", "n"))]
    counted = shared(silver.groupBy(*keys, "station_name", land).agg(*parts), [*keys, "station_name"], numbers)

    known = F.when(F.col(land).isNotNull(), F.col("rows"))
    sums = {c: F.sum(c) for c in numbers[1:]} | {"land_sum": F.sum(F.col(land) * F.col("rows")), "land_n": F.sum(known), "low": F.min(land), "high": F.max(land)}
    stations = counted.groupBy(*keys, "station_name").agg(*(x.alias(c) for c, x in sums.items()))
    group = Window.partitionBy(*keys)
    first = group.orderBy(F.col("station_name").isNull(), F.col("rows").desc(), "station_name")
    over = {c: {"low": F.min, "high": F.max}.get(c, F.sum)(c).over(group).alias(c) for c in sums}
    summary = stations.select(*keys, "station_name", *over.values(), F.row_number().over(first).alias("place")).where("place = 1")

    def mean(name: str, decimals: int) -> Column:
        return F.round(F.try_divide(F.col(f"{name}_sum"), F.col(f"{name}_n")), decimals)

    summary = summary.select(
        *keys,
        F.col("ids").cast("long").alias("property_count"),
        mean("land", 0).alias("avg_land_value"),
        mean("total", 0).alias("avg_total_assessed_value"),
        F.round("low", 0).alias("min_land_value"),
        F.round("high", 0).alias("max_land_value"),
        mean("distance", 3).alias("avg_distance_to_station_km"),
        mean("change", 2).alias("avg_yoy_change_pct"),
        F.col("station_name").alias("primary_station"),
    )
    if median == "exact":
        sketch = percentile_of_counts(counted, keys, land, "rows", alias="median_land_value").withColumn("median_land_value", F.round("median_land_value", 0))
    summary = _with_groups(summary, sketch, keys)
    summary = summary.select(
        *keys,
        "property_count",
        "avg_land_value",
        "avg_total_assessed_value",
        "median_land_value",
        "min_land_value",
        "max_land_value",
        "avg_distance_to_station_km",
        "primary_station",
        "avg_yoy_change_pct",
    )
    summary = add_neighbourhood_names(summary, names)
    return summary.orderBy(*keys) if order else summary


def gold_overview(
    silver: DataFrame,
    names: Mapping[str, str] | DataFrame = NEIGHBOURHOOD_NAMES,
    near_label: str = NEAR_BUCKET,
    order: bool = True,
) -> DataFrame:
    """One row per code: count, mean land value and distance, near share, mean change.

    ``pct_within_500m_station`` counts every row of the near bucket (also
    rows without an id) over the count of ids; a zero count gives null.
    """
    share = F.try_divide(F.count_if(F.col(BUCKET) == near_label), F.count("property_id")) * 100
    overview = silver.groupBy(CODE).agg(
        F.count("property_id").alias("total_properties"),
        F.round(F.avg("current_land_value"), 0).alias("avg_land_value"),
        F.round(F.avg("distance_km"), 3).alias("avg_distance_to_station_km"),
        F.round(share, 1).alias("pct_within_500m_station"),
        F.round(F.avg("land_value_change_pct"), 2).alias("avg_yoy_change_pct"),
    )
    overview = add_neighbourhood_names(overview, names)
    return overview.orderBy(F.col("avg_land_value").desc_nulls_last(), F.col(CODE).asc_nulls_last()) if order else overview


def bucket_summary(silver: DataFrame) -> DataFrame:
    """Per proximity bucket: count of ids, mean land value, true (interpolated) median.

    Five buckets means every group is a large share of the table; the
    median is exact and distributed, and mean and count come from the same counted
    values (operators/quantile.py).
    """
    land = "current_land_value"
    counted = silver.groupBy(BUCKET, land).agg(F.count("property_id").alias("ids"), F.count(F.lit(1)).alias("rows"))
    counted = shared(counted, [BUCKET], [land, "ids", "rows"])
    known = F.when(F.col(land).isNotNull(), F.col("rows"))
    mean = F.try_divide(F.sum(F.col(land) * F.col("rows")), F.sum(known))
    means = counted.groupBy(BUCKET).agg(F.sum("ids").cast("long").alias("property_count"), mean.alias("avg_land_value"))
    exact = percentile_of_counts(counted, [BUCKET], land, "rows", interpolate=True, alias="median_land_value")
    return _with_groups(means, exact, [BUCKET]).orderBy(BUCKET)
