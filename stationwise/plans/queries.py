"""Registered queries: one per operator of the inventory, over the driver's tables.

Every query reads the given tables (through ``sources.fixtures``), so its
work grows with them. Each callable takes ``(spark, sf_dir)`` and
returns a DataFrame without running a job: nothing is written or cached.
The lookups filter on their code before the aggregates.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationwise.operators import (
    add_neighbourhood_names,
    add_proximity_bucket,
    bucket_summary,
    cast_types,
    clean_properties,
    derive_values,
    dq_report_by_code,
    enrich_properties,
    filter_counts,
    filter_valid,
    gold_detail,
    gold_health,
    gold_overview,
    load_stations,
    nearest_station,
    of_named,
    preview_properties,
    rename_columns,
    serve_one,
    serve_overview,
    serve_transit_analysis,
    station_filter,
    top_neighbourhoods,
    unmatched_count,
)
from stationwise.functions import haversine_km, normalize_code
from stationwise.sources import centroid_table
from stationwise.sources import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]

SERVE_CODE = "2"
SERVE_NAME = "Kitsilano"
SERVE_MIN_PROPERTIES = 500
SERVE_SORT = "avg_distance_to_station_km"


# ------------------------------------------------------------- building blocks


def _clean(spark: SparkSession, sf: str) -> DataFrame:
    return clean_properties(fx.properties_raw(spark, sf))


def _stations(spark: SparkSession, sf: str, tied: bool = False) -> DataFrame:
    stops = fx.stops_tied(spark, sf) if tied else fx.stops_raw(spark, sf)
    return load_stations(stops, "Station")


def _enriched(spark: SparkSession, sf: str, tied: bool = False) -> DataFrame:
    return enrich_properties(_clean(spark, sf), fx.centroids(spark, sf), _stations(spark, sf, tied))


def _stop_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Each stop with the centroid of its supplier's nation (an equi-join)."""
    pairs = fx.stops_with_code(spark, sf).join(fx.centroids(spark, sf), "neighbourhood_code")
    return pairs.select(
        "stop_id",
        "neighbourhood_code",
        haversine_km("neighbourhood_lat", "neighbourhood_lon", "stop_lat", "stop_lon").alias("distance_km"),
    )


# ------------------------------------------------------------------- queries


def q_rename_columns(spark, sf):
    return rename_columns(fx.properties_raw(spark, sf))


def q_cast_types(spark, sf):
    return cast_types(rename_columns(fx.properties_raw(spark, sf)))


def q_derive_values(spark, sf):
    return derive_values(cast_types(rename_columns(fx.properties_raw(spark, sf))))


def q_filter_valid(spark, sf):
    return filter_valid(cast_types(rename_columns(fx.properties_raw(spark, sf))))


def q_clean_properties(spark, sf):
    return _clean(spark, sf)


def q_normalize_code(spark, sf):
    raw = fx.properties_raw(spark, sf)
    return raw.select(
        F.col("PID").alias("property_id"),
        F.col("NEIGHBOURHOOD_CODE").alias("raw_code"),
        normalize_code("NEIGHBOURHOOD_CODE").alias("neighbourhood_code"),
    )


def q_station_filter(spark, sf):
    return station_filter(fx.stops_raw(spark, sf))


def q_stations(spark, sf):
    return _stations(spark, sf)


def q_union_parts(spark, sf):
    return fx.stops_tied(spark, sf)


def q_haversine(spark, sf):
    return _stop_pairs(spark, sf)


def q_proximity_bucket(spark, sf):
    return add_proximity_bucket(_stop_pairs(spark, sf))


def q_neighbourhood_names(spark, sf):
    clean = _clean(spark, sf).select("property_id", "neighbourhood_code")
    return add_neighbourhood_names(clean)


def q_centroid_literal(spark, sf):
    return nearest_station(centroid_table(spark), _stations(spark, sf))


def q_nearest_station(spark, sf):
    return nearest_station(fx.centroids(spark, sf), _stations(spark, sf))


def q_nearest_station_tied(spark, sf):
    return nearest_station(fx.centroids(spark, sf), _stations(spark, sf, tied=True))


def q_nearest_supplier(spark, sf):
    return nearest_station(fx.customer_points(spark, sf), fx.supplier_stations(spark, sf), ties="one")


def q_enrich_properties(spark, sf):
    return _enriched(spark, sf)


def q_enrich_properties_tied(spark, sf):
    return _enriched(spark, sf, tied=True)


def q_unmatched_count(spark, sf):
    return unmatched_count(_enriched(spark, sf))


def q_filter_counts(spark, sf):
    return filter_counts(fx.properties_raw(spark, sf))


def q_dq_report(spark, sf):
    return dq_report_by_code(_clean(spark, sf), nearest_station(fx.centroids(spark, sf), _stations(spark, sf)))


def q_gold_detail(spark, sf):
    return gold_detail(_enriched(spark, sf))


def q_gold_overview(spark, sf):
    return gold_overview(_enriched(spark, sf))


def q_bucket_summary(spark, sf):
    return bucket_summary(_enriched(spark, sf))


def q_top_neighbourhoods(spark, sf):
    return top_neighbourhoods(gold_overview(_enriched(spark, sf), order=False))


def q_detail_by_name(spark, sf):
    return gold_detail(of_named(_enriched(spark, sf), SERVE_NAME), order=False)


def q_preview_properties(spark, sf):
    return preview_properties(_clean(spark, sf))


def q_gold_health(spark, sf):
    return gold_health(gold_overview(_enriched(spark, sf), order=False))


def q_serve_overview(spark, sf):
    return serve_overview(gold_overview(_enriched(spark, sf), order=False))


def q_serve_overview_min(spark, sf):
    overview = gold_overview(_enriched(spark, sf), order=False)
    return serve_overview(overview, SERVE_MIN_PROPERTIES, SERVE_SORT)


def q_serve_one(spark, sf):
    return serve_one(gold_overview(_enriched(spark, sf), order=False), SERVE_CODE, strict=False)


def q_serve_transit_analysis(spark, sf):
    one = _enriched(spark, sf).where(F.col("neighbourhood_code") == SERVE_CODE)
    return serve_transit_analysis(gold_detail(one, order=False), SERVE_CODE, strict=False)


QUERIES: dict[str, Query] = {
    "rename_columns": q_rename_columns,
    "cast_types": q_cast_types,
    "derive_values": q_derive_values,
    "filter_valid": q_filter_valid,
    "clean_properties": q_clean_properties,
    "normalize_code": q_normalize_code,
    "station_filter": q_station_filter,
    "stations": q_stations,
    "union_parts": q_union_parts,
    "haversine": q_haversine,
    "proximity_bucket": q_proximity_bucket,
    "neighbourhood_names": q_neighbourhood_names,
    "centroid_literal": q_centroid_literal,
    "nearest_station": q_nearest_station,
    "nearest_station_tied": q_nearest_station_tied,
    "nearest_supplier": q_nearest_supplier,
    "enrich_properties": q_enrich_properties,
    "enrich_properties_tied": q_enrich_properties_tied,
    "unmatched_count": q_unmatched_count,
    "filter_counts": q_filter_counts,
    "dq_report": q_dq_report,
    "gold_detail": q_gold_detail,
    "gold_overview": q_gold_overview,
    "bucket_summary": q_bucket_summary,
    "top_neighbourhoods": q_top_neighbourhoods,
    "detail_by_name": q_detail_by_name,
    "preview_properties": q_preview_properties,
    "gold_health": q_gold_health,
    "serve_overview": q_serve_overview,
    "serve_overview_min": q_serve_overview_min,
    "serve_one": q_serve_one,
    "serve_transit_analysis": q_serve_transit_analysis,
}
