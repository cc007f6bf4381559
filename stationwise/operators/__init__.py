"""DataFrame -> DataFrame operators (cleaning, stations, nearest, gold, serving, quality)."""

from stationwise.operators.aggregate import add_neighbourhood_names, bucket_summary, gold_detail, gold_overview
from stationwise.operators.clean import (
    cast_types,
    clean_properties,
    derive_values,
    filter_valid,
    rename_columns,
    valid_land_value,
)
from stationwise.operators.enrich import add_proximity_bucket, attach_nearest, enrich_properties
from stationwise.operators.nearest import candidate_pairs, nearest_station
from stationwise.operators.quality import dq_report, dq_report_by_code, filter_counts, gold_health, gold_health_at, unmatched_count
from stationwise.operators.quantile import exact_percentile, percentile_of_counts
from stationwise.operators.serving import (
    NeighbourhoodNotFound,
    codes_named,
    detail_by_name,
    of_named,
    preview_properties,
    serve_one,
    serve_overview,
    serve_transit_analysis,
    top_neighbourhoods,
)
from stationwise.operators.stations import dedupe_stations, load_stations, project_stations, station_filter

__all__ = [
    "NeighbourhoodNotFound",
    "add_neighbourhood_names",
    "add_proximity_bucket",
    "attach_nearest",
    "bucket_summary",
    "cast_types",
    "clean_properties",
    "codes_named",
    "dedupe_stations",
    "derive_values",
    "detail_by_name",
    "dq_report",
    "dq_report_by_code",
    "enrich_properties",
    "exact_percentile",
    "filter_counts",
    "filter_valid",
    "gold_detail",
    "gold_health",
    "gold_health_at",
    "gold_overview",
    "load_stations",
    "nearest_station",
    "of_named",
    "candidate_pairs",
    "percentile_of_counts",
    "preview_properties",
    "project_stations",
    "rename_columns",
    "serve_one",
    "serve_overview",
    "serve_transit_analysis",
    "station_filter",
    "top_neighbourhoods",
    "unmatched_count",
    "valid_land_value",
]
