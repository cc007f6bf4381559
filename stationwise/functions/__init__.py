"""Column expressions (all JVM-side built-ins; no Python UDFs)."""

from stationwise.functions.geo import (
    central_angle_sql,
    great_circle_sql,
    haversine_km,
    haversine_sql,
)
from stationwise.functions.labels import name_lookup, proximity_bucket
from stationwise.functions.typing import normalize_code, null_tokens, to_double, to_int

__all__ = [
    "central_angle_sql",
    "great_circle_sql",
    "haversine_sql",
    "haversine_km",
    "name_lookup",
    "normalize_code",
    "null_tokens",
    "proximity_bucket",
    "to_double",
    "to_int",
]
