"""Great-circle distance as a native Spark expression (no Python UDF).

The expression is produced as SQL text and parsed once by ``F.expr``:
one call into the JVM instead of dozens of Column compositions.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stationwise.constants import DISTANCE_DECIMALS, EARTH_RADIUS_KM


def _ref(c: str) -> str:
    return c if c.startswith("(") or c.startswith("`") else f"`{c}`"


def central_angle_sql(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    """Haversine central angle in radians as SQL; null if any input is null.

    ``sqrt(a)`` is clamped at 1 so that near-antipodal points give pi
    instead of NaN. The clamp sits inside the null guard because
    ``least`` skips nulls and would otherwise invent an angle. Operation
    order follows the textbook formula, so results agree bit for bit
    with a plain float implementation before rounding.
    """
    a1, o1, a2, o2 = map(_ref, (lat1, lon1, lat2, lon2))
    s_lat = f"sin((radians({a2}) - radians({a1})) / 2)"
    s_lon = f"sin((radians({o2}) - radians({o1})) / 2)"
    a = f"{s_lat} * {s_lat} + cos(radians({a1})) * cos(radians({a2})) * ({s_lon} * {s_lon})"
    return (
        f"(CASE WHEN {a1} IS NOT NULL AND {o1} IS NOT NULL AND {a2} IS NOT NULL AND {o2} IS NOT NULL "
        f"THEN 2.0D * asin(least(1.0D, sqrt({a}))) END)"
    )


def great_circle_sql(lat1: str, lon1: str, lat2: str, lon2: str, radius_km: float = EARTH_RADIUS_KM) -> str:
    return f"({float(radius_km)!r}D * {central_angle_sql(lat1, lon1, lat2, lon2)})"


def haversine_sql(
    lat1: str,
    lon1: str,
    lat2: str,
    lon2: str,
    radius_km: float = EARTH_RADIUS_KM,
    decimals: int = DISTANCE_DECIMALS,
) -> str:
    return f"round({great_circle_sql(lat1, lon1, lat2, lon2, radius_km)}, {int(decimals)})"


def haversine_km(
    lat1: str,
    lon1: str,
    lat2: str,
    lon2: str,
    radius_km: float = EARTH_RADIUS_KM,
    decimals: int = DISTANCE_DECIMALS,
) -> Column:
    """Haversine distance in km rounded to ``decimals`` places (column names in)."""
    return F.expr(haversine_sql(lat1, lon1, lat2, lon2, radius_km, decimals))
