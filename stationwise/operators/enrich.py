"""Attach the nearest station to each property and bucket the distance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationwise.constants import FAR_BUCKET, PROXIMITY_BUCKETS
from stationwise.functions.labels import proximity_bucket
from stationwise.functions.typing import normalize_code
from stationwise.operators.nearest import nearest_station


def attach_nearest(properties: DataFrame, nearest: DataFrame, code: str = "neighbourhood_code") -> DataFrame:
    """Left join properties to per-code nearest stations.

    Unmatched properties keep null station columns; tied stations fan a
    property out to one row per station. ``nearest`` holds one row per
    code (x ties); adaptive execution measures it while the query runs and
    broadcasts it if it fits the threshold; beyond that it
    splits a code that holds a large share of the properties.
    """
    if dict(properties.dtypes).get(code) != "string":
        # Numeric codes (e.g. re-inferred from partition paths) become the
        # text form used everywhere else; text codes were normalised when
        # cleaned and are joined as they are.
        properties = properties.withColumn(code, normalize_code(code))
    return properties.join(nearest, on=code, how="left")


def add_proximity_bucket(
    df: DataFrame,
    buckets: Sequence[tuple[float, str]] = PROXIMITY_BUCKETS,
    far_label: str = FAR_BUCKET,
    distance: str = "distance_km",
    out: str = "transit_proximity_category",
) -> DataFrame:
    return df.withColumn(out, proximity_bucket(distance, buckets, far_label))


def enrich_properties(
    properties: DataFrame,
    centroids: DataFrame,
    stations: DataFrame,
    ties: str = "all",
    buckets: Sequence[tuple[float, str]] = PROXIMITY_BUCKETS,
    far_label: str = FAR_BUCKET,
) -> DataFrame:
    """Clean properties -> properties with nearest station and bucket.

    The bucket depends only on the distance, so it is computed once per
    code on the small nearest-station table; after the join a property
    without a match (null distance) takes ``far_label``, as a null
    distance would.
    """
    nearest = nearest_station(centroids, stations, ties=ties).transform(add_proximity_bucket, buckets, far_label)
    out = "transit_proximity_category"
    return attach_nearest(properties, nearest).withColumn(out, F.coalesce(F.col(out), F.lit(far_label)))
