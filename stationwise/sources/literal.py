"""Literal dimension tables (fixed values from ``stationwise.constants``)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from stationwise.constants import NEIGHBOURHOOD_CENTROIDS

CENTROID_SCHEMA = StructType(
    [
        StructField("neighbourhood_code", StringType(), True),
        StructField("neighbourhood_lat", DoubleType(), True),
        StructField("neighbourhood_lon", DoubleType(), True),
    ]
)
NAME_SCHEMA = StructType(
    [
        StructField("neighbourhood_code", StringType(), True),
        StructField("neighbourhood_name", StringType(), True),
    ]
)


def centroid_table(
    spark: SparkSession, rows: Iterable[tuple[str, float, float]] = NEIGHBOURHOOD_CENTROIDS
) -> DataFrame:
    """Neighbourhood centroids as a small DataFrame with an explicit schema."""
    return spark.createDataFrame([tuple(r) for r in rows], schema=CENTROID_SCHEMA)
