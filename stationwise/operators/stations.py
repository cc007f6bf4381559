"""Station selection from a stops table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stationwise.constants import STATION_TOKEN

STATION_COLUMNS = ("station_id", "station_name", "station_lat", "station_long")


def station_filter(stops: DataFrame, token: str = STATION_TOKEN, name_column: str = "stop_name") -> DataFrame:
    """Stops whose name contains ``token`` (case-sensitive); a null name is dropped."""
    return stops.where(F.col(name_column).contains(token))


def project_stations(stops: DataFrame) -> DataFrame:
    """Stops -> (station_id, station_name, station_lat, station_long) with double coordinates."""
    return stops.select(
        F.col("stop_id").alias("station_id"),
        F.col("stop_name").alias("station_name"),
        F.col("stop_lat").try_cast("double").alias("station_lat"),
        F.col("stop_lon").try_cast("double").alias("station_long"),
    )


def dedupe_stations(stations: DataFrame) -> DataFrame:
    """One row per station name: the one with the lowest ``station_id``, then latitude, then longitude (nulls first).

    The rank limit applies before the shuffle too: a name repeated by a third of
    all stops still leaves each task one row per name, and the survivor
    is deterministic under task retries.
    """
    order = Window.partitionBy("station_name").orderBy(*(F.col(c).asc_nulls_first() for c in ("station_id", "station_lat", "station_long")))
    return stations.withColumn("_place", F.row_number().over(order)).where("_place = 1").select(*STATION_COLUMNS)


def load_stations(stops: DataFrame, token: str | None = None) -> DataFrame:
    """Stops -> de-duplicated stations; filter by name first when ``token`` is given."""
    if token is not None:
        stops = station_filter(stops, token)
    return dedupe_stations(project_stations(stops))
