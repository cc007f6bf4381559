"""Sources and sinks: files (bronze/silver/gold), literal dimensions, fixtures."""

from stationwise.sources.files import (
    read_delimited,
    read_parquet_checked,
    read_partitioned,
    write_parquet,
    write_partitioned,
    write_single_file,
)
from stationwise.sources.literal import centroid_table

__all__ = [
    "centroid_table",
    "read_delimited",
    "read_parquet_checked",
    "read_partitioned",
    "write_parquet",
    "write_partitioned",
    "write_single_file",
]
