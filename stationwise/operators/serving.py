"""Read-side queries over the gold tables, as DataFrame functions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationwise.constants import NEIGHBOURHOOD_NAMES, OVERVIEW_FIELDS, SERVING_SORT_FIELDS, TRANSIT_DETAIL_FIELDS
from stationwise.sources.files import read_parquet_checked

CODE = "neighbourhood_code"


class GoldDataMissing(FileNotFoundError):
    """The gold tables have not been written."""


class NeighbourhoodNotFound(LookupError):
    """No gold row for the requested neighbourhood code."""


def _records(df: DataFrame, fields) -> DataFrame:
    return df.select(F.col(CODE).cast("string").alias(CODE), *[f for f in fields if f != CODE])


def _require_rows(df: DataFrame, code: str) -> DataFrame:
    if df.isEmpty():
        raise NeighbourhoodNotFound(f"neighbourhood {code!r} not found")
    return df


def serve_overview(overview: DataFrame, min_properties: int = 0, sort_by: str = "avg_land_value") -> DataFrame:
    """All neighbourhoods, optionally with a minimum size, sorted by a chosen metric.

    Sorting is descending with nulls last, ties broken by code; a field
    outside the allow-list leaves the rows unsorted (no error).
    """
    df = overview
    if min_properties > 0:
        df = df.where(F.col("total_properties") >= min_properties)
    df = _records(df, OVERVIEW_FIELDS)
    if sort_by in SERVING_SORT_FIELDS:
        df = df.orderBy(F.col(sort_by).desc_nulls_last(), F.col(CODE).asc_nulls_last())
    return df


def serve_one(overview: DataFrame, code: str, strict: bool = True) -> DataFrame:
    """The overview record of one code (exact text match, at most one row).

    Raises ``NeighbourhoodNotFound`` when there is none (a one-row probe of
    the filtered table); ``strict=False`` gives an empty result instead,
    without running a job.
    """
    df = _records(overview.where(F.col(CODE).cast("string") == F.lit(code)), OVERVIEW_FIELDS).limit(1)
    return _require_rows(df, code) if strict else df


def serve_transit_analysis(detail: DataFrame, code: str, strict: bool = True) -> DataFrame:
    """Every proximity-bucket record of one code, in bucket order."""
    df = _records(detail.where(F.col(CODE).cast("string") == F.lit(code)), TRANSIT_DETAIL_FIELDS)
    df = df.orderBy("transit_proximity_category")
    return _require_rows(df, code) if strict else df


def codes_named(name: str, names: Mapping[str, str] = NEIGHBOURHOOD_NAMES) -> list[str]:
    """The codes whose display name is ``name``."""
    return sorted(code for code, known in names.items() if known == name)


def of_named(silver: DataFrame, name: str, names: Mapping[str, str] | DataFrame = NEIGHBOURHOOD_NAMES) -> DataFrame:
    """The rows of the neighbourhood(s) carrying a display name, chosen by their codes: below aggregates and joins.

    A mapping becomes a list of codes that reaches the scan; a DataFrame of (code, name) a semi join.
    """
    if isinstance(names, DataFrame):
        code, label = names.columns
        wanted = names.where(F.col(label) == F.lit(name)).select(F.col(code).cast("string").alias(CODE))
        return silver.join(wanted, CODE, "left_semi")
    codes = codes_named(name, names)
    return silver.where(F.col(CODE).isin(codes) if codes else F.lit(False))


def detail_by_name(detail: DataFrame, name: str = "Kitsilano") -> DataFrame:
    """Rows of a stored detail table of the neighbourhood(s) carrying a display name; ``of_named`` filters before the aggregates."""
    return detail.where(F.col("neighbourhood_name") == F.lit(name))


def top_neighbourhoods(overview: DataFrame, n: int = 10, by: str = "avg_land_value") -> DataFrame:
    """The ``n`` neighbourhoods with the highest ``by`` (ties by code): a top-k."""
    return overview.orderBy(F.col(by).desc_nulls_last(), F.col(CODE).asc_nulls_last()).limit(n)


def preview_properties(cleaned: DataFrame, n: int = 10) -> DataFrame:
    """A stable ``n``-row preview of key silver columns (by property id)."""
    cols = [
        "property_id",
        "street_name",
        "neighbourhood_code",
        "current_land_value",
        "total_assessed_value",
        "year_built",
    ]
    return cleaned.select(*cols).orderBy(F.col("property_id").asc_nulls_last()).limit(n)


def stored_gold(spark: SparkSession, path: str) -> DataFrame:
    """A stored gold table, all part files; ``GoldDataMissing`` if the folder is absent or holds none."""
    try:
        return read_parquet_checked(spark, path)
    except FileNotFoundError as exc:
        raise GoldDataMissing(f"no gold data at {path}: run the batch job first") from exc
