"""Bronze -> silver property cleaning (rename, type, derive, filter).

Each step is a DataFrame -> DataFrame function, chained with
``DataFrame.transform``. Casts and derived columns are applied in one
``withColumns`` each, so analysis stays cheap and Catalyst collapses the
projections into a single codegen'd stage right above the scan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationwise.constants import (
    AS_OF_YEAR,
    DOUBLE_COLUMNS,
    INT_COLUMNS,
    MAX_LAND_VALUE,
    MIN_BUILD_YEAR,
    RENAME_MAP,
)
from stationwise.functions.typing import normalize_code, to_double, to_int


def rename_columns(df: DataFrame, mapping: Mapping[str, str] = RENAME_MAP) -> DataFrame:
    """Rename the columns that exist; absent names are ignored, others kept."""
    present = {old: new for old, new in mapping.items() if old in df.columns}
    return df.withColumnsRenamed(present) if present else df


def cast_types(
    df: DataFrame,
    double_columns: Sequence[str] = DOUBLE_COLUMNS,
    int_columns: Sequence[str] = INT_COLUMNS,
    code_column: str | None = "neighbourhood_code",
) -> DataFrame:
    """Type the numeric columns that exist and normalise the code.

    Malformed numbers become null (never an error); NaN becomes null.
    The code becomes text without leading zeros, the form every later
    join and lookup uses.
    """
    changes: dict[str, Column] = {}
    for c in double_columns:
        if c in df.columns:
            changes[c] = to_double(c)
    for c in int_columns:
        if c in df.columns:
            changes[c] = to_int(c)
    if code_column and code_column in df.columns:
        changes[code_column] = normalize_code(code_column)
    return df.withColumns(changes) if changes else df


def derive_values(df: DataFrame, as_of_year: int = AS_OF_YEAR, min_build_year: int = MIN_BUILD_YEAR) -> DataFrame:
    """Total value, absolute and percent land-value change, building age."""
    land = F.col("current_land_value")
    prev = F.col("previous_land_value")
    built = F.col("year_built")
    change = land - prev
    return df.withColumns(
        {
            "total_assessed_value": land + F.col("current_improvement_value"),
            "land_value_change": change,
            "land_value_change_pct": F.when(prev.isNotNull() & (prev > 0), change / prev * 100),
            "property_age_years": F.when(
                built.isNotNull() & (built > min_build_year), F.lit(as_of_year) - built
            ),
        }
    )


def valid_land_value(max_land_value: float = MAX_LAND_VALUE) -> Column:
    """Predicate kept by cleaning: land value present, positive, below the cap.

    A null value fails ``> 0`` (unknown is not true), so presence needs no
    third test; fewer copies of the value keep the pushed-down filter small.
    """
    land = F.col("current_land_value")
    return (land > 0) & (land < max_land_value)


def filter_valid(df: DataFrame, max_land_value: float = MAX_LAND_VALUE) -> DataFrame:
    """Drop rows whose land value is missing, non-positive or implausibly large."""
    return df.where(valid_land_value(max_land_value))


def clean_properties(
    raw: DataFrame,
    mapping: Mapping[str, str] = RENAME_MAP,
    as_of_year: int = AS_OF_YEAR,
    max_land_value: float = MAX_LAND_VALUE,
) -> DataFrame:
    """Full bronze -> silver cleaning chain (rename, cast, derive, filter)."""
    return (
        raw.transform(rename_columns, mapping)
        .transform(cast_types)
        .transform(derive_values, as_of_year)
        .transform(filter_valid, max_land_value)
    )
