"""Fixed values and defaults.

Everything in the "fixed values" blocks must stay equal to the source
pipeline's values for results to agree; every operator takes them as
overridable arguments.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Bronze column name -> clean snake_case name (25 entries).
# ---------------------------------------------------------------------------
RENAME_MAP: dict[str, str] = {
    "PID": "property_id",
    "LEGAL_TYPE": "legal_type",
    "FOLIO": "folio",
    "LAND_COORDINATE": "land_coordinate",
    "ZONING_DISTRICT": "zoning_district",
    "ZONING_CLASSIFICATION": "zoning_classification",
    "LOT": "lot",
    "PLAN": "plan",
    "BLOCK": "block",
    "DISTRICT_LOT": "district_lot",
    "FROM_CIVIC_NUMBER": "street_number_from",
    "TO_CIVIC_NUMBER": "street_number_to",
    "STREET_NAME": "street_name",
    "PROPERTY_POSTAL_CODE": "postal_code",
    "NARRATIVE_LEGAL_LINE1": "legal_description",
    "NEIGHBOURHOOD_CODE": "neighbourhood_code",
    "REPORT_YEAR": "report_year",
    "CURRENT_LAND_VALUE": "current_land_value",
    "CURRENT_IMPROVEMENT_VALUE": "current_improvement_value",
    "TAX_ASSESSMENT_YEAR": "tax_year",
    "PREVIOUS_LAND_VALUE": "previous_land_value",
    "PREVIOUS_IMPROVEMENT_VALUE": "previous_improvement_value",
    "YEAR_BUILT": "year_built",
    "BIG_IMPROVEMENT_YEAR": "big_improvement_year",
    "TAX_LEVY": "tax_levy",
}

# Columns cast to double, then to int, when present.
DOUBLE_COLUMNS: tuple[str, ...] = (
    "current_land_value",
    "current_improvement_value",
    "previous_land_value",
    "previous_improvement_value",
    "tax_levy",
)
INT_COLUMNS: tuple[str, ...] = ("year_built", "report_year", "tax_year")

# Cleaning rules.
AS_OF_YEAR = 2024
MIN_BUILD_YEAR = 1800  # exclusive lower bound for a usable year_built
MAX_LAND_VALUE = 500_000_000  # exclusive upper bound on current_land_value

# Great-circle distance.
EARTH_RADIUS_KM = 6371.0
DISTANCE_DECIMALS = 4

# Distance buckets, upper bounds inclusive, in km; a null
# distance and anything beyond the last bound fall in FAR_BUCKET.
PROXIMITY_BUCKETS: tuple[tuple[float, str], ...] = (
    (0.5, "< 500m"),
    (1.0, "500m - 1km"),
    (2.0, "1km - 2km"),
    (5.0, "2km - 5km"),
)
FAR_BUCKET = "> 5km"
NEAR_BUCKET = "< 500m"

# A stop is a rail station when its name holds this text
# (case-sensitive).
STATION_TOKEN = "Station"

# Neighbourhood centroids (code, latitude, longitude).
NEIGHBOURHOOD_CENTROIDS: tuple[tuple[str, float, float], ...] = (
    ("1", 49.2668, -123.2010),
    ("2", 49.2672, -123.1638),
    ("3", 49.2467, -123.1622),
    ("4", 49.2361, -123.1891),
    ("5", 49.2257, -123.1238),
    ("6", 49.2093, -123.1237),
    ("7", 49.2651, -123.1280),
    ("8", 49.2479, -123.1419),
    ("9", 49.2322, -123.1571),
    ("10", 49.2215, -123.0856),
    ("11", 49.2453, -123.1167),
    ("12", 49.2093, -123.1010),
    ("13", 49.2631, -123.1009),
    ("14", 49.2739, -123.0705),
    ("15", 49.2500, -123.1010),
    ("16", 49.2454, -123.0793),
    ("17", 49.2200, -123.0299),
    ("18", 49.2174, -123.0611),
    ("19", 49.2479, -123.0454),
    ("20", 49.2174, -123.0611),
    ("21", 49.2791, -123.0490),
    ("22", 49.2479, -123.0454),
    ("23", 49.2454, -123.0793),
    ("24", 49.2200, -123.0299),
    ("25", 49.2408, -123.1175),
    ("26", 49.2827, -123.1207),
    ("27", 49.2888, -123.1394),
    ("28", 49.2888, -123.1394),
    ("29", 49.2827, -123.1207),
    ("30", 49.2827, -123.1207),
)

# Neighbourhood code -> display name (30 codes, 22 names).
NEIGHBOURHOOD_NAMES: dict[str, str] = {
    "1": "West Point Grey",
    "2": "Kitsilano",
    "3": "Arbutus Ridge",
    "4": "Dunbar-Southlands",
    "5": "Oakridge",
    "6": "Marpole",
    "7": "Fairview",
    "8": "Shaughnessy",
    "9": "Kerrisdale",
    "10": "Sunset",
    "11": "Cambie",
    "12": "Victoria-Fraserview",
    "13": "Mount Pleasant",
    "14": "Grandview-Woodland",
    "15": "Riley Park",
    "16": "Kensington-Cedar Cottage",
    "17": "Killarney",
    "18": "Victoria-Fraserview",
    "19": "Renfrew-Collingwood",
    "20": "Sunset",
    "21": "Hastings-Sunrise",
    "22": "Renfrew-Collingwood",
    "23": "Kensington-Cedar Cottage",
    "24": "Killarney",
    "25": "South Cambie",
    "26": "Downtown",
    "27": "West End",
    "28": "West End",
    "29": "Downtown",
    "30": "Downtown",
}

# Overview fields a caller may sort by (descending).
SERVING_SORT_FIELDS: tuple[str, ...] = (
    "avg_land_value",
    "total_properties",
    "avg_distance_to_station_km",
    "avg_yoy_change_pct",
    "pct_within_500m_station",
)

# Serving record layouts, in field order.
OVERVIEW_FIELDS: tuple[str, ...] = (
    "neighbourhood_code",
    "neighbourhood_name",
    "total_properties",
    "avg_land_value",
    "avg_distance_to_station_km",
    "pct_within_500m_station",
    "avg_yoy_change_pct",
)
TRANSIT_DETAIL_FIELDS: tuple[str, ...] = (
    "neighbourhood_code",
    "neighbourhood_name",
    "transit_proximity_category",
    "property_count",
    "avg_land_value",
    "median_land_value",
    "avg_distance_to_station_km",
    "primary_station",
    "avg_yoy_change_pct",
)

# Text a delimited-file reader treats as missing (the
# default missing-value tokens of the pandas CSV reader).
NULL_TOKENS: tuple[str, ...] = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

# Default rank accuracy of the approximate median (``percentile_approx``).
SKETCH_ACCURACY = 10_000
