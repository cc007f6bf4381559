"""Reference SQL for every registered query, runnable by DuckDB.

The tables ``orders customer supplier nation`` are views over the same
Parquet files. The SQL restates each operator's semantics the plain way
(a cross join and a rank for the nearest station, a sort for the
median): it is the independent check, not the implementation.
Arithmetic operands are cast to DOUBLE explicitly, because decimal
literals and integer division differ between engines.
"""

from __future__ import annotations

# Fixed values, spelt out here so that a wrong constant in the library shows.
MAX_LAND_VALUE = 500000000
FAR_BUCKET = "> 5km"
PROXIMITY_BUCKETS = ((0.5, "< 500m"), (1.0, "500m - 1km"), (2.0, "1km - 2km"), (5.0, "2km - 5km"))
NEIGHBOURHOOD_CENTROIDS = (
    ("1", 49.2668, -123.201),
    ("2", 49.2672, -123.1638),
    ("3", 49.2467, -123.1622),
    ("4", 49.2361, -123.1891),
    ("5", 49.2257, -123.1238),
    ("6", 49.2093, -123.1237),
    ("7", 49.2651, -123.128),
    ("8", 49.2479, -123.1419),
    ("9", 49.2322, -123.1571),
    ("10", 49.2215, -123.0856),
    ("11", 49.2453, -123.1167),
    ("12", 49.2093, -123.101),
    ("13", 49.2631, -123.1009),
    ("14", 49.2739, -123.0705),
    ("15", 49.25, -123.101),
    ("16", 49.2454, -123.0793),
    ("17", 49.22, -123.0299),
    ("18", 49.2174, -123.0611),
    ("19", 49.2479, -123.0454),
    ("20", 49.2174, -123.0611),
    ("21", 49.2791, -123.049),
    ("22", 49.2479, -123.0454),
    ("23", 49.2454, -123.0793),
    ("24", 49.22, -123.0299),
    ("25", 49.2408, -123.1175),
    ("26", 49.2827, -123.1207),
    ("27", 49.2888, -123.1394),
    ("28", 49.2888, -123.1394),
    ("29", 49.2827, -123.1207),
    ("30", 49.2827, -123.1207),
)
NEIGHBOURHOOD_NAMES = {
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
SERVE_CODE = "2"
SERVE_MIN_PROPERTIES = 500
SERVE_SORT = "avg_distance_to_station_km"


def _hav(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    s_lat = f"sin((radians({lat2}) - radians({lat1})) / CAST(2 AS DOUBLE))"
    s_lon = f"sin((radians({lon2}) - radians({lon1})) / CAST(2 AS DOUBLE))"
    a = f"{s_lat} * {s_lat} + cos(radians({lat1})) * cos(radians({lat2})) * ({s_lon} * {s_lon})"
    return (
        f"round(CAST(6371.0 AS DOUBLE) * (CAST(2.0 AS DOUBLE) * asin(least(CAST(1.0 AS DOUBLE), sqrt({a})))), 4)"
    )


def _bucket(d: str) -> str:
    whens = " ".join(f"WHEN {d} <= CAST({b!r} AS DOUBLE) THEN '{label}'" for b, label in PROXIMITY_BUCKETS)
    return f"CASE {whens} ELSE '{FAR_BUCKET}' END"


def _name(code: str) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in NEIGHBOURHOOD_NAMES.items())
    return f"CASE {code} {whens} END"


def _dbl(c: str) -> str:
    return f"CASE WHEN NOT isnan(TRY_CAST({c} AS DOUBLE)) THEN TRY_CAST({c} AS DOUBLE) END"


def _int(c: str) -> str:
    return f"TRY_CAST(trunc(TRY_CAST({c} AS DOUBLE)) AS INTEGER)"


PROPERTIES_RAW = """
properties_raw AS (
  SELECT
    CASE WHEN o_orderkey % 211 = 0 THEN NULL ELSE concat('P', CAST(o_orderkey AS VARCHAR)) END AS PID,
    o_orderpriority AS LEGAL_TYPE,
    c_mktsegment AS ZONING_DISTRICT,
    CAST(o_custkey AS VARCHAR) AS FROM_CIVIC_NUMBER,
    c_name AS STREET_NAME,
    CASE WHEN o_orderkey % 131 = 0 THEN '99'
         WHEN o_orderkey % 137 = 0 THEN NULL
         WHEN o_orderkey % 7 = 0 THEN concat('0', CAST(c_nationkey + 1 AS VARCHAR))
         ELSE CAST(c_nationkey + 1 AS VARCHAR) END AS NEIGHBOURHOOD_CODE,
    CAST(2019 + o_orderkey % 6 AS VARCHAR) AS REPORT_YEAR,
    CASE WHEN o_orderkey % 101 = 0 THEN 'n/a'
         WHEN o_orderkey % 103 = 0 THEN NULL
         WHEN o_orderkey % 107 = 0 THEN '0'
         WHEN o_orderkey % 109 = 0 THEN '500000000'
         WHEN o_orderkey % 113 = 0 THEN '499999999'
         ELSE CAST(o_totalprice AS VARCHAR) END AS CURRENT_LAND_VALUE,
    CASE WHEN o_orderkey % 23 = 0 THEN NULL ELSE CAST(c_acctbal AS VARCHAR) END AS CURRENT_IMPROVEMENT_VALUE,
    CAST(CAST(2019 + o_orderkey % 6 AS DOUBLE) AS VARCHAR) AS TAX_ASSESSMENT_YEAR,
    CASE WHEN o_orderkey % 17 = 0 THEN '0'
         WHEN o_orderkey % 19 = 0 THEN NULL
         ELSE CAST(o_totalprice * (CAST(80 + o_orderkey % 41 AS DOUBLE) / CAST(100 AS DOUBLE)) AS VARCHAR)
    END AS PREVIOUS_LAND_VALUE,
    CASE WHEN o_orderkey % 29 = 0 THEN 'NaN' ELSE CAST(c_acctbal AS VARCHAR) END AS PREVIOUS_IMPROVEMENT_VALUE,
    CAST(1780 + o_orderkey % 250 AS VARCHAR) AS YEAR_BUILT,
    CAST(1990 + o_orderkey % 30 AS VARCHAR) AS BIG_IMPROVEMENT_YEAR,
    CAST(CAST(o_totalprice AS DOUBLE) / CAST(250 AS DOUBLE) AS VARCHAR) AS TAX_LEVY
  FROM orders JOIN customer ON o_custkey = c_custkey
)"""

RENAMED = """
renamed AS (
  SELECT PID AS property_id, LEGAL_TYPE AS legal_type, ZONING_DISTRICT AS zoning_district,
    FROM_CIVIC_NUMBER AS street_number_from, STREET_NAME AS street_name,
    NEIGHBOURHOOD_CODE AS neighbourhood_code, REPORT_YEAR AS report_year,
    CURRENT_LAND_VALUE AS current_land_value, CURRENT_IMPROVEMENT_VALUE AS current_improvement_value,
    TAX_ASSESSMENT_YEAR AS tax_year, PREVIOUS_LAND_VALUE AS previous_land_value,
    PREVIOUS_IMPROVEMENT_VALUE AS previous_improvement_value, YEAR_BUILT AS year_built,
    BIG_IMPROVEMENT_YEAR AS big_improvement_year, TAX_LEVY AS tax_levy
  FROM properties_raw
)"""

TYPED = f"""
typed AS (
  SELECT property_id, legal_type, zoning_district, street_number_from, street_name,
    regexp_replace(neighbourhood_code, '^0+([0-9])', '\\1') AS neighbourhood_code,
    {_int('report_year')} AS report_year,
    {_dbl('current_land_value')} AS current_land_value,
    {_dbl('current_improvement_value')} AS current_improvement_value,
    {_int('tax_year')} AS tax_year,
    {_dbl('previous_land_value')} AS previous_land_value,
    {_dbl('previous_improvement_value')} AS previous_improvement_value,
    {_int('year_built')} AS year_built,
    big_improvement_year,
    {_dbl('tax_levy')} AS tax_levy
  FROM renamed
)"""

DERIVED = """
derived AS (
  SELECT *,
    current_land_value + current_improvement_value AS total_assessed_value,
    current_land_value - previous_land_value AS land_value_change,
    CASE WHEN previous_land_value IS NOT NULL AND previous_land_value > 0
         THEN (current_land_value - previous_land_value) / previous_land_value * 100 END AS land_value_change_pct,
    CASE WHEN year_built IS NOT NULL AND year_built > 1800 THEN 2024 - year_built END AS property_age_years
  FROM typed
)"""

VALID = f"current_land_value IS NOT NULL AND current_land_value > 0 AND current_land_value < {MAX_LAND_VALUE}"

CLEAN = f"""
clean AS (SELECT * FROM derived WHERE {VALID})"""

STOPS_RAW = """
stops_raw AS (
  SELECT s_suppkey AS stop_id,
    CASE WHEN s_suppkey % 5 = 0 THEN concat('Station ', CAST(s_suppkey % 40 AS VARCHAR))
         ELSE concat('Stop ', CAST(s_suppkey AS VARCHAR)) END AS stop_name,
    CAST(49200 + (s_suppkey * 29) % 103 AS DOUBLE) / CAST(1000 AS DOUBLE) AS stop_lat,
    CAST(-123220 + ((s_suppkey * 61) % 107) * 2 AS DOUBLE) / CAST(1000 AS DOUBLE) AS stop_lon
  FROM supplier
)"""

STOPS_TIED = """
stops_tied AS (
  SELECT * FROM stops_raw
  UNION ALL
  SELECT stop_id + 1000000 AS stop_id, concat('Twin ', stop_name) AS stop_name, stop_lat, stop_lon
  FROM stops_raw WHERE stop_name LIKE '%Station%'
)"""


def _stations_cte(source: str) -> str:
    return f"""
stations AS (
  SELECT station_id, station_name, station_lat, station_long FROM (
    SELECT stop_id AS station_id, stop_name AS station_name,
      TRY_CAST(stop_lat AS DOUBLE) AS station_lat, TRY_CAST(stop_lon AS DOUBLE) AS station_long,
      row_number() OVER (PARTITION BY stop_name
                         ORDER BY stop_id NULLS FIRST, stop_lat NULLS FIRST, stop_lon NULLS FIRST) AS rn
    FROM {source} WHERE stop_name LIKE '%Station%'
  ) WHERE rn = 1
)"""


CENTROIDS = """
centroids AS (
  SELECT CAST(n_nationkey + 1 AS VARCHAR) AS neighbourhood_code,
    CAST(49200 + (n_nationkey * 37) % 100 AS DOUBLE) / CAST(1000 AS DOUBLE) AS neighbourhood_lat,
    CAST(-123220 + ((n_nationkey * 53) % 100) * 2 AS DOUBLE) / CAST(1000 AS DOUBLE) AS neighbourhood_lon
  FROM nation
)"""

CENTROIDS_LITERAL = """
centroids AS (
  SELECT * FROM (VALUES {rows}) AS t(neighbourhood_code, neighbourhood_lat, neighbourhood_lon)
)""".format(
    rows=", ".join(f"('{c}', CAST({la!r} AS DOUBLE), CAST({lo!r} AS DOUBLE))" for c, la, lo in NEIGHBOURHOOD_CENTROIDS)
)

NEAREST = f"""
pairs AS (
  SELECT c.neighbourhood_code, s.station_id, s.station_name, s.station_lat, s.station_long,
    {_hav('c.neighbourhood_lat', 'c.neighbourhood_lon', 's.station_lat', 's.station_long')} AS distance_km
  FROM centroids c CROSS JOIN stations s
),
nearest AS (
  SELECT neighbourhood_code, station_id, station_name, station_lat, station_long, distance_km FROM (
    SELECT *, rank() OVER (PARTITION BY neighbourhood_code ORDER BY distance_km ASC NULLS FIRST) AS r FROM pairs
  ) WHERE r = 1
)"""

ENRICHED = f"""
enriched AS (
  SELECT p.*, n.station_id, n.station_name, n.station_lat, n.station_long, n.distance_km,
    {_bucket('n.distance_km')} AS transit_proximity_category
  FROM clean p LEFT JOIN nearest n ON p.neighbourhood_code = n.neighbourhood_code
)"""

DETAIL = f"""
station_counts AS (
  SELECT neighbourhood_code, transit_proximity_category, station_name, count(*) AS c
  FROM enriched WHERE station_name IS NOT NULL GROUP BY ALL
),
primary_station AS (
  SELECT neighbourhood_code AS ps_code, transit_proximity_category AS ps_bucket, station_name AS primary_station FROM (
    SELECT *, row_number() OVER (PARTITION BY neighbourhood_code, transit_proximity_category
                                 ORDER BY c DESC, station_name ASC) AS rn FROM station_counts
  ) WHERE rn = 1
),
detail_agg AS (
  SELECT neighbourhood_code, transit_proximity_category,
    count(property_id) AS property_count,
    round(avg(current_land_value), 0) AS avg_land_value,
    round(avg(total_assessed_value), 0) AS avg_total_assessed_value,
    round(quantile_disc(current_land_value, 0.5), 0) AS median_land_value,
    round(min(current_land_value), 0) AS min_land_value,
    round(max(current_land_value), 0) AS max_land_value,
    round(avg(distance_km), 3) AS avg_distance_to_station_km,
    round(avg(land_value_change_pct), 2) AS avg_yoy_change_pct
  FROM enriched GROUP BY neighbourhood_code, transit_proximity_category
),
detail AS (
  SELECT d.neighbourhood_code, d.transit_proximity_category, d.property_count, d.avg_land_value,
    d.avg_total_assessed_value, d.median_land_value, d.min_land_value, d.max_land_value,
    d.avg_distance_to_station_km, p.primary_station, d.avg_yoy_change_pct,
    {_name('d.neighbourhood_code')} AS neighbourhood_name
  FROM detail_agg d LEFT JOIN primary_station p
    ON d.neighbourhood_code IS NOT DISTINCT FROM p.ps_code AND d.transit_proximity_category = p.ps_bucket
)"""

OVERVIEW = f"""
overview AS (
  SELECT neighbourhood_code,
    count(property_id) AS total_properties,
    round(avg(current_land_value), 0) AS avg_land_value,
    round(avg(distance_km), 3) AS avg_distance_to_station_km,
    round(CAST(sum(CASE WHEN transit_proximity_category = '< 500m' THEN 1 ELSE 0 END) AS DOUBLE)
          / CAST(NULLIF(count(property_id), 0) AS DOUBLE) * 100, 1) AS pct_within_500m_station,
    round(avg(land_value_change_pct), 2) AS avg_yoy_change_pct,
    {_name('neighbourhood_code')} AS neighbourhood_name
  FROM enriched GROUP BY neighbourhood_code
)"""

BUCKET_SUMMARY = """
ranked AS (
  SELECT transit_proximity_category AS b, current_land_value AS v,
    row_number() OVER (PARTITION BY transit_proximity_category ORDER BY current_land_value) AS rn,
    CAST(count(*) OVER (PARTITION BY transit_proximity_category) - 1 AS DOUBLE) * 0.5 AS pos
  FROM enriched WHERE current_land_value IS NOT NULL
),
med AS (
  SELECT b, CASE WHEN min(pos) = floor(min(pos)) THEN max(CASE WHEN rn = floor(pos) + 1 THEN v END)
                 ELSE (ceil(min(pos)) - min(pos)) * max(CASE WHEN rn = floor(pos) + 1 THEN v END)
                    + (min(pos) - floor(min(pos))) * max(CASE WHEN rn = ceil(pos) + 1 THEN v END) END AS median_land_value
  FROM ranked GROUP BY b
),
bsum AS (
  SELECT transit_proximity_category, count(property_id) AS property_count, avg(current_land_value) AS avg_land_value
  FROM enriched GROUP BY transit_proximity_category
)"""

_OV_FIELDS = (
    "neighbourhood_code, neighbourhood_name, total_properties, avg_land_value, "
    "avg_distance_to_station_km, pct_within_500m_station, avg_yoy_change_pct"
)
_DT_FIELDS = (
    "neighbourhood_code, neighbourhood_name, transit_proximity_category, property_count, avg_land_value, "
    "median_land_value, avg_distance_to_station_km, primary_station, avg_yoy_change_pct"
)


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


_BASE = (PROPERTIES_RAW, RENAMED, TYPED, DERIVED, CLEAN)
_GOLD_BASE = (*_BASE, STOPS_RAW, _stations_cte("stops_raw"), CENTROIDS, NEAREST, ENRICHED)
_GOLD_BASE_TIED = (*_BASE, STOPS_RAW, STOPS_TIED, _stations_cte("stops_tied"), CENTROIDS, NEAREST, ENRICHED)

_STOP_PAIRS = f"""
stop_pairs AS (
  SELECT s.s_suppkey AS stop_id, c.neighbourhood_code,
    {_hav('c.neighbourhood_lat', 'c.neighbourhood_lon',
          'CAST(49200 + (s.s_suppkey * 29) % 103 AS DOUBLE) / CAST(1000 AS DOUBLE)',
          'CAST(-123220 + ((s.s_suppkey * 61) % 107) * 2 AS DOUBLE) / CAST(1000 AS DOUBLE)')} AS distance_km
  FROM supplier s JOIN centroids c ON CAST(s.s_nationkey + 1 AS VARCHAR) = c.neighbourhood_code
)"""


NEAREST_SUPPLIER = f"""
WITH points AS (
  SELECT CAST(c_custkey AS VARCHAR) AS code,
    CAST(49100 + (c_custkey * 7919) % 997 AS DOUBLE) / CAST(1000 AS DOUBLE) AS lat,
    CAST(-123300 + (c_custkey * 6271) % 1499 AS DOUBLE) / CAST(1000 AS DOUBLE) AS lon
  FROM customer
), places AS (
  SELECT s_suppkey AS station_id, s_name AS station_name,
    CASE WHEN s_suppkey % 10 = 0 THEN CAST(49100 + (s_suppkey * 577) % 991 AS DOUBLE) / CAST(1000 AS DOUBLE)
         ELSE CAST(49280000 + (s_suppkey * 389) % 4999 AS DOUBLE) / CAST(1000000 AS DOUBLE) END AS station_lat,
    CASE WHEN s_suppkey % 10 = 0 THEN CAST(-123300 + (s_suppkey * 613) % 1493 AS DOUBLE) / CAST(1000 AS DOUBLE)
         ELSE CAST(-123120000 + (s_suppkey * 677) % 4993 AS DOUBLE) / CAST(1000000 AS DOUBLE) END AS station_long
  FROM supplier
), ranked AS (
  SELECT code, station_id, station_name, station_lat, station_long,
    {_hav("lat", "lon", "station_lat", "station_long")} AS distance_km,
    row_number() OVER (PARTITION BY code ORDER BY {_hav("lat", "lon", "station_lat", "station_long")}, station_name, station_id) AS r
  FROM points, places
)
SELECT code AS neighbourhood_code, station_id, station_name, station_lat, station_long, distance_km FROM ranked WHERE r = 1
"""

ORACLE_SQL: dict[str, str] = {
    "nearest_supplier": NEAREST_SUPPLIER,
    "rename_columns": _with(PROPERTIES_RAW, RENAMED) + "SELECT * FROM renamed",
    "cast_types": _with(PROPERTIES_RAW, RENAMED, TYPED) + "SELECT * FROM typed",
    "derive_values": _with(PROPERTIES_RAW, RENAMED, TYPED, DERIVED) + "SELECT * FROM derived",
    "filter_valid": _with(PROPERTIES_RAW, RENAMED, TYPED) + f"SELECT * FROM typed WHERE {VALID}",
    "clean_properties": _with(*_BASE) + "SELECT * FROM clean",
    "normalize_code": _with(PROPERTIES_RAW)
    + "SELECT PID AS property_id, NEIGHBOURHOOD_CODE AS raw_code, "
    "regexp_replace(NEIGHBOURHOOD_CODE, '^0+([0-9])', '\\1') AS neighbourhood_code FROM properties_raw",
    "station_filter": _with(STOPS_RAW) + "SELECT * FROM stops_raw WHERE stop_name LIKE '%Station%'",
    "stations": _with(STOPS_RAW, _stations_cte("stops_raw")) + "SELECT * FROM stations",
    "union_parts": _with(STOPS_RAW, STOPS_TIED) + "SELECT * FROM stops_tied",
    "haversine": _with(CENTROIDS, _STOP_PAIRS) + "SELECT * FROM stop_pairs",
    "proximity_bucket": _with(CENTROIDS, _STOP_PAIRS)
    + f"SELECT *, {_bucket('distance_km')} AS transit_proximity_category FROM stop_pairs",
    "neighbourhood_names": _with(*_BASE)
    + f"SELECT property_id, neighbourhood_code, {_name('neighbourhood_code')} AS neighbourhood_name FROM clean",
    "centroid_literal": _with(STOPS_RAW, _stations_cte("stops_raw"), CENTROIDS_LITERAL, NEAREST)
    + "SELECT * FROM nearest",
    "nearest_station": _with(STOPS_RAW, _stations_cte("stops_raw"), CENTROIDS, NEAREST) + "SELECT * FROM nearest",
    "nearest_station_tied": _with(STOPS_RAW, STOPS_TIED, _stations_cte("stops_tied"), CENTROIDS, NEAREST)
    + "SELECT * FROM nearest",
    "enrich_properties": _with(*_GOLD_BASE) + "SELECT * FROM enriched",
    "enrich_properties_tied": _with(*_GOLD_BASE_TIED) + "SELECT * FROM enriched",
    "unmatched_count": _with(*_GOLD_BASE)
    + "SELECT count(*) AS enriched_rows, count(*) FILTER (WHERE distance_km IS NULL) AS unmatched_rows FROM enriched",
    "filter_counts": _with(PROPERTIES_RAW, RENAMED, TYPED)
    + f"SELECT count(*) AS raw_rows, count(*) FILTER (WHERE {VALID}) AS clean_rows, "
    f"count(*) - count(*) FILTER (WHERE {VALID}) AS dropped_rows FROM typed",
    "dq_report": _with(*_GOLD_BASE)
    + "SELECT 'no_negative_land_value' AS check_name, count(*) FILTER (WHERE current_land_value < 0) AS failures, "
    "min(current_land_value) AS min_value, max(current_land_value) AS max_value, "
    "count(*) FILTER (WHERE current_land_value < 0) = 0 AS passed FROM clean "
    "UNION ALL "
    "SELECT 'distance_within_range', count(*) FILTER (WHERE distance_km < 0 OR distance_km >= 100), "
    "min(distance_km), max(distance_km), "
    "count(*) FILTER (WHERE distance_km < 0 OR distance_km >= 100) = 0 FROM enriched",
    "gold_detail": _with(*_GOLD_BASE, DETAIL) + "SELECT * FROM detail",
    "gold_overview": _with(*_GOLD_BASE, OVERVIEW) + "SELECT * FROM overview",
    "bucket_summary": _with(*_GOLD_BASE, BUCKET_SUMMARY)
    + "SELECT s.transit_proximity_category, s.property_count, s.avg_land_value, m.median_land_value "
    "FROM bsum s LEFT JOIN med m ON s.transit_proximity_category = m.b",
    "top_neighbourhoods": _with(*_GOLD_BASE, OVERVIEW)
    + "SELECT * FROM overview ORDER BY avg_land_value DESC NULLS LAST, neighbourhood_code ASC NULLS LAST LIMIT 10",
    "detail_by_name": _with(*_GOLD_BASE, DETAIL) + "SELECT * FROM detail WHERE neighbourhood_name = 'Kitsilano'",
    "preview_properties": _with(*_BASE)
    + "SELECT property_id, street_name, neighbourhood_code, current_land_value, total_assessed_value, year_built "
    "FROM clean ORDER BY property_id ASC NULLS LAST LIMIT 10",
    "gold_health": _with(*_GOLD_BASE, OVERVIEW)
    + "SELECT CASE WHEN count(*) > 0 THEN 'healthy' ELSE 'degraded' END AS status, "
    "count(*) > 0 AS gold_data_available, CASE WHEN count(*) > 0 THEN count(*) END AS neighbourhood_count, "
    "CASE WHEN count(*) > 0 THEN 'gold data is available' "
    "ELSE 'gold data is missing: run the batch job first' END AS message FROM overview",
    "serve_overview": _with(*_GOLD_BASE, OVERVIEW) + f"SELECT {_OV_FIELDS} FROM overview",
    "serve_overview_min": _with(*_GOLD_BASE, OVERVIEW)
    + f"SELECT {_OV_FIELDS} FROM overview WHERE total_properties >= {SERVE_MIN_PROPERTIES} "
    f"ORDER BY {SERVE_SORT} DESC NULLS LAST, neighbourhood_code ASC NULLS LAST",
    "serve_one": _with(*_GOLD_BASE, OVERVIEW)
    + f"SELECT {_OV_FIELDS} FROM overview WHERE neighbourhood_code = '{SERVE_CODE}' LIMIT 1",
    "serve_transit_analysis": _with(*_GOLD_BASE, DETAIL)
    + f"SELECT {_DT_FIELDS} FROM detail WHERE neighbourhood_code = '{SERVE_CODE}'",
}
