"""Exact nearest-station search, as equi-joins on grid cells (no cross join).

Semantics (same as ranking every centroid x station pair):

* distance is the haversine distance rounded to 4 places, null when any
  coordinate is null;
* per neighbourhood code, pairs are ranked by distance ascending with
  nulls first, and every pair of rank 1 is kept (ties fan out), or one
  pair with ``ties="one"``.

Plan, for centroid points with valid coordinates: stations lie in a pyramid of
lat/lon cells, six levels from 8 degrees down to about 25 metres, each
8 times finer per axis. A level's table has one row for each cell that
holds stations: their real extent and one representative. Points lie in groups, cells of
about 870 metres: a group has a centre and a reach that no point of it exceeds. All groups start at
the two half-globes and descend together to cells of 1.7 km; from there their points descend alone. At each level

1. the cells kept so far meet their children (an equi-join on the cell);
2. children whose extent is farther than the bound of the level above are dropped before any shuffle;
3. the new bound is the least distance to a representative of a child, a group's reach added;
4. children whose extent is farther than the bound, a group's reach taken off, are dropped.

Stations themselves are joined only for the cells that are left at the finest level, pairs
beyond the bound are dropped, and the rest are ranked per code. A kept cell has 64 children at most and a bound
reaches over a few cells, so what a point evaluates does not grow with the number of stations, also where it looks at a dense
cluster from afar; the descent from afar is paid once a group. The coarsest table has a proven size (1,035 rows at most)
and is broadcast; the finer ones are left to the planner, which splits hot cells.

Points or stations with null or invalid coordinates cannot be placed on the
grid. A null-coordinate station ranks first for every point; a null-coordinate point ties with every
station: pairs that the semantics define, in a branch for either case. The many side
is dealt over ``SPREAD`` keys and the few rows are repeated for each, so no key holds a side
whole; adaptive execution drops a branch that has no such rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stationwise.constants import DISTANCE_DECIMALS, EARTH_RADIUS_KM
from stationwise.functions.geo import great_circle_sql, haversine_sql
from stationwise.operators.stations import STATION_COLUMNS

#: Cells per degree at the finest level; each level above is 2**SHIFT times coarser per axis.
FINEST = 4_096
SHIFT = 3
TOP = 5
#: The coarsest cells lie in two half-globes, 2**HALVES times coarser.
HALVES = 5
#: Groups of points are cells 2**GROUP times coarser than the finest; they descend to level ``GROUPED``, points from there.
GROUP = 5
GROUPED = 2
#: Levels whose cells on the whole globe are few enough to broadcast: 1,035 of 8 degrees.
BROADCAST_FROM = 5
#: Keys over which the rows that meet an unplaceable row are dealt.
SPREAD = 64


def placeable_sql(lat: str, lon: str) -> str:
    """Coordinates the grid can hold: non-null, |lat| <= 90, finite lon."""
    return (
        f"({lat} IS NOT NULL AND {lon} IS NOT NULL AND {lat} >= -90.0D AND {lat} <= 90.0D "
        f"AND abs({lon}) < double('Infinity'))"
    )


def _east(lon: str) -> str:
    """Degrees east of the antimeridian, 0 to below 360."""
    return f"(pmod({lon} + 180.0D, 360.0D))"


def _cell_sql(lat: str, lon: str) -> tuple[str, str]:
    """Finest cell of a placeable coordinate pair."""
    return (
        f"least(CAST(floor(({lat} + 90.0D) * {FINEST}) AS BIGINT), {180 * FINEST - 1}L)",
        f"least(CAST(floor({_east(lon)} * {FINEST}) AS BIGINT), {360 * FINEST - 1}L)",
    )


def _on_grid(stations: DataFrame) -> DataFrame:
    """Every placeable station with its finest cell (cy, cx) and ``east``."""
    cy, cx = _cell_sql("station_lat", "station_long")
    return stations.where(placeable_sql("station_lat", "station_long")).selectExpr(
        *STATION_COLUMNS, f"{cy} AS cy", f"{cx} AS cx", f"{_east('station_long')} AS east"
    )


def _levels(on_grid: DataFrame) -> list[DataFrame]:
    """Cell tables, finest first: (cy, cx), extent, representative."""
    out = []
    for level in range(TOP + 1):
        cell = [F.shiftright(c, SHIFT * level).alias(c) for c in ("cy", "cx")]
        out.append(
            on_grid.groupBy(*cell).agg(
                F.min("station_lat").alias("lat1"),
                F.max("station_lat").alias("lat2"),
                F.min("east").alias("lon1"),
                F.max("east").alias("lon2"),
                F.min_by("east", "station_lat").alias("rlon"),  # the representative is a real station: least latitude, with its longitude
            )
        )
    return out


def _groups(points: DataFrame, radius_km: float) -> DataFrame:
    """(gy, gx, plat, pe, reach): cells of placeable points, their centre and how far from it a point can lie.

    ``reach`` is the way along the centre's parallel and on along a meridian.
    """
    box = points.groupBy("gy", "gx").agg(F.min("plat").alias("lat1"), F.max("plat").alias("lat2"), F.min("pe").alias("lon1"), F.max("pe").alias("lon2"))
    return box.selectExpr("gy", "gx", "(lat1 + lat2) / 2 AS plat", "(lon1 + lon2) / 2 AS pe", "lat2 - lat1 AS high", "lon2 - lon1 AS wide").selectExpr(
        "gy", "gx", "plat", "pe", f"{radius_km!r}D * (radians(high / 2) + cos(radians(plat)) * radians(wide / 2)) AS reach"
    )


def _nearest_latitude_sql() -> str:
    """Latitude of the point of a cell's extent that is nearest to a point ``dl`` degrees of longitude away.

    On the extent's nearest meridian that is ``atan2(sin, cos * cos dl)``, or an end if that lies outside.
    """

    def cosine(lat: str) -> str:
        return f"(sin(radians(plat)) * sin(radians({lat})) + cos(radians(plat)) * cos(radians({lat})) * cos(radians(dl)))"

    return f"CASE WHEN abs(star) <= 90.0D THEN least(greatest(star, lat1), lat2) WHEN {cosine('lat1')} >= {cosine('lat2')} THEN lat1 ELSE lat2 END"


EXTENT = ("lat1", "lat2", "lon1", "lon2", "rlon")


def _kept(met: DataFrame, key: tuple[str, ...], radius_km: float, slack: float) -> DataFrame:
    """The rows of ``met`` (key, plat, pe, reach, bound, cell, extent) whose cell can hold a rank-1 station, their bound drawn in."""
    within = f"near - reach <= bound * (1.0D + 1e-9D) + {slack!r}D"
    found = met.selectExpr(
        "*",
        "CASE WHEN pe BETWEEN lon1 AND lon2 THEN 0.0D ELSE least(abs(pe - lon1), 360.0D - abs(pe - lon1), abs(pe - lon2), 360.0D - abs(pe - lon2)) END AS dl",
        "degrees(atan2(sin(radians(plat)), cos(radians(plat)) * cos(radians(dl)))) AS star",
        f"{_nearest_latitude_sql()} AS near_lat",
        f"{great_circle_sql('plat', '(0.0D)', 'near_lat', 'dl', radius_km)} AS near_km",
        f"{great_circle_sql('plat', 'pe', 'lat1', 'rlon', radius_km)} + reach AS far",
    )
    # a generated column is computed once; a filter on a plain one would repeat the nested formulas in its condition
    found = found.selectExpr(*met.columns, "far", "explode(array(near_km)) AS near").where(within)
    return found.withColumn("bound", F.least("bound", F.min("far").over(Window.partitionBy(*key)))).where(within).select(*met.columns)


def _descend(points: DataFrame, on_grid: DataFrame, radius_km: float, decimals: int) -> DataFrame:
    """(plat, plon, bound, up_y, up_x): the finest cells that can hold a rank-1 station of a point."""
    slack = 10.0 ** (-decimals) + 1e-6  # pairs tied after rounding
    levels = _levels(on_grid)

    def down(front: DataFrame, key: tuple[str, ...], level: int) -> DataFrame:
        up = HALVES if level == TOP else SHIFT
        cells = levels[level].selectExpr("*", f"shiftright(cy, {up}) AS up_y", f"shiftright(cx, {up}) AS up_x")
        met = front.join(F.broadcast(cells) if level >= BROADCAST_FROM else cells, ["up_y", "up_x"]).drop("up_y", "up_x")
        return _kept(met, key, radius_km, slack).withColumnsRenamed({"cy": "up_y", "cx": "up_x"})

    gy, gx = _cell_sql("plat", "plon")
    own = points.selectExpr("plat", "plon", f"{_east('plon')} AS pe", f"shiftright({gy}, {GROUP}) AS gy", f"shiftright({gx}, {GROUP}) AS gx")
    front = _groups(own, radius_km).selectExpr("*", "double('Infinity') AS bound", "0L AS up_y", "explode(array(0L, 1L)) AS up_x")
    for level in range(TOP, GROUPED - 1, -1):
        front = down(front.drop(*EXTENT), ("gy", "gx"), level)
    met = own.join(front.drop("plat", "pe", "reach"), ["gy", "gx"]).drop("gy", "gx").withColumn("reach", F.lit(0.0))
    front = _kept(met, ("plat", "plon"), radius_km, slack)
    for level in range(GROUPED - 1, -1, -1):
        front = down(front.drop(*EXTENT), ("plat", "plon"), level)
    return front.select("plat", "plon", "bound", "up_y", "up_x")


def candidate_pairs(
    points: DataFrame,
    stations: DataFrame,
    radius_km: float = EARTH_RADIUS_KM,
    decimals: int = DISTANCE_DECIMALS,
) -> DataFrame:
    """(plat, plon, station columns, distance_km) holding every rank-1 pair.

    ``points`` holds distinct (plat, plon) rows, nulls allowed. Besides the
    rank-1 stations of each point the result holds a few others that are
    about as near; rank them per point (or per code) to finish.
    """
    stations = stations.select(*STATION_COLUMNS)
    pt_ok = placeable_sql("plat", "plon")
    st_ok = placeable_sql("station_lat", "station_long")
    on_grid = _on_grid(stations)
    cells = _descend(points.where(pt_ok), on_grid, radius_km, decimals)
    dist = haversine_sql("plat", "plon", "station_lat", "station_long", radius_km, decimals)
    near = cells.join(on_grid, (F.col("up_y") == F.col("cy")) & (F.col("up_x") == F.col("cx"))).where(f"{dist} <= bound + {2 * 10.0 ** (-decimals) + 1e-6!r}D").select("plat", "plon", *STATION_COLUMNS)
    lost = stations.where(f"NOT {st_ok}").selectExpr(*STATION_COLUMNS, f"explode(sequence(0, {SPREAD - 1})) AS deal")
    every = points.selectExpr("plat", "plon", f"CAST(pmod(xxhash64(plat, plon), {SPREAD}) AS INT) AS deal")
    nowhere = points.where(f"NOT {pt_ok}").selectExpr("plat", "plon", f"explode(sequence(0, {SPREAD - 1})) AS deal")
    placed = stations.where(st_ok).selectExpr(*STATION_COLUMNS, f"CAST(pmod(xxhash64(station_id, station_name, station_lat, station_long), {SPREAD}) AS INT) AS deal")
    special = [x.join(y, "deal").select("plat", "plon", *STATION_COLUMNS) for x, y in ((every, lost), (nowhere, placed))]
    return near.unionByName(special[0]).unionByName(special[1]).selectExpr("*", f"{dist} AS distance_km")


def nearest_station(
    centroids: DataFrame,
    stations: DataFrame,
    ties: str = "all",
    code: str = "neighbourhood_code",
    lat: str = "neighbourhood_lat",
    lon: str = "neighbourhood_lon",
    radius_km: float = EARTH_RADIUS_KM,
    decimals: int = DISTANCE_DECIMALS,
) -> DataFrame:
    """Nearest station(s) for every neighbourhood code.

    Returns (code, station_id, station_name, station_lat, station_long,
    distance_km). ``ties="all"`` keeps every rank-1 pair (a centroid row
    given twice repeats its pairs, as a pairwise ranking would);
    ``ties="one"`` keeps one pair per code, by distance then station name
    then id, so of stations at the same place only the first by name and id is
    searched. Search runs once per distinct coordinate pair, then the
    candidates are joined back to the centroid rows and ranked per code.
    """
    if ties not in ("all", "one"):
        raise ValueError("ties must be 'all' or 'one'")
    if ties == "one":
        first = "row_number() OVER (PARTITION BY station_lat, station_long ORDER BY station_name ASC NULLS FIRST, station_id ASC NULLS FIRST)"
        stations = stations.selectExpr(*STATION_COLUMNS, f"{first} AS r").where("r = 1")
    points = centroids.selectExpr(f"`{lat}` AS plat", f"`{lon}` AS plon").distinct()
    cand = candidate_pairs(points, stations, radius_km, decimals)
    joined = centroids.select(code, lat, lon).join(
        cand, F.col(lat).eqNullSafe(F.col("plat")) & F.col(lon).eqNullSafe(F.col("plon"))
    )
    order = "distance_km ASC NULLS FIRST"
    if ties == "one":
        fn = f"row_number() OVER (PARTITION BY `{code}` ORDER BY {order}, station_name ASC NULLS FIRST, station_id ASC NULLS FIRST)"
    else:
        fn = f"rank() OVER (PARTITION BY `{code}` ORDER BY {order})"
    return joined.selectExpr(f"`{code}`", *STATION_COLUMNS, "distance_km", f"{fn} AS r").where("r = 1").drop("r")
