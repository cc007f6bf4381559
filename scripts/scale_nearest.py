"""Nearest-station search at scale on the driver's tables.

Points: every order (code = order key) spread over a 10 x 20 degree box.
Stations: every lineitem row; a third of them packed into one ~1 km2
spot (the hot cell), the rest spread like the points. A cross join
would rank points x stations pairs; the grid search evaluates only the
candidates of each point's search box.

Usage: python scripts/scale_nearest.py [sf_dir]   (prints one JSON line)
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stationwise.operators import candidate_pairs, nearest_station  # noqa: E402
from stationwise.session import local_session  # noqa: E402


def points(spark, sf):
    return spark.read.parquet(f"{sf}/orders.parquet").selectExpr(
        "CAST(o_orderkey AS STRING) AS neighbourhood_code",
        "40.0D + CAST((o_orderkey * 7919) % 100000 AS DOUBLE) / 10000.0D AS neighbourhood_lat",
        "-125.0D + CAST((o_orderkey * 104729) % 200000 AS DOUBLE) / 10000.0D AS neighbourhood_lon",
    )


def stations(spark, sf):
    ids = spark.read.parquet(f"{sf}/lineitem.parquet").selectExpr("l_orderkey * 8 + l_linenumber AS id")
    return ids.selectExpr(
        "id AS station_id",
        "concat('S', CAST(id AS STRING)) AS station_name",
        "CASE WHEN id % 3 = 0 THEN 45.0D + CAST(id % 1000 AS DOUBLE) / 100000.0D "
        "ELSE 40.0D + CAST((id * 31) % 100000 AS DOUBLE) / 10000.0D END AS station_lat",
        "CASE WHEN id % 3 = 0 THEN -115.0D + CAST((id * 7) % 1000 AS DOUBLE) / 100000.0D "
        "ELSE -125.0D + CAST((id * 613) % 200000 AS DOUBLE) / 10000.0D END AS station_long",
    )


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session()
    c, s = points(spark, sf), stations(spark, sf)
    n_c, n_s = c.count(), s.count()
    t0 = time.perf_counter()
    rows = nearest_station(c, s).count()
    dt = time.perf_counter() - t0
    pts = c.selectExpr("neighbourhood_lat AS plat", "neighbourhood_lon AS plon").distinct()
    cand = candidate_pairs(pts, s).count()
    print(json.dumps({"sf": sf, "points": n_c, "stations": n_s, "all_pairs": n_c * n_s,
                      "candidate_pairs": cand, "result_rows": rows, "seconds": round(dt, 2)}))


if __name__ == "__main__":
    main()
