"""Batch jobs: landed files -> bronze -> silver -> gold, one Spark session.

Stages hand over through Parquet tables (the written layers cut the
lineage, so a lost executor only recomputes from the last layer). Row
counts are collected with ``observe`` during the writes, never by an
extra counting pass.
"""

from __future__ import annotations

import logging
import time
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stationwise.constants import NEIGHBOURHOOD_NAMES, STATION_TOKEN
from stationwise.operators.aggregate import gold_detail, gold_overview
from stationwise.operators.clean import cast_types, derive_values, filter_valid, rename_columns
from stationwise.operators.enrich import enrich_properties
from stationwise.operators.quality import observe_counts
from stationwise.operators.stations import load_stations, station_filter
from stationwise.sources.files import (
    read_delimited,
    read_parquet_checked,
    read_partitioned,
    write_parquet,
    write_partitioned,
    write_single_file,
)
from stationwise.sources.literal import centroid_table

log = logging.getLogger(__name__)

STAGES = ("ingest", "ingest_properties", "ingest_stops", "ingest_translink", "transform", "gold")
DEFAULT_STAGES = ("ingest", "transform", "gold")


@dataclass(frozen=True)
class Layout:
    """Table locations under one base path (any Hadoop-compatible URI)."""

    base: str

    def _p(self, *parts: str) -> str:
        return "/".join([self.base.rstrip("/"), *parts])

    @property
    def landing_properties(self) -> str:
        return self._p("landing", "property_tax.csv")

    @property
    def landing_stops(self) -> str:
        return self._p("landing", "stops.txt")

    @property
    def bronze_properties(self) -> str:
        return self._p("bronze", "property_tax", "property_tax_raw.parquet")

    @property
    def bronze_stops(self) -> str:
        return self._p("bronze", "stops", "stops_raw.parquet")

    @property
    def bronze_stations(self) -> str:
        return self._p("bronze", "stops", "stations_raw.parquet")

    @property
    def silver_properties(self) -> str:
        return self._p("silver", "properties_cleaned")

    @property
    def silver_transit(self) -> str:
        return self._p("silver", "properties_with_transit")

    @property
    def gold_detail(self) -> str:
        return self._p("gold", "neighbourhood_summary", "neighbourhood_transit_detail")

    @property
    def gold_overview(self) -> str:
        return self._p("gold", "neighbourhood_summary", "neighbourhood_overview")


# ------------------------------------------------------------------ bronze


def ingest_properties(spark: SparkSession, layout: Layout) -> dict[str, int]:
    """Landed property roll (delimited text) -> bronze Parquet."""
    df, obs = observe_counts(read_delimited(spark, layout.landing_properties), "bronze_properties")
    write_parquet(df, layout.bronze_properties)
    return {"bronze_properties": obs.get["rows"]}


def ingest_stops(spark: SparkSession, layout: Layout, token: str = STATION_TOKEN) -> dict[str, int]:
    """Landed stops table -> bronze stops, and the stations among them."""
    stops, s_obs = observe_counts(read_delimited(spark, layout.landing_stops), "bronze_stops")
    write_parquet(stops, layout.bronze_stops)
    stations, st_obs = observe_counts(station_filter(read_parquet_checked(spark, layout.bronze_stops), token), "stations")
    write_parquet(stations, layout.bronze_stations)
    return {"bronze_stops": s_obs.get["rows"], "bronze_stations": st_obs.get["rows"]}


# ------------------------------------------------------------------ silver


def clean_job(spark: SparkSession, layout: Layout, as_of_year: int | None = None) -> dict[str, int]:
    """Bronze properties -> cleaned silver, partitioned by neighbourhood code."""
    raw = read_parquet_checked(spark, layout.bronze_properties)
    typed = raw.transform(rename_columns).transform(cast_types)
    typed = typed.transform(derive_values) if as_of_year is None else typed.transform(derive_values, as_of_year)
    typed, before = observe_counts(typed, "before_filter")
    cleaned, after = observe_counts(filter_valid(typed), "after_filter")
    write_partitioned(cleaned, layout.silver_properties, "neighbourhood_code")
    n_in, n_out = before.get["rows"], after.get["rows"]
    log.info("cleaning kept %d of %d rows", n_out, n_in)
    return {"raw_rows": n_in, "clean_rows": n_out, "dropped_rows": n_in - n_out}


def enrich_job(
    spark: SparkSession,
    layout: Layout,
    centroids: DataFrame | None = None,
    ties: str = "all",
) -> dict[str, int]:
    """Cleaned silver + stations -> silver with nearest station, partitioned by bucket."""
    properties = read_partitioned(spark, layout.silver_properties, "neighbourhood_code")
    stations = load_stations(read_parquet_checked(spark, layout.bronze_stations))
    centroids = centroids if centroids is not None else centroid_table(spark)
    enriched = enrich_properties(properties, centroids, stations, ties=ties)
    obs = Observation("enriched")
    enriched = enriched.observe(
        obs,
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("distance_km").isNull()).alias("unmatched"),
    )
    write_partitioned(enriched, layout.silver_transit, "transit_proximity_category")
    got = obs.get
    if got["unmatched"]:
        log.warning("%d properties found no station (null distance)", got["unmatched"])
    return {"enriched_rows": got["rows"], "unmatched_rows": got["unmatched"]}


# -------------------------------------------------------------------- gold


def gold_job(
    spark: SparkSession,
    layout: Layout,
    names: Mapping[str, str] | DataFrame = NEIGHBOURHOOD_NAMES,
    median: str = "exact",
) -> dict[str, int]:
    """Silver with transit -> gold detail and overview tables (small, one file each)."""
    silver = read_partitioned(spark, layout.silver_transit, "transit_proximity_category")
    detail, d_obs = observe_counts(gold_detail(silver, names, median=median), "detail")
    overview, o_obs = observe_counts(gold_overview(silver, names), "overview")
    write_single_file(detail, layout.gold_detail)
    write_single_file(overview, layout.gold_overview)
    return {"detail_rows": d_obs.get["rows"], "overview_rows": o_obs.get["rows"]}


# -------------------------------------------------------------------- batch


def run_batch(
    spark: SparkSession,
    base_path: str,
    stages: Sequence[str] | None = None,
    skip_ingestion: bool = False,
    centroids: DataFrame | None = None,
    names: Mapping[str, str] | DataFrame = NEIGHBOURHOOD_NAMES,
    as_of_year: int | None = None,
    ties: str = "all",
) -> dict[str, dict[str, int]]:
    """Run the chosen stages in order; a failing stage stops the batch.

    ``stages`` is any of ``ingest``, ``ingest_properties``, ``ingest_stops``
    (also called ``ingest_translink``), ``transform``, ``gold`` (default:
    ingest, transform, gold). ``skip_ingestion`` keeps the existing bronze
    tables. ``names``, ``as_of_year`` and ``ties`` go to the stages that use them.
    """
    chosen = tuple(stages) if stages is not None else DEFAULT_STAGES
    unknown = set(chosen) - set(STAGES)
    if unknown:
        raise ValueError(f"unknown stages: {sorted(unknown)}")
    layout = Layout(base_path)
    plan = []
    if not skip_ingestion:
        if "ingest" in chosen or "ingest_properties" in chosen:
            plan.append(("ingest_properties", lambda: ingest_properties(spark, layout)))
        if {"ingest", "ingest_stops", "ingest_translink"} & set(chosen):
            plan.append(("ingest_stops", lambda: ingest_stops(spark, layout)))
    if "transform" in chosen:
        plan.append(("transform_properties", lambda: clean_job(spark, layout, as_of_year)))
        plan.append(("transform_proximity", lambda: enrich_job(spark, layout, centroids, ties)))
    if "gold" in chosen:
        plan.append(("gold", lambda: gold_job(spark, layout, names)))
    results: dict[str, dict[str, int]] = {}
    for name, run in plan:
        t0 = time.time()
        results[name] = run()
        log.info("stage %s done in %.1fs: %s", name, time.time() - t0, results[name])
    return results
