"""Dimension run: landed location pages to snapshot to dimensions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import SparkSession

from gaugeline import schemas
from gaugeline.functions.instants import utc
from gaugeline.operators import bronze, dimensions, upsert
from gaugeline.session import configure, materialise
from gaugeline.sources import catalog, landing


def ingest_locations(
    spark: SparkSession, tables: catalog.Tables, batch_id: str, run_ts: datetime, path: str
) -> None:
    """Append one snapshot; a feed without locations leaves an empty one."""
    landed = landing.landed_once(landing.read_location_pages(spark, path, batch_id))
    pages = landing.page_prefix(landed, [])
    rows = bronze.stamp_locations(bronze.pack_pages(pages), batch_id, run_ts)
    if rows.isEmpty():
        empty = [(batch_id, utc(run_ts).isoformat(), 0, "[]")]
        rows = spark.createDataFrame(empty, schemas.BRONZE_LOCATIONS)
    catalog.append(rows, tables.bronze_locations)


def build_dimensions(
    spark: SparkSession,
    tables: catalog.Tables,
    run_ts: datetime,
    dedupe_source: bool = False,
) -> None:
    """Bring both dimensions up to the newest snapshot; without one nothing changes."""
    snapshot = dimensions.latest_snapshot(spark.table(tables.bronze_locations))
    locations = materialise(dimensions.flatten_locations(snapshot, run_ts), "locations")
    if locations.isEmpty():
        return
    catalog.publish(
        upsert.upsert_locations(
            spark.table(tables.dim_locations), locations, run_ts, dedupe_source=dedupe_source
        ),
        tables.dim_locations,
    )
    sensors = materialise(dimensions.flatten_sensors(snapshot, run_ts), "sensors")
    if not sensors.isEmpty():
        catalog.publish(
            upsert.upsert_sensors(
                spark.table(tables.dim_sensors), sensors, run_ts, dedupe_source=dedupe_source
            ),
            tables.dim_sensors,
        )


def run_dimensions(
    spark: SparkSession,
    tables: catalog.Tables,
    batch_id: str,
    run_ts: datetime,
    landing_path: str | None = None,
    dedupe_source: bool = False,
) -> None:
    configure(spark)
    catalog.ensure_all(spark, tables)
    if landing_path is not None:
        ingest_locations(spark, tables, batch_id, run_ts, landing_path)
    build_dimensions(spark, tables, run_ts, dedupe_source)
