"""Location snapshots to location and sensor rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline import schemas
from gaugeline.functions.instants import instant_or_now


def latest_snapshot(snapshots: DataFrame) -> DataFrame:
    """All rows of the newest snapshot; none if there is no snapshot.

    The newest is one row found by a maximum over narrow columns. It is put into the
    filter as a literal, which prunes the partitions of all other snapshots.
    """
    run = F.max(F.struct("ingestion_time", "batch_id")).alias("run")
    newest = snapshots.agg(run).first().run
    if newest is None:
        return snapshots.where(F.lit(False))
    return snapshots.where(
        F.col("batch_id").eqNullSafe(F.lit(newest.batch_id))
        & F.col("ingestion_time").eqNullSafe(F.lit(newest.ingestion_time))
    )


def _locations(snapshot: DataFrame) -> DataFrame:
    items = F.from_json("api_payload", schemas.LOCATION_ITEMS)
    return snapshot.select(
        F.col("ingestion_time").alias("bronze_ingestion_time"), F.explode(items).alias("loc")
    )


def flatten_locations(snapshot: DataFrame, run_ts: datetime | None = None) -> DataFrame:
    """One row per location; a missing object reads as NULL fields."""
    return _locations(snapshot).select(
        F.col("loc.id").alias("location_id"),
        F.col("loc.name").alias("name"),
        F.col("loc.locality").alias("locality"),
        F.col("loc.country.name").alias("country_name"),
        F.col("loc.country.code").alias("country_code"),
        F.col("loc.coordinates.latitude").alias("coordinates_latitude"),
        F.col("loc.coordinates.longitude").alias("coordinates_longitude"),
        F.col("loc.datetimeLast.utc").alias("last_updated_utc"),
        "bronze_ingestion_time",
        instant_or_now(run_ts).alias("dim_ingested_at"),
    )


def flatten_sensors(snapshot: DataFrame, run_ts: datetime | None = None) -> DataFrame:
    """One row per sensor of each location; a location without sensors gives none."""
    sensors = _locations(snapshot).select(
        "bronze_ingestion_time",
        F.col("loc.id").alias("location_id"),
        F.explode("loc.sensors").alias("sensor"),
    )
    return sensors.select(
        F.col("sensor.id").alias("sensor_id"),
        F.col("sensor.name").alias("name"),
        F.col("sensor.parameter.id").alias("parameter_id"),
        F.col("sensor.parameter.name").alias("parameter_name"),
        F.col("sensor.parameter.units").alias("parameter_units"),
        F.col("sensor.parameter.displayName").alias("parameter_display_name"),
        "location_id",
        "bronze_ingestion_time",
        instant_or_now(run_ts).alias("dim_ingested_at"),
    )
