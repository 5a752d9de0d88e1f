"""Ingestion planning: high-water marks, windows, work list."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.functions.instants import hours, instant_or_now, parse_instant
from gaugeline.operators.joins import lookup_join

# Fixed values of the feed's schedule.
MIN_LAG_HOURS = 2
FIRST_RUN_HOURS = 4
MAX_CHUNK_HOURS = 8


def high_water_mark(bronze: DataFrame) -> DataFrame:
    """The last window of every country, as ISO text."""
    last = F.max(F.struct("ingestion_window_datetime_to", "ingestion_window_datetime_from"))
    return bronze.groupBy("country_code").agg(last.alias("last")).select(
        "country_code",
        F.col("last.ingestion_window_datetime_from").alias("last_from"),
        F.col("last.ingestion_window_datetime_to").alias("last_to"),
    )


def window_after(
    last_to: Column,
    now: Column,
    min_lag: int = MIN_LAG_HOURS,
    first_run: int = FIRST_RUN_HOURS,
    max_chunk: int = MAX_CHUNK_HOURS,
) -> Column:
    """Struct (window_from, window_to) that follows ``last_to``; NULL when up to date.

    The window ends at most ``min_lag`` hours before ``now`` and spans at most
    ``max_chunk`` hours; without history it spans ``first_run`` hours.
    """
    cap = now - hours(min_lag)
    first = F.struct((cap - hours(first_run)).alias("window_from"), cap.alias("window_to"))
    following = F.struct(
        last_to.alias("window_from"),
        F.least(last_to + hours(max_chunk), cap).alias("window_to"),
    )
    return F.when(last_to.isNull(), first).when(last_to < cap, following)


def ingest_window(
    marks: DataFrame,
    now: datetime | None = None,
    min_lag: int = MIN_LAG_HOURS,
    first_run: int = FIRST_RUN_HOURS,
    max_chunk: int = MAX_CHUNK_HOURS,
) -> DataFrame:
    """The next window of every row of ``marks``; up-to-date ones are left out."""
    window = window_after(
        parse_instant(F.col("last_to")), instant_or_now(now), min_lag, first_run, max_chunk
    )
    return (
        marks.withColumn("__w", window)
        .where(F.col("__w").isNotNull())
        .select(*marks.columns, "__w.*")
    )


def country_windows(
    locations: DataFrame, bronze: DataFrame, now: datetime | None = None
) -> DataFrame:
    """The next window of every country with a location, also without history."""
    countries = locations.select("country_code").dropna().distinct()
    marks = countries.join(high_water_mark(bronze), "country_code", "left")
    return ingest_window(marks, now).select("country_code", "window_from", "window_to")


def in_country(df: DataFrame, country_code: str) -> DataFrame:
    return df.where(F.col("country_code") == country_code)


def sensors_in_country(
    sensors: DataFrame, locations: DataFrame, country_code: str | None = None
) -> DataFrame:
    """Sensors whose location is known, of one country or of all."""
    places = locations.select("location_id", "country_code")
    if country_code is not None:
        places = in_country(places, country_code)
    joined = sensors.select("sensor_id", "location_id", "parameter_id").join(
        places, "location_id", "inner"
    )
    return joined.select("sensor_id", "location_id", "parameter_id", "country_code")


def fetch_plan(sensors: DataFrame, windows: DataFrame) -> DataFrame:
    """The work list: each sensor with the window of its country."""
    return lookup_join(sensors, windows, ["country_code"], "inner").select(
        "sensor_id", "location_id", "parameter_id", "country_code", "window_from", "window_to"
    )
