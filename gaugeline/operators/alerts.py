"""Threshold alert: the day's means above their limit, and the state they give."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.functions.instants import day_or_today

TRIGGER_ABOVE = 1.0


def with_location(daily: DataFrame, locations: DataFrame) -> DataFrame:
    """Add the location's name where the location is known."""
    names = locations.select("location_id", F.col("name").alias("location_name"))
    return daily.join(names, "location_id", "left")


def breaches(
    daily: DataFrame, locations: DataFrame, limits: DataFrame, day: date | None = None
) -> DataFrame:
    """Daily means of ``day`` above the limit of their parameter, each once.

    Limits come first: they are a handful of constants and cut the day's rows down
    to the breaches before locations are joined.
    """
    above = (
        daily.where(F.col("day_start") == day_or_today(day))
        .join(limits, "parameter_id", "left")
        .where(F.col("max_limit").isNotNull() & (F.col("avg_value") > F.col("max_limit")))
    )
    named = with_location(above, locations).select(
        "country_code",
        "location_id",
        "location_name",
        "parameter_id",
        "parameter_name",
        "day_start",
        "avg_value",
        "max_limit",
    )
    return named.distinct().orderBy("day_start")


def alert_state(found: DataFrame, above: float = TRIGGER_ABOVE) -> DataFrame:
    """One row: TRIGGERED when more than ``above`` breaches name a country, else OK."""
    return found.agg(F.count("country_code").alias("breach_count")).select(
        "breach_count",
        F.when(F.col("breach_count") > above, "TRIGGERED").otherwise("OK").alias("state"),
    )
