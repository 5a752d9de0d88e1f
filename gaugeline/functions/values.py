"""Scalar rules of the domain."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_COUNTRY = "PT"
READINGS_PER_DAY = "24.0"


def normalise_country(code: Column) -> Column:
    """Upper case; a missing or empty code is the default country."""
    return F.upper(F.when(code != "", code).otherwise(F.lit(DEFAULT_COUNTRY)))


def item_parameter_id(item_id: Column, batch_id: Column) -> Column:
    """The item's own parameter id, else the batch's, which is text in bronze."""
    return F.coalesce(item_id, batch_id.try_cast("int"))


def completeness(readings: Column) -> Column:
    """Share of the expected readings of a day, rounded to 6 places, not capped at 1."""
    return (readings / F.lit(READINGS_PER_DAY).cast("decimal(3,1)")).cast("double")


def duration_text(seconds: Column) -> Column:
    """Seconds as ``HH:MM:SS.ss``."""
    minutes = F.floor(seconds / 60)
    return F.format_string(
        "%02d:%02d:%05.2f",
        F.floor(minutes / 60),
        F.pmod(minutes, F.lit(60)),
        (seconds - minutes * 60).cast("double"),
    )
