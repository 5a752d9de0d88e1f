"""Instants: ISO text to timestamp and back, hour arithmetic, explicit clocks.

Formatting follows the session zone, which ``session.configure`` pins to UTC.
"""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_instant(text: Column) -> Column:
    """ISO text to timestamp; ``Z`` and offsets are honoured, malformed text is NULL."""
    return text.try_cast("timestamp")


def iso_seconds(instant: Column) -> Column:
    """``2024-01-31T06:00:00Z``: the form of request bounds, cut to the second."""
    return F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def iso_offset(instant: Column) -> Column:
    """``2024-01-31T06:00:00+00:00``, with microseconds only where there are any."""
    whole = F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
    micros = F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
    return F.when(F.date_format(instant, "SSSSSS") == "000000", whole).otherwise(micros)


def hours(n: int) -> Column:
    return F.make_dt_interval(hours=F.lit(n))


def utc(instant: datetime) -> datetime:
    """A naive clock reading is taken as UTC."""
    if instant.tzinfo is None:
        return instant.replace(tzinfo=timezone.utc)
    return instant.astimezone(timezone.utc)


def instant_or_now(instant: datetime | None) -> Column:
    return F.current_timestamp() if instant is None else F.lit(utc(instant))


def day_or_today(day: date | None) -> Column:
    return F.current_date() if day is None else F.lit(day)
