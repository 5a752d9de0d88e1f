"""Recommended maxima per parameter, in µg/m³."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from gaugeline import schemas

# Fixed values: (parameter id, limit).
RECOMMENDED_LIMITS = [
    (2, 20),  # PM2.5, 24 h
    (1, 45),  # PM10, 24 h
    (3, 120),  # ozone, 8 h
    (5, 50),  # NO2, 24 h
    (6, 50),  # SO2, 24 h
    (4, 4000),  # CO, 24 h
]


def limits(
    spark: SparkSession, rows: Iterable[tuple[int, int]] = RECOMMENDED_LIMITS
) -> DataFrame:
    """An inline relation, so the planner knows its size and broadcasts it."""
    pairs = ", ".join(f"({int(parameter)}, {int(limit)})" for parameter, limit in rows)
    columns = ", ".join(schemas.LIMITS.fieldNames())
    return spark.sql(f"SELECT * FROM VALUES {pairs} AS t({columns})")
