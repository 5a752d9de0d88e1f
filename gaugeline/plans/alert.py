"""Alert run over the catalog tables."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from gaugeline.operators import alerts
from gaugeline.session import configure
from gaugeline.sources import catalog
from gaugeline.sources.limits import RECOMMENDED_LIMITS, limits


def run_alert(
    spark: SparkSession,
    tables: catalog.Tables,
    day: date | None = None,
    limit_rows: Iterable[tuple[int, int]] = RECOMMENDED_LIMITS,
) -> tuple[DataFrame, DataFrame]:
    """The breaches of a day and the alert state they give; reads that day only."""
    configure(spark)
    found = alerts.breaches(
        spark.table(tables.daily), spark.table(tables.dim_locations), limits(spark, limit_rows), day
    )
    return found, alerts.alert_state(found)
