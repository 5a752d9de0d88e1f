"""Daily statistics per sensor and parameter."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline import schemas
from gaugeline.functions.instants import day_or_today
from gaugeline.functions.values import completeness
from gaugeline.operators.bronze import ranked
from gaugeline.operators.joins import lookup_join
from gaugeline.session import materialise

TRAILING_DAYS = 30
# Up to this many values the sketch keeps every one (its accuracy is 10,000), merged or not.
SKETCH_VALUES = 4_999
GROUP = ["sensor_id", "location_id", "country_code", "parameter_id", "parameter_name", "day_start"]


def trailing_days(
    df: DataFrame,
    column: str = "measurement_datetime_from_utc",
    as_of: date | None = None,
    days: int = TRAILING_DAYS,
) -> DataFrame:
    """Rows from midnight ``days`` days before ``as_of`` on, with no upper bound."""
    return df.where(F.col(column) >= F.date_sub(day_or_today(as_of), days))


def daily_stats(fact: DataFrame) -> DataFrame:
    """Mean, extremes, population deviation, percentiles, count and completeness.

    Every aggregate combines on the map side, so a sensor with very many readings
    reaches the shuffle as one partial state per task. Both percentiles come from
    one sketch, which is exact for groups of up to ``SKETCH_VALUES``; those of larger
    groups are looked up by rank. The statistics are written once to find these groups.
    """
    rows = fact.withColumn("day_start", F.to_date("measurement_datetime_from_utc"))
    stats = rows.groupBy(*GROUP).agg(
        F.avg("value").alias("avg_value"),
        F.min("value").alias("min_value"),
        F.max("value").alias("max_value"),
        F.stddev_pop("value").alias("stddev_value"),
        F.percentile_approx("value", [0.95, 0.05]).alias("__percentiles"),
        F.count("*").cast("int").alias("reading_count"),
        completeness(F.count("*")).alias("completeness_ratio"),
        F.count("value").alias("__values"),
    )
    stats = materialise(stats, "daily-stats").withColumns(
        {"perc95_value": F.col("__percentiles")[0], "perc05_value": F.col("__percentiles")[1]}
    )
    columns = schemas.DAILY.fieldNames()
    large = stats.where(F.col("__values") > SKETCH_VALUES).withColumn("__group", F.struct(*GROUP))
    if large.isEmpty():
        return stats.select(*columns)
    exact = exact_percentiles(rows, large.select("__group", "__values"))
    corrected = large.drop("perc95_value", "perc05_value").join(exact, "__group").select(*columns)
    return stats.where(F.col("__values") <= SKETCH_VALUES).select(*columns).unionByName(corrected)


def exact_percentiles(rows: DataFrame, large: DataFrame) -> DataFrame:
    """(__group, perc95_value, perc05_value) of the groups of ``large``, which counts their values.

    Values get their places from a sort by ranges, so no task receives a whole group.
    """
    values = rows.where(F.col("value").isNotNull()).select(F.struct(*GROUP).alias("__group"), "value")
    among = lookup_join(values, large.select("__group"), ["__group"], "left_semi")
    # Whole numbers: the place is the least that is not below the share.
    wanted = large.withColumn("__percent", F.explode(F.array(F.lit(95), F.lit(5)))).select(
        "__group", "__percent", F.expr("(__values * __percent + 99) div 100").alias("__rank")
    )
    found = lookup_join(ranked(among, ["__group"], ["value"]), wanted, ["__group", "__rank"], "inner")
    return found.groupBy("__group").agg(
        F.max(F.when(F.col("__percent") == 95, F.col("value"))).alias("perc95_value"),
        F.max(F.when(F.col("__percent") == 5, F.col("value"))).alias("perc05_value"),
    )
