"""Bronze batches to one row per reading."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from gaugeline import schemas
from gaugeline.functions.instants import instant_or_now, parse_instant
from gaugeline.functions.values import item_parameter_id
from gaugeline.operators.joins import lookup_join


def distinct_batches(df: DataFrame) -> DataFrame:
    return df.select("batch_id").distinct()


def unprocessed_batches(bronze: DataFrame, processed: DataFrame) -> DataFrame:
    """Bronze rows of batches that ``processed`` does not name.

    All rows of a run share one batch id, so payload rows are never shuffled by
    it: the distinct ids are broadcast once counted. A NULL batch id is never
    processed.
    """
    return lookup_join(bronze, distinct_batches(processed), ["batch_id"], "left_anti")


def explode_batches(
    bronze: DataFrame, run_ts: datetime | None = None, observation: Observation | None = None
) -> DataFrame:
    """Parse each payload and give one staging row per reading.

    A payload that is NULL, empty or malformed gives no row; a malformed instant or
    batch parameter is NULL instead of failing the run (``payload_rejects`` and
    ``instant_rejects`` count them). ``observation`` learns ``rejected_payloads`` when the
    rows are written.
    """
    # What all readings of a row share is parsed before they are told apart.
    shared = ["ingestion_datetime", "ingestion_window_datetime_from", "ingestion_window_datetime_to"]
    parsed = bronze.withColumns(
        {
            "items": F.from_json("api_payload", schemas.MEASUREMENT_ITEMS),
            **{name: parse_instant(F.col(name)) for name in shared},
        }
    )
    if observation is not None:
        rejected = F.count_if(F.col("items").isNull()).alias("rejected_payloads")
        parsed = parsed.observe(observation, rejected)
    return parsed.withColumn("item", F.explode("items")).select(
        "batch_id",
        "sensor_id",
        "location_id",
        "country_code",
        item_parameter_id(F.col("item.parameter.id"), F.col("parameter_id")).alias("parameter_id"),
        F.col("item.parameter.name").alias("parameter_name"),
        F.col("item.value").alias("value"),
        F.col("item.unit").alias("unit"),
        parse_instant(F.col("item.period.datetimeFrom.utc")).alias("measurement_datetime_from_utc"),
        parse_instant(F.col("item.period.datetimeTo.utc")).alias("measurement_datetime_to_utc"),
        *shared,
        F.to_json("item").alias("raw_json"),
        instant_or_now(run_ts).alias("exploded_at"),
    )


def to_fact(staging: DataFrame, run_ts: datetime | None = None) -> DataFrame:
    loaded = staging.withColumn("loaded_at", instant_or_now(run_ts))
    return loaded.select(*schemas.FACT.fieldNames())


def payload_rejects(bronze: DataFrame) -> DataFrame:
    """Bronze rows per batch whose payload does not parse at all."""
    items = F.from_json("api_payload", schemas.MEASUREMENT_ITEMS)
    return bronze.groupBy("batch_id").agg(
        F.count_if(items.isNull()).alias("rejected_payloads")
    )


def instant_rejects(staging: DataFrame) -> DataFrame:
    """Readings per batch without a usable start or end."""
    return staging.groupBy("batch_id").agg(
        F.count_if(
            F.col("measurement_datetime_from_utc").isNull()
            | F.col("measurement_datetime_to_utc").isNull()
        ).alias("rejected_instants")
    )
