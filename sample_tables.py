"""The test tables read as domain tables.

events -> readings: a sensor is one (user, event type), its reading covers the hour
of the event. customer -> locations, nation -> countries; a sensor's location is the
customer with the user's number.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline.functions.instants import iso_seconds
from gaugeline.operators.bronze import pack_documents, stamp_locations, stamp_measurements
from gaugeline.operators.joins import lookup_join
from gaugeline.sources.landing import request_folder

# Parameter ids of the event types.
PARAMETERS = [("click", 1), ("error", 2), ("purchase", 3), ("signup", 4), ("view", 5)]
UNIT = "µg/m³"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def parameter_of(event_type: Column) -> Column:
    """Parameter id of an event type; NULL for an unknown one."""
    ids = F.lit(None).cast("int")
    for name, number in PARAMETERS:
        ids = F.when(event_type == name, F.lit(number)).otherwise(ids)
    return ids


def sensor_of(user_id: Column, parameter_id: Column) -> Column:
    return (user_id * 10 + parameter_id).cast("int")


def country_of(nation_name: Column) -> Column:
    return F.replace(nation_name, F.lit("ATION_"), F.lit(""))


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """location_id, country_code of every customer."""
    nation = table(spark, sf_dir, "nation")
    customer = table(spark, sf_dir, "customer")
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
        F.col("c_custkey").cast("int").alias("location_id"),
        country_of(F.col("n_name")).alias("country_code"),
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with sensor, location and parameter numbers and an instant."""
    parameter_id = parameter_of(F.col("event_type"))
    at = F.col("ts").cast("timestamp")
    hour = F.date_trunc("hour", at)
    return table(spark, sf_dir, "events").select(
        "event_id",
        sensor_of(F.col("user_id"), parameter_id).alias("sensor_id"),
        F.col("user_id").cast("int").alias("location_id"),
        parameter_id.alias("parameter_id"),
        F.col("event_type").alias("parameter_name"),
        "value",
        F.lit(UNIT).alias("unit"),
        at.alias("at"),
        hour.alias("measurement_datetime_from_utc"),
        (hour + F.expr("interval 1 hour")).alias("measurement_datetime_to_utc"),
    )


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact-like rows: events with the country of their location."""
    return lookup_join(events(spark, sf_dir), places(spark, sf_dir), ["location_id"], "left")


def measurement_document() -> Column:
    """One reading in the shape of the feed."""
    return F.struct(
        F.col("value").alias("value"),
        F.col("unit").alias("unit"),
        F.struct(
            F.col("parameter_id").alias("id"),
            F.col("parameter_name").alias("name"),
            F.col("unit").alias("units"),
            F.initcap("parameter_name").alias("displayName"),
        ).alias("parameter"),
        F.struct(
            F.lit("1hour").alias("label"),
            F.lit("01:00:00").alias("interval"),
            F.struct(iso_seconds(F.col("measurement_datetime_from_utc")).alias("utc")).alias(
                "datetimeFrom"
            ),
            F.struct(iso_seconds(F.col("measurement_datetime_to_utc")).alias("utc")).alias(
                "datetimeTo"
            ),
        ).alias("period"),
    )


def bronze_measurements(
    documents: DataFrame, batch_id: str, run_ts: datetime, window: tuple[str, str]
) -> DataFrame:
    """Readings packed and stamped as one batch, a row per sensor up to 1000 readings."""
    packed = pack_documents(
        documents,
        ["sensor_id", "parameter_id", "location_id", "country_code"],
        ["event_id"],
        measurement_document(),
    )
    return stamp_measurements(packed, batch_id, run_ts, F.lit(window[0]), F.lit(window[1]))


def location_documents(
    spark: SparkSession, sf_dir: str, until: datetime | None = None
) -> DataFrame:
    """Customers as feed documents, as known at ``until``: nested country,
    coordinates and sensors.

    Machinery customers come without coordinates, customers without events come
    without a last reading and without sensors.
    """
    nation = table(spark, sf_dir, "nation")
    customer = table(spark, sf_dir, "customer").join(
        nation, F.col("c_nationkey") == F.col("n_nationkey"), "left"
    )
    seen = events(spark, sf_dir)
    if until is not None:
        seen = seen.where(F.col("at") < F.lit(until))
    seen = seen.groupBy("location_id").agg(
        F.max("at").alias("last"),
        # At most one entry per parameter.
        F.array_sort(F.collect_set(F.struct("sensor_id", "parameter_id", "parameter_name"))).alias(
            "found"
        ),
    )
    sensors = F.transform(
        "found",
        lambda x: F.struct(
            x["sensor_id"].alias("id"),
            F.concat(x["parameter_name"], F.lit(" "), F.lit(UNIT)).alias("name"),
            F.struct(
                x["parameter_id"].alias("id"),
                x["parameter_name"].alias("name"),
                F.lit(UNIT).alias("units"),
                F.initcap(x["parameter_name"]).alias("displayName"),
            ).alias("parameter"),
        ),
    )
    joined = customer.withColumn("location_id", F.col("c_custkey").cast("int")).join(
        seen, "location_id", "left"
    )
    return joined.select(
        "location_id",
        F.col("c_nationkey").alias("nation"),
        F.struct(
            F.col("location_id").alias("id"),
            F.col("c_name").alias("name"),
            F.col("c_mktsegment").alias("locality"),
            F.struct(
                F.col("n_name").alias("name"), country_of(F.col("n_name")).alias("code")
            ).alias("country"),
            F.when(
                F.col("c_mktsegment") != "MACHINERY",
                F.struct(
                    F.col("c_acctbal").alias("latitude"), F.col("c_nationkey").alias("longitude")
                ),
            ).alias("coordinates"),
            F.when(
                F.col("last").isNotNull(), F.struct(iso_seconds(F.col("last")).alias("utc"))
            ).alias("datetimeLast"),
            sensors.alias("sensors"),
        ).alias("document"),
    )


def location_snapshot(
    documents: DataFrame, batch_id: str, run_ts: datetime
) -> DataFrame:
    """Location documents as one snapshot in chunks of up to 1000 locations."""
    packed = pack_documents(documents, [], ["location_id"], F.col("document"))
    return stamp_locations(packed, batch_id, run_ts)


def land(pages: DataFrame, path: str, request: str | None = None) -> None:
    """Write packed documents as page responses, one JSON document per line.

    ``request`` names the folder of one request; a ``status`` column replaces 200.
    """
    if "status" not in pages.columns:
        pages = pages.withColumn("status", F.lit(200))
    head = [c for c in pages.columns if c not in ("rows_fetched", "api_payload")]
    fields = F.to_json(F.struct(*head))
    body = F.concat(
        F.regexp_replace(fields, r"\}$", ',"results":'), F.col("api_payload"), F.lit("}")
    )
    folder = request_folder(path, request) if request else path
    pages.select(body.alias("value")).write.text(folder)
