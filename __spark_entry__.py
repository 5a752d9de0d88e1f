
from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import sample_tables as sample  # noqa: E402
from gaugeline import schemas  # noqa: E402
from gaugeline.functions import instants, values  # noqa: E402
from gaugeline.operators import (  # noqa: E402
    alerts,
    audit,
    bronze,
    daily,
    dimensions,
    planning,
    silver,
    upsert,
)
from gaugeline.plans import dimensions as dimension_plan  # noqa: E402
from gaugeline.plans import facts as fact_plan  # noqa: E402
from gaugeline.plans.alert import run_alert  # noqa: E402
from gaugeline.session import configure, materialise, scratch_dir  # noqa: E402
from gaugeline.sources import catalog, landing, limits  # noqa: E402
from gaugeline.streaming.facts import stream_facts  # noqa: E402
from gaugeline.streaming.pages import stream_pages  # noqa: E402

SMOKE_DIR = "/root/testdata/sf0.001"

# Clocks and ids are arguments everywhere; these are the ones the queries use.
RUN_TS = datetime(2024, 2, 1, 6, 30, 0, 250000, tzinfo=timezone.utc)
FIRST_RUN_TS = datetime(2024, 1, 16, 0, 0, tzinfo=timezone.utc)
SECOND_RUN_TS = datetime(2024, 1, 16, 12, 0, tzinfo=timezone.utc)
BUSY_RUN_TS = datetime(2024, 1, 6, 18, 0, tzinfo=timezone.utc)
OVERLAP_FROM = datetime(2024, 1, 10, 0, 0, tzinfo=timezone.utc)
PLAN_TS = datetime(2024, 1, 31, 0, 0, tzinfo=timezone.utc)
AS_OF = date(2024, 2, 10)
ALERT_DAY = date(2024, 1, 15)
ALERT_LIMITS = [(1, 60), (5, 45), (2, 120)]
WINDOW = ("2024-01-01T00:00:00+00:00", "2024-01-31T00:00:00+00:00")
COUNTRY = "N10"


def _plain(df: DataFrame) -> DataFrame:
    """Instants without zone, which compare the same in every client."""
    return df.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name)
            if isinstance(f.dataType, T.TimestampType)
            else F.col(f.name)
            for f in df.schema
        ]
    )


def _rounded(df: DataFrame) -> DataFrame:
    """Means and deviations depend on summation order in the last digits."""
    return df.withColumns(
        {c: F.round(c, 6) for c in ("avg_value", "stddev_value") if c in df.columns}
    )


def _tables(spark: SparkSession) -> catalog.Tables:
    """A new database in the shared scratch folder."""
    name = f"gaugeline_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_dir(spark, name)}'")
    return catalog.Tables(name)


# --- sources and sinks ----------------------------------------------------------


def scan_table(spark: SparkSession, sf: str) -> DataFrame:
    sample.table(spark, sf, "events").createOrReplaceTempView("gaugeline_events")
    return spark.table("gaugeline_events")


def src_location_pages(spark: SparkSession, sf: str) -> DataFrame:
    documents = sample.location_documents(spark, sf).withColumn("page", F.col("nation") + 1)
    path = scratch_dir(spark, "location-pages")
    sample.land(
        bronze.pack_documents(documents, ["page"], ["location_id"], F.col("document")), path
    )
    pages = landing.read_location_pages(spark, path)
    items = pages.select("page", F.explode("results").alias("text")).select(
        "page", F.from_json("text", schemas.LOCATION_ITEM).alias("loc")
    )
    return items.select(
        "page",
        F.col("loc.id").alias("location_id"),
        F.col("loc.name").alias("name"),
        F.col("loc.country.code").alias("country_code"),
        F.size("loc.sensors").alias("sensors"),
    )


def src_measurement_pages(spark: SparkSession, sf: str) -> DataFrame:
    documents = sample.events(spark, sf).withColumn("page", F.dayofmonth("at"))
    path = scratch_dir(spark, "measurement-pages")
    packed = bronze.pack_documents(
        documents, ["sensor_id", "page"], ["event_id"], sample.measurement_document()
    )
    sample.land(packed, path)
    inside = landing.within_window(
        F.col("results"), F.lit(OVERLAP_FROM), F.lit(FIRST_RUN_TS)
    )
    pages = landing.read_measurement_pages(spark, path).withColumn("results", inside)
    items = pages.select("sensor_id", "page", F.explode("results").alias("text")).select(
        "sensor_id", "page", F.from_json("text", schemas.MEASUREMENT_ITEM).alias("item")
    )
    return items.select(
        "sensor_id",
        "page",
        F.col("item.parameter.name").alias("parameter_name"),
        F.col("item.value").alias("value"),
        F.col("item.period.datetimeFrom.utc").alias("from_utc"),
    )


def page_prefix(spark: SparkSession, sf: str) -> DataFrame:
    """A user's feed has one page per day of the month; two readings fill a page."""
    pages = (
        sample.table(spark, sf, "events")
        .groupBy("user_id", F.dayofmonth("ts").alias("page"))
        .agg(
            F.count("*").alias("documents"),
            F.when(F.max("value") > 300, 500).otherwise(200).alias("status"),
        )
    )
    return landing.page_prefix(pages, ["user_id"], page_limit=2).select(
        "user_id", "page", "documents"
    )


def page_prefix_requests(spark: SparkSession, sf: str) -> DataFrame:
    """Two requests for each user, told apart by the kind of event; pages as above."""
    pages = (
        sample.table(spark, sf, "events")
        .withColumn("request", F.when(F.col("event_type") < "d", "a").otherwise("b"))
        .groupBy("request", "user_id", (F.dayofmonth("ts") % 4 + 1).alias("page"))
        .agg(
            F.count("*").alias("documents"),
            F.when(F.max("value") > 300, 500).otherwise(200).alias("status"),
        )
    )
    return landing.page_prefix(pages, ["request", "user_id"], page_limit=2).select(
        "request", "user_id", "page", "documents"
    )


def bronze_pack_chunks(spark: SparkSession, sf: str) -> DataFrame:
    """Packing into rows of two documents; the documents unpacked again."""
    packed = bronze.pack_documents(
        sample.readings(spark, sf), ["location_id"], ["event_id"], sample.measurement_document(), 2
    )
    document = F.explode(F.from_json("api_payload", "array<string>")).alias("document")
    fits = (F.col("rows_fetched") <= 2).alias("fits")
    return packed.select("location_id", fits, document)


def bronze_pack_order(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of at most seven documents, as they are: large groups are cut in order as well."""
    return bronze.pack_documents(
        sample.readings(spark, sf), ["parameter_id"], ["event_id"], sample.measurement_document(), 7
    )


def values_limits(spark: SparkSession, sf: str) -> DataFrame:
    """Inline constants against the readings: how many there are and exceed them."""
    joined = sample.events(spark, sf).join(limits.limits(spark), "parameter_id", "inner")
    counts = joined.groupBy("parameter_id", "max_limit").agg(
        F.count("*").alias("readings"),
        F.count_if(F.col("value") > F.col("max_limit")).alias("above_limit"),
    )
    return counts


def bronze_pack(spark: SparkSession, sf: str) -> DataFrame:
    return bronze.pack_documents(
        sample.readings(spark, sf),
        ["sensor_id", "parameter_id", "location_id", "country_code"],
        ["event_id"],
        sample.measurement_document(),
    )


def _bronze(spark: SparkSession, sf: str, batch_id: str = "run-1") -> DataFrame:
    return sample.bronze_measurements(sample.readings(spark, sf), batch_id, RUN_TS, WINDOW)


def batch_stamp(spark: SparkSession, sf: str) -> DataFrame:
    return _bronze(spark, sf).drop("api_payload")


def append_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    configure(spark)
    tables = _tables(spark)
    events = _plain(sample.events(spark, sf)).select("event_id", "sensor_id", "value", "at")
    catalog.ensure_like(events, f"{tables.database}.appended")
    early = F.col("at") < F.lit(FIRST_RUN_TS).cast("timestamp_ntz")
    for part in (events.where(early), events.where(~early), events.where(early)):
        catalog.append(part, f"{tables.database}.appended")
    return spark.table(f"{tables.database}.appended")


# --- projections, filters, scalar functions -----------------------------------------


def project_columns(spark: SparkSession, sf: str) -> DataFrame:
    return sample.table(spark, sf, "events").select("event_id", "user_id", "event_type")


def filter_country(spark: SparkSession, sf: str) -> DataFrame:
    found = planning.in_country(sample.readings(spark, sf), COUNTRY)
    return found.select("event_id", "sensor_id", "location_id", "country_code")


def filter_trailing_days(spark: SparkSession, sf: str) -> DataFrame:
    recent = daily.trailing_days(sample.table(spark, sf, "events"), "ts", AS_OF)
    return recent.select("event_id", "user_id", "ts")


def normalise_country(spark: SparkSession, sf: str) -> DataFrame:
    """Codes in lower case, empty for building customers, missing for machinery."""
    code = F.when(F.col("c_mktsegment") == "BUILDING", "").when(
        F.col("c_mktsegment") != "MACHINERY", F.lower(sample.country_of(F.col("n_name")))
    )
    customer = sample.table(spark, sf, "customer")
    nation = sample.table(spark, sf, "nation")
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
        "c_custkey", values.normalise_country(code).alias("country_code")
    )


def coalesce_parameter(spark: SparkSession, sf: str) -> DataFrame:
    """Items of some types carry no id; batches of one type a name instead of a number."""
    kind = F.col("parameter_name")
    item_id = F.when(kind.isin("click", "error"), F.col("parameter_id"))
    batch_id = F.when(kind == "view", kind).otherwise(F.col("parameter_id").cast("string"))
    return sample.events(spark, sf).select(
        "event_id", values.item_parameter_id(item_id, batch_id).alias("parameter_id")
    )


def parse_iso_ts(spark: SparkSession, sf: str) -> DataFrame:
    """Text with Z, with an offset, without zone, and malformed."""
    kind = F.col("parameter_name")
    local = F.date_format("at", "yyyy-MM-dd'T'HH:mm:ss")
    text = (
        F.when(kind == "click", F.concat(local, F.lit("Z")))
        .when(kind == "error", F.concat(local, F.lit("+02:00")))
        .when(kind == "view", local)
        .when(kind == "signup", F.concat(F.lit("on "), local))
    )
    return _plain(
        sample.events(spark, sf).select("event_id", instants.parse_instant(text).alias("at"))
    )


def format_iso(spark: SparkSession, sf: str) -> DataFrame:
    """Request form, and the offset form of an instant with and without a fraction."""
    at = F.when(F.col("parameter_name") == "click", F.date_trunc("second", "at")).otherwise(
        F.col("at")
    )
    return sample.events(spark, sf).select(
        "event_id",
        instants.iso_seconds(at).alias("request_form"),
        instants.iso_offset(at).alias("offset_form"),
    )


def format_duration(spark: SparkSession, sf: str) -> DataFrame:
    events = sample.table(spark, sf, "events")
    return events.select(
        "event_id", values.duration_text(F.floor(F.col("value") * 100)).alias("duration")
    )


def format_duration_fractions(spark: SparkSession, sf: str) -> DataFrame:
    """Durations in quarters of a second."""
    seconds = F.floor(F.col("value") * 100) / 4
    return sample.table(spark, sf, "events").select("event_id", values.duration_text(seconds).alias("duration"))


# --- silver --------------------------------------------------------------------------


def _staging(spark: SparkSession, sf: str) -> DataFrame:
    return silver.explode_batches(_bronze(spark, sf), RUN_TS)


def silver_explode(spark: SparkSession, sf: str) -> DataFrame:
    return _plain(_staging(spark, sf).drop("raw_json"))


def raw_json(spark: SparkSession, sf: str) -> DataFrame:
    return _staging(spark, sf).select("sensor_id", "raw_json")


def _snapshots(spark: SparkSession, sf: str) -> DataFrame:
    """A table with an older snapshot and the newest one."""
    older = sample.location_documents(spark, sf, FIRST_RUN_TS)
    newer = sample.location_documents(spark, sf)
    both = sample.location_snapshot(older, "snap-1", FIRST_RUN_TS).unionByName(
        sample.location_snapshot(newer, "snap-2", RUN_TS)
    )
    return materialise(both, "snapshots")


def latest_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """Chunk sizes follow a hash, so the snapshot is reported as a whole."""
    newest = dimensions.latest_snapshot(_snapshots(spark, sf))
    return newest.groupBy("batch_id", "ingestion_time").agg(
        F.sum("rows_fetched").alias("locations")
    )


def dim_locations_flatten(spark: SparkSession, sf: str) -> DataFrame:
    newest = dimensions.latest_snapshot(_snapshots(spark, sf))
    return _plain(dimensions.flatten_locations(newest, RUN_TS))


def dim_sensors_flatten(spark: SparkSession, sf: str) -> DataFrame:
    newest = dimensions.latest_snapshot(_snapshots(spark, sf))
    return _plain(dimensions.flatten_sensors(newest, RUN_TS))


# --- joins and incremental pickup ------------------------------------------------------


def _dims(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Locations and sensors straight from their tables."""
    customer = sample.table(spark, sf, "customer")
    names = customer.select(F.col("c_custkey").cast("int").alias("location_id"), "c_name")
    locations = sample.places(spark, sf).join(names, "location_id").withColumnRenamed(
        "c_name", "name"
    )
    sensors = (
        sample.events(spark, sf).select("sensor_id", "location_id", "parameter_id").distinct()
    )
    return locations, sensors


def sensors_in_country(spark: SparkSession, sf: str) -> DataFrame:
    locations, sensors = _dims(spark, sf)
    return planning.sensors_in_country(sensors, locations, COUNTRY)


def _daily_batches(spark: SparkSession, sf: str) -> DataFrame:
    """One bronze batch per day of events."""
    return sample.events(spark, sf).withColumn(
        "batch_id", F.concat(F.lit("day-"), F.date_format("at", "yyyy-MM-dd"))
    )


def unprocessed_batches(spark: SparkSession, sf: str) -> DataFrame:
    batches = _daily_batches(spark, sf)
    processed = batches.where(F.col("at") < F.lit(FIRST_RUN_TS))
    return silver.unprocessed_batches(batches, processed).select(
        "batch_id", "event_id", "sensor_id"
    )


def distinct_batches(spark: SparkSession, sf: str) -> DataFrame:
    return silver.distinct_batches(_daily_batches(spark, sf))


def batch_audit(spark: SparkSession, sf: str) -> DataFrame:
    batches = _daily_batches(spark, sf).groupBy("batch_id", "sensor_id").agg(
        F.count("*").cast("int").alias("rows_fetched")
    )
    return audit.batch_audit(batches)


def batch_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Payloads cut short for sign-ups and starts that are no instant for views: the
    rows they cost are counted."""
    kind = F.col("parameter_id")
    payload = F.when(kind == 4, F.expr("left(api_payload, length(api_payload) - 1)")).otherwise(
        F.when(kind == 5, F.replace("api_payload", F.lit('From":{"utc":"'), F.lit('From":{"utc":"on ')))
        .otherwise(F.col("api_payload"))
    )
    rows = _bronze(spark, sf).withColumn("api_payload", payload).withColumn(
        "batch_id", F.concat(F.lit("parameter-"), kind)
    )
    rows = materialise(rows, "bronze")
    return silver.payload_rejects(rows).join(
        silver.instant_rejects(silver.explode_batches(rows, RUN_TS)), "batch_id", "left"
    )


# --- planning ------------------------------------------------------------------------


def _windows_seen(spark: SparkSession, sf: str, code: str) -> DataFrame:
    """Bronze rows without payload, one per reading; ``code`` stands for the country."""
    return sample.readings(spark, sf).select(
        F.col(code).cast("string").alias("country_code"),
        instants.iso_offset(F.col("measurement_datetime_from_utc")).alias(
            "ingestion_window_datetime_from"
        ),
        instants.iso_offset(F.col("measurement_datetime_to_utc")).alias(
            "ingestion_window_datetime_to"
        ),
    )


def high_water_mark(spark: SparkSession, sf: str) -> DataFrame:
    return planning.high_water_mark(_windows_seen(spark, sf, "country_code"))


def ingest_window(spark: SparkSession, sf: str) -> DataFrame:
    """Every location plans for itself, so all cases occur: no history, up to date,
    a short and a long gap."""
    locations, _ = _dims(spark, sf)
    codes = locations.select(F.col("location_id").cast("string").alias("country_code"))
    seen = _windows_seen(spark, sf, "location_id")
    return _plain(planning.country_windows(codes, seen, PLAN_TS))


def fetch_plan(spark: SparkSession, sf: str) -> DataFrame:
    locations, sensors = _dims(spark, sf)
    seen = _windows_seen(spark, sf, "country_code")
    now = datetime(2024, 1, 31, 3, 0, tzinfo=timezone.utc)
    windows = planning.country_windows(locations, seen, now)
    return _plain(
        planning.fetch_plan(planning.sensors_in_country(sensors, locations), windows)
    )


# --- upserts ---------------------------------------------------------------------------


def upsert_locations(spark: SparkSession, sf: str) -> DataFrame:
    """Target: an older snapshot without the building customers."""
    older = sample.location_documents(spark, sf, FIRST_RUN_TS).where(
        F.col("document.locality") != "BUILDING"
    )
    newer = sample.location_documents(spark, sf).withColumn(
        "document", F.col("document").withField("name", F.upper("document.name"))
    )
    dim = dimensions.flatten_locations(
        sample.location_snapshot(older, "snap-1", FIRST_RUN_TS), FIRST_RUN_TS
    )
    incoming = dimensions.flatten_locations(
        sample.location_snapshot(newer, "snap-2", RUN_TS), RUN_TS
    )
    dim, incoming = materialise(dim, "dim"), materialise(incoming, "incoming")
    return _plain(upsert.upsert_locations(dim, incoming, RUN_TS))


def upsert_sensors(spark: SparkSession, sf: str) -> DataFrame:
    """Target: all sensors of the first half; source: those seen since the overlap."""
    events = sample.events(spark, sf)

    def sensors(seen: DataFrame, name: str, run_ts: datetime) -> DataFrame:
        return seen.select("sensor_id", "parameter_id", "parameter_name", "location_id").distinct(
        ).select(
            "sensor_id",
            F.lit(name).alias("name"),
            "parameter_id",
            "parameter_name",
            F.lit(sample.UNIT).alias("parameter_units"),
            F.initcap("parameter_name").alias("parameter_display_name"),
            "location_id",
            F.lit(run_ts.isoformat()).alias("bronze_ingestion_time"),
            F.lit(run_ts).alias("dim_ingested_at"),
        )

    dim = sensors(events.where(F.col("at") < F.lit(FIRST_RUN_TS)), "first", FIRST_RUN_TS)
    incoming = sensors(events.where(F.col("at") >= F.lit(OVERLAP_FROM)), "second", RUN_TS)
    dim, incoming = materialise(dim, "dim"), materialise(incoming, "incoming")
    return _plain(upsert.upsert_sensors(dim, incoming, RUN_TS))


def merge_fact(spark: SparkSession, sf: str) -> DataFrame:
    """Overlapping deliveries; signups have no parameter id, so their key never matches."""
    readings = sample.readings(spark, sf).withColumn(
        "parameter_id", F.when(F.col("parameter_name") != "signup", F.col("parameter_id"))
    )
    columns = [*schemas.FACT_KEY, "location_id", "country_code", "value", "batch_id"]
    fact = readings.where(F.col("at") < F.lit(FIRST_RUN_TS))
    fact = fact.withColumn("batch_id", F.lit("run-1")).select(columns)
    incoming = readings.where(F.col("at") >= F.lit(OVERLAP_FROM))
    incoming = incoming.withColumn("batch_id", F.lit("run-2")).select(columns)
    fact, incoming = materialise(fact, "fact"), materialise(incoming, "incoming")
    return _plain(fact.unionByName(upsert.new_readings(fact, incoming)))


def upsert_daily_stats(spark: SparkSession, sf: str) -> DataFrame:
    """The second delivery spells the parameter differently: existing names are kept."""
    readings = sample.readings(spark, sf)
    current = daily.daily_stats(readings.where(F.col("at") < F.lit(FIRST_RUN_TS)))
    renamed = readings.withColumn("parameter_name", F.upper("parameter_name"))
    stats = daily.daily_stats(renamed.where(F.col("at") >= F.lit(OVERLAP_FROM)))
    current, stats = materialise(current, "current"), materialise(stats, "stats")
    return _rounded(upsert.upsert_daily(current, stats))


# --- daily statistics and alert -----------------------------------------------------------


def daily_stats(spark: SparkSession, sf: str) -> DataFrame:
    recent = daily.trailing_days(sample.readings(spark, sf), "at", AS_OF)
    return _rounded(daily.daily_stats(recent))


def daily_percentiles(spark: SparkSession, sf: str) -> DataFrame:
    """Coarser groups than a sensor's day: one per parameter and day."""
    events = sample.events(spark, sf).withColumns(
        {"sensor_id": F.lit(0), "location_id": F.lit(0), "country_code": F.lit("all")}
    )
    return daily.daily_stats(events).select(
        "parameter_id", "day_start", "perc95_value", "perc05_value"
    )


def daily_completeness(spark: SparkSession, sf: str) -> DataFrame:
    return daily.daily_stats(sample.readings(spark, sf)).select(
        "sensor_id", "day_start", "reading_count", "completeness_ratio"
    )


def daily_with_location(spark: SparkSession, sf: str) -> DataFrame:
    """Machinery customers are unknown locations here."""
    customer = sample.table(spark, sf, "customer").where("c_mktsegment <> 'MACHINERY'")
    locations = customer.select(
        F.col("c_custkey").cast("int").alias("location_id"), F.col("c_name").alias("name")
    )
    stats = daily.daily_stats(sample.readings(spark, sf))
    return alerts.with_location(stats, locations).select(
        "sensor_id", "location_id", "location_name", "day_start", "reading_count"
    )


def alert_breaches(spark: SparkSession, sf: str) -> DataFrame:
    locations, _ = _dims(spark, sf)
    stats = daily.daily_stats(sample.readings(spark, sf))
    found = alerts.breaches(stats, locations, limits.limits(spark, ALERT_LIMITS), ALERT_DAY)
    return _rounded(found)


def alert_state(spark: SparkSession, sf: str) -> DataFrame:
    return alerts.alert_state(alert_breaches(spark, sf))


# --- whole runs over catalog tables ----------------------------------------------------------


def _dimension_tables(spark: SparkSession, sf: str) -> catalog.Tables:
    """Two weekly snapshots land in one folder and are ingested one after the other."""
    configure(spark)
    tables, path = _tables(spark), scratch_dir(spark, "weekly")
    runs = [("snap-1", FIRST_RUN_TS, FIRST_RUN_TS), ("snap-2", RUN_TS, None)]
    number = F.floor(F.col("location_id") / landing.PAGE_LIMIT).cast("int") + 1
    for batch_id, run_ts, until in runs:
        documents = sample.location_documents(spark, sf, until).withColumn("page", number)
        pages = bronze.pack_documents(documents, ["page"], ["location_id"], F.col("document"))
        sample.land(pages, path, batch_id)
        dimension_plan.run_dimensions(spark, tables, batch_id, run_ts, path)
    return tables


def dimensions_run(spark: SparkSession, sf: str) -> DataFrame:
    """The location dimension after two snapshots."""
    return _plain(spark.table(_dimension_tables(spark, sf).dim_locations))


def dimensions_run_sensors(spark: SparkSession, sf: str) -> DataFrame:
    """The sensor dimension after two snapshots."""
    return _plain(spark.table(_dimension_tables(spark, sf).dim_sensors))


def _ingested(spark: SparkSession, sf: str) -> catalog.Tables:
    """Two runs of all countries over pages of every sensor; some requests fail."""
    tables, path = _dimension_tables(spark, sf), scratch_dir(spark, "readings")
    failed = (F.col("parameter_id") == 2) & (F.col("location_id") % 3 == 0)
    documents = sample.events(spark, sf).withColumns(
        {"page": F.lit(1), "status": F.when(failed, 500).otherwise(200)}
    )
    pages = bronze.pack_documents(
        documents, ["sensor_id", "page", "status"], ["event_id"], sample.measurement_document()
    )
    pages = materialise(pages, "packed-pages")  # both runs get the same ones
    for batch_id, run_ts in (("m-1", FIRST_RUN_TS), ("m-2", SECOND_RUN_TS)):
        sample.land(pages, path, batch_id)
        fact_plan.run_facts(spark, tables, batch_id, run_ts, path, None, AS_OF)
    return tables


def ingest_run(spark: SparkSession, sf: str) -> DataFrame:
    """Landed pages to bronze: plan, page prefix and window, in two runs."""
    rows = spark.table(_ingested(spark, sf).bronze_measurements)
    items = rows.withColumn("item", F.explode(F.from_json("api_payload", schemas.MEASUREMENT_ITEMS)))
    return items.select(
        "batch_id",
        "sensor_id",
        "country_code",
        "ingestion_window_datetime_from",
        F.col("item.value").alias("value"),
        F.col("item.period.datetimeFrom.utc").alias("from_utc"),
    )


def stream_pages_run(spark: SparkSession, sf: str) -> DataFrame:
    """Pages of two readings, dealt over five micro-batches whatever their feed, to bronze."""
    configure(spark)
    tables, path = _tables(spark), scratch_dir(spark, "landing")
    number = F.floor(F.col("location_id") / landing.PAGE_LIMIT).cast("int") + 1
    places = sample.location_documents(spark, sf).withColumn("page", number)
    sample.land(bronze.pack_documents(places, ["page"], ["location_id"], F.col("document")), path, "d")
    dimension_plan.run_dimensions(spark, tables, "d", BUSY_RUN_TS, path)
    within = Window.partitionBy("sensor_id").orderBy("event_id")
    page = F.floor((F.row_number().over(within) - 1) / 2).cast("int") + 1
    failed = (F.col("sensor_id") + F.col("page")) % 5 == 0
    documents = sample.events(spark, sf).withColumn("page", page).withColumn("status", F.when(failed, 500).otherwise(200))
    pages = bronze.pack_documents(
        documents, ["sensor_id", "page", "status"], ["event_id"], sample.measurement_document()
    )
    sample.land(pages.repartition(5), path, "m")
    checkpoint = scratch_dir(spark, "stream-pages")
    stream_pages(spark, tables, "m", BUSY_RUN_TS, path, checkpoint, None, 1, page_limit=2, complete=True)
    items = F.explode(F.from_json("api_payload", schemas.MEASUREMENT_ITEMS))
    return spark.table(tables.bronze_measurements).withColumn("item", items).select(
        "sensor_id",
        "country_code",
        F.col("item.value").alias("value"),
        F.col("item.period.datetimeFrom.utc").alias("from_utc"),
    )


def run_log(spark: SparkSession, sf: str) -> DataFrame:
    """What two runs logged for every country, windows without data among them."""
    log = spark.table(_ingested(spark, sf).run_log).where("kind = 'ingest'")
    return log.select(
        "run_id", "country_code", "ingestion_window_datetime_to", "bronze_rows", "documents"
    )


def window_marks(spark: SparkSession, sf: str) -> DataFrame:
    """The last window of every country by the marks that two runs kept."""
    return planning.high_water_mark(fact_plan.windows_seen(spark, _ingested(spark, sf)))


def load_log(spark: SparkSession, sf: str) -> DataFrame:
    """What the loads of two runs logged: readings staged, inserted and rejected."""
    log = spark.table(_ingested(spark, sf).run_log).where("kind = 'load'")
    return log.select("staged", "inserted", "rejected_payloads", "rejected_instants")


def pages_to_daily(spark: SparkSession, sf: str) -> DataFrame:
    """Landed pages to daily statistics, in two runs."""
    return _rounded(spark.table(_ingested(spark, sf).daily))


def backlog_run(spark: SparkSession, sf: str) -> DataFrame:
    """A batch for each day, each with the day after as well, all pending at once."""
    configure(spark)
    tables = _tables(spark)
    catalog.ensure_all(spark, tables)
    day = F.dayofmonth("at")
    documents = sample.readings(spark, sf).withColumn(
        "batch_day", F.explode(F.array(day, F.greatest(day - 1, F.lit(1))))
    )
    keys = ["batch_day", "sensor_id", "parameter_id", "location_id", "country_code"]
    packed = bronze.pack_documents(documents, keys, ["event_id"], sample.measurement_document())
    window = [F.lit(text) for text in WINDOW]
    batch_id = F.concat(F.lit("day-"), "batch_day")
    rows = bronze.stamp_measurements(packed, batch_id, RUN_TS, *window)
    catalog.append(rows, tables.bronze_measurements)
    fact_plan.transform_measurements(spark, tables, RUN_TS)
    return _plain(spark.table(tables.fact)).select(
        "batch_id", "sensor_id", "measurement_datetime_from_utc", "value"
    )


def alert_run(spark: SparkSession, sf: str) -> DataFrame:
    """The alert over catalog tables after one snapshot and one batch."""
    configure(spark)
    tables, path = _tables(spark), scratch_dir(spark, "places")
    number = F.floor(F.col("location_id") / landing.PAGE_LIMIT).cast("int") + 1
    documents = sample.location_documents(spark, sf).withColumn("page", number)
    pages = bronze.pack_documents(documents, ["page"], ["location_id"], F.col("document"))
    sample.land(pages, path, "d")
    dimension_plan.run_dimensions(spark, tables, "d", RUN_TS, path)
    catalog.append(_bronze(spark, sf), tables.bronze_measurements)
    fact_plan.run_facts(spark, tables, "run-1", RUN_TS, as_of=AS_OF)
    return _rounded(run_alert(spark, tables, ALERT_DAY, ALERT_LIMITS)[0])


def _bronze_tables(spark: SparkSession, sf: str) -> catalog.Tables:
    """Two overlapping batches in a bronze table."""
    configure(spark)
    tables = _tables(spark)
    catalog.ensure_all(spark, tables)
    readings = sample.readings(spark, sf)
    first = readings.where(F.col("at") < F.lit(FIRST_RUN_TS))
    second = readings.where(F.col("at") >= F.lit(OVERLAP_FROM))
    rows = sample.bronze_measurements(first, "run-1", FIRST_RUN_TS, WINDOW)
    catalog.append(rows, tables.bronze_measurements)
    fact_plan.run_facts(spark, tables, "run-1", FIRST_RUN_TS, as_of=AS_OF)
    rows = sample.bronze_measurements(second, "run-2", RUN_TS, WINDOW)
    catalog.append(rows, tables.bronze_measurements)
    return tables


def facts_run(spark: SparkSession, sf: str) -> DataFrame:
    """Bronze to daily statistics in two runs with overlapping batches."""
    tables = _bronze_tables(spark, sf)
    fact_plan.run_facts(spark, tables, "run-2", RUN_TS, as_of=AS_OF)
    return _rounded(spark.table(tables.daily))


def stream_facts_run(spark: SparkSession, sf: str) -> DataFrame:
    """The second run as an available-now stream; it meets both batches again."""
    tables = _bronze_tables(spark, sf)
    stream_facts(spark, tables, scratch_dir(spark, "stream-facts"), RUN_TS, AS_OF)
    return _rounded(spark.table(tables.daily))


# --- SQL twins ----------------------------------------------------------------------------------

_PARAMETER_SQL = (
    "CASE event_type WHEN 'click' THEN 1 WHEN 'error' THEN 2 WHEN 'purchase' THEN 3 "
    "WHEN 'signup' THEN 4 WHEN 'view' THEN 5 END"
)

_READINGS = f"""
readings AS (
  SELECT event_id, ts, CAST(user_id * 10 + {_PARAMETER_SQL} AS INTEGER) AS sensor_id,
         CAST(user_id AS INTEGER) AS location_id,
         replace(n_name, 'ATION_', '') AS country_code,
         CAST({_PARAMETER_SQL} AS INTEGER) AS parameter_id,
         event_type AS parameter_name, value, 'µg/m³' AS unit,
         date_trunc('hour', ts) AS from_utc,
         date_trunc('hour', ts) + INTERVAL 1 HOUR AS to_utc
  FROM events
  LEFT JOIN customer ON c_custkey = user_id
  LEFT JOIN nation ON n_nationkey = c_nationkey
)"""


def _initcap(column: str) -> str:
    return f"upper({column}[1]) || {column}[2:]"


_DOCUMENT = f"""
'{{"value":' || CAST(value AS VARCHAR) || ',"unit":"µg/m³","parameter":{{"id":' || parameter_id
|| ',"name":"' || parameter_name || '","units":"µg/m³","displayName":"'
|| {_initcap("parameter_name")} || '"}},"period":{{"label":"1hour","interval":"01:00:00",'
|| '"datetimeFrom":{{"utc":"' || strftime(from_utc, '%Y-%m-%dT%H:%M:%SZ')
|| '"}},"datetimeTo":{{"utc":"' || strftime(to_utc, '%Y-%m-%dT%H:%M:%SZ') || '"}}}}}}'
"""


def _stats_sql(source: str) -> str:
    return f"""
SELECT sensor_id, location_id, country_code, parameter_id, parameter_name,
       CAST(ts AS DATE) AS day_start,
       round(avg(value), 6) AS avg_value, min(value) AS min_value, max(value) AS max_value,
       round(stddev_pop(value), 6) AS stddev_value,
       quantile_disc(value, 0.95) AS perc95_value, quantile_disc(value, 0.05) AS perc05_value,
       CAST(count(*) AS INTEGER) AS reading_count,
       round(count(*) / 24.0, 6) AS completeness_ratio
FROM {source}
GROUP BY sensor_id, location_id, country_code, parameter_id, parameter_name, CAST(ts AS DATE)"""


_MEASURES = [
    "avg_value", "min_value", "max_value", "stddev_value", "perc95_value", "perc05_value",
    "reading_count", "completeness_ratio",
]

_SNAPSHOT = """
seen AS (
  SELECT user_id, max(ts) AS last FROM events {where} GROUP BY user_id
),
{name} AS (
  SELECT CAST(c_custkey AS INTEGER) AS location_id, c_name AS name, c_mktsegment AS locality,
         n_name AS country_name, replace(n_name, 'ATION_', '') AS country_code,
         CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_acctbal END AS coordinates_latitude,
         CASE WHEN c_mktsegment <> 'MACHINERY' THEN CAST(c_nationkey AS DOUBLE) END
           AS coordinates_longitude,
         strftime(last, '%Y-%m-%dT%H:%M:%SZ') AS last_updated_utc
  FROM customer
  LEFT JOIN nation ON n_nationkey = c_nationkey
  LEFT JOIN {seen} ON user_id = c_custkey
)"""


def _locations_sql(name: str, until: str | None = None) -> str:
    where = f"WHERE ts < TIMESTAMP '{until}'" if until else ""
    seen = f"seen_{name}"
    return _SNAPSHOT.format(where=where, name=name, seen=seen).replace("seen AS (", f"{seen} AS (", 1)


_RUN_ISO = "2024-02-01T06:30:00.250000+00:00"
_FIRST_ISO = "2024-01-16T00:00:00+00:00"
_RUN_SQL = "TIMESTAMP '2024-02-01 06:30:00.25'"
_FIRST_SQL = "TIMESTAMP '2024-01-16 00:00:00'"
_OVERLAP_SQL = "TIMESTAMP '2024-01-10 00:00:00'"

_STAMPED = f"""'{_RUN_ISO}' AS ingestion_datetime,
       '{WINDOW[0]}' AS ingestion_window_datetime_from,
       '{WINDOW[1]}' AS ingestion_window_datetime_to"""


def _upserted_locations_sql(target: str, source: str) -> str:
    """Full outer join with the update rule of the location dimension."""
    columns = [
        "name", "locality", "country_name", "country_code", "coordinates_latitude",
        "coordinates_longitude", "last_updated_utc",
    ]
    fresh = (
        "(t.location_id IS NULL OR coalesce(t.last_updated_utc <> s.last_updated_utc, FALSE))"
    )
    picked = ", ".join(
        f"CASE WHEN {fresh} THEN s.{c} ELSE t.{c} END AS {c}" for c in columns
    )
    return f"""
SELECT coalesce(t.location_id, s.location_id) AS location_id, {picked},
       CASE WHEN {fresh} THEN '{_RUN_ISO}' ELSE '{_FIRST_ISO}' END AS bronze_ingestion_time,
       CASE WHEN {fresh} THEN {_RUN_SQL} ELSE {_FIRST_SQL} END AS dim_ingested_at
FROM {target} t FULL JOIN {source} s ON t.location_id = s.location_id"""


_WINDOWS_SEEN = f"""
seen AS (
  SELECT country_code, location_id,
         strftime(from_utc, '%Y-%m-%dT%H:%M:%S+00:00') AS w_from,
         strftime(to_utc, '%Y-%m-%dT%H:%M:%S+00:00') AS w_to, to_utc
  FROM readings
)"""

_BREACHES = f"""
stats AS ({_stats_sql("readings")}),
exact AS (
  SELECT sensor_id, parameter_id, CAST(ts AS DATE) AS day_start, avg(value) AS mean
  FROM readings GROUP BY ALL
),
limits AS (SELECT * FROM (VALUES (1, 60), (5, 45), (2, 120)) AS t(parameter_id, max_limit)),
breaches AS (
  SELECT s.country_code, s.location_id, c_name AS location_name, s.parameter_id,
         s.parameter_name, s.day_start, s.avg_value, l.max_limit
  FROM stats s
  JOIN exact USING (sensor_id, parameter_id, day_start)
  LEFT JOIN customer ON c_custkey = s.location_id
  LEFT JOIN limits l ON l.parameter_id = s.parameter_id
  WHERE s.day_start = DATE '2024-01-15' AND max_limit IS NOT NULL AND mean > max_limit
  GROUP BY ALL
)"""

# Readings kept by two overlapping deliveries, the first write of a key winning.
_MERGED = f"""
first_run AS (SELECT * FROM readings WHERE ts < {_FIRST_SQL}),
merged AS (
  SELECT * FROM first_run
  UNION ALL
  SELECT * FROM readings r
  WHERE ts >= {_OVERLAP_SQL} AND NOT EXISTS (
    SELECT 1 FROM first_run f
    WHERE f.sensor_id = r.sensor_id AND f.parameter_id = r.parameter_id
      AND f.from_utc = r.from_utc AND f.to_utc = r.to_utc)
)"""

_RUN_DAILY = f"""
WITH {_READINGS}, {_MERGED},
recent AS (SELECT * FROM merged WHERE from_utc >= DATE '2024-02-10' - 30)
{_stats_sql("recent")}"""


_INGESTED = f"""
{_READINGS}, windows AS (
  SELECT 'm-1' AS batch_id, TIMESTAMP '2024-01-15 18:00:00' AS low,
         TIMESTAMP '2024-01-15 22:00:00' AS high, '2024-01-15T18:00:00+00:00' AS window_from,
         '2024-01-15T22:00:00+00:00' AS window_to
  UNION ALL
  SELECT 'm-2', TIMESTAMP '2024-01-15 22:00:00', TIMESTAMP '2024-01-16 06:00:00',
         '2024-01-15T22:00:00+00:00', '2024-01-16T06:00:00+00:00'
), came AS (
  SELECT * FROM readings JOIN windows ON from_utc >= low AND from_utc < high
  WHERE country_code IS NOT NULL AND NOT (parameter_id = 2 AND location_id % 3 = 0)
)"""


def _sql() -> dict[str, str]:
    return {
        "scan_table": "SELECT * FROM events",
        "src_location_pages": f"""
WITH {_locations_sql("locs")},
kinds AS (SELECT user_id, count(DISTINCT event_type) AS n FROM events GROUP BY user_id)
SELECT CAST(c_nationkey + 1 AS INTEGER) AS page, location_id, name, country_code,
       CAST(n AS INTEGER) AS sensors
FROM locs JOIN customer ON c_custkey = location_id LEFT JOIN kinds ON user_id = location_id""",
        "src_measurement_pages": f"""
WITH {_READINGS}
SELECT sensor_id, CAST(day(ts) AS INTEGER) AS page, parameter_name, value,
       strftime(from_utc, '%Y-%m-%dT%H:%M:%SZ') AS from_utc
FROM readings WHERE from_utc >= {_OVERLAP_SQL} AND from_utc < {_FIRST_SQL}""",
        "page_prefix": """
WITH pages AS (
  SELECT user_id, CAST(day(ts) AS INTEGER) AS page, count(*) AS documents,
         max(value) > 300 AS failed
  FROM events GROUP BY ALL
), marked AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY page) AS position,
         coalesce(sum(CASE WHEN failed OR documents < 2 THEN 1 ELSE 0 END) OVER (
           PARTITION BY user_id ORDER BY page
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS stops
  FROM pages
)
SELECT user_id, page, documents FROM marked
WHERE position = page AND stops = 0 AND NOT failed""",
        "page_prefix_requests": """
WITH pages AS (
  SELECT CASE WHEN event_type < 'd' THEN 'a' ELSE 'b' END AS request, user_id,
         CAST(day(ts) % 4 + 1 AS INTEGER) AS page, count(*) AS documents,
         max(value) > 300 AS failed
  FROM events GROUP BY ALL
), marks AS (
  SELECT *, lag(page) OVER feed AS before FROM pages
  WINDOW feed AS (PARTITION BY request, user_id ORDER BY page)
), ends AS (
  SELECT request, user_id,
         min(CASE WHEN failed OR page <> coalesce(before, 0) + 1 THEN page END) AS stop_before,
         min(CASE WHEN documents < 2 THEN page END) AS stop_after
  FROM marks GROUP BY ALL
)
SELECT request, user_id, page, documents FROM marks JOIN ends USING (request, user_id)
WHERE page < coalesce(stop_before, 99) AND page <= coalesce(stop_after, 99)""",
        "bronze_pack_chunks": f"""
WITH {_READINGS}
SELECT location_id, true AS fits, {_DOCUMENT} AS document FROM readings""",
        "bronze_pack_order": f"""
WITH {_READINGS}, docs AS (
  SELECT parameter_id, event_id, {_DOCUMENT} AS doc,
         (row_number() OVER (PARTITION BY parameter_id ORDER BY event_id) - 1) // 7 AS cut
  FROM readings)
SELECT parameter_id, CAST(count(*) AS INTEGER) AS rows_fetched,
       '[' || string_agg(doc, ',' ORDER BY event_id) || ']' AS api_payload
FROM docs GROUP BY parameter_id, cut""",
        "values_limits": f"""
WITH {_READINGS},
limits AS (SELECT * FROM (VALUES (2, 20), (1, 45), (3, 120), (5, 50), (6, 50), (4, 4000))
           AS t(parameter_id, max_limit))
SELECT parameter_id, max_limit, count(*) AS readings,
       count(*) FILTER (WHERE value > max_limit) AS above_limit
FROM readings JOIN limits USING (parameter_id) GROUP BY parameter_id, max_limit""",
        "bronze_pack": f"""
WITH {_READINGS}, docs AS (
  SELECT *, {_DOCUMENT} AS doc, (row_number() OVER (
    PARTITION BY sensor_id, parameter_id, location_id, country_code ORDER BY event_id) - 1) // 1000 AS cut
  FROM readings)
SELECT sensor_id, parameter_id, location_id, country_code,
       CAST(count(*) AS INTEGER) AS rows_fetched,
       '[' || string_agg(doc, ',' ORDER BY event_id) || ']' AS api_payload
FROM docs GROUP BY sensor_id, parameter_id, location_id, country_code, cut""",
        "batch_stamp": f"""
WITH {_READINGS}
SELECT 'run-1' AS batch_id, sensor_id, CAST(parameter_id AS VARCHAR) AS parameter_id,
       location_id, country_code, {_STAMPED}, CAST(count(*) AS INTEGER) AS rows_fetched
FROM readings GROUP BY sensor_id, parameter_id, location_id, country_code""",
        "append_roundtrip": f"""
WITH {_READINGS}
SELECT event_id, sensor_id, value, ts AS at FROM readings
UNION ALL
SELECT event_id, sensor_id, value, ts AS at FROM readings WHERE ts < {_FIRST_SQL}""",
        "project_columns": "SELECT event_id, user_id, event_type FROM events",
        "filter_country": f"""
WITH {_READINGS}
SELECT event_id, sensor_id, location_id, country_code FROM readings
WHERE country_code = '{COUNTRY}'""",
        "filter_trailing_days": """
SELECT event_id, user_id, ts FROM events WHERE ts >= DATE '2024-02-10' - 30""",
        "normalise_country": """
SELECT c_custkey, upper(coalesce(nullif(
         CASE c_mktsegment WHEN 'BUILDING' THEN '' WHEN 'MACHINERY' THEN NULL
              ELSE lower(replace(n_name, 'ATION_', '')) END, ''), 'PT')) AS country_code
FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey""",
        "coalesce_parameter": f"""
WITH {_READINGS}
SELECT event_id, coalesce(
         CASE WHEN parameter_name IN ('click', 'error') THEN parameter_id END,
         TRY_CAST(CASE WHEN parameter_name = 'view' THEN parameter_name
                       ELSE CAST(parameter_id AS VARCHAR) END AS INTEGER)) AS parameter_id
FROM readings""",
        "parse_iso_ts": """
SELECT event_id, CASE event_type
         WHEN 'click' THEN date_trunc('second', ts)
         WHEN 'error' THEN date_trunc('second', ts) - INTERVAL 2 HOUR
         WHEN 'view' THEN date_trunc('second', ts) END AS at
FROM events""",
        "format_iso": """
SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS request_form,
       CASE WHEN event_type = 'click' OR microsecond(ts) % 1000000 = 0
            THEN strftime(ts, '%Y-%m-%dT%H:%M:%S+00:00')
            ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f+00:00') END AS offset_form
FROM events""",
        "format_duration": """
WITH s AS (SELECT event_id, CAST(floor(value * 100) AS BIGINT) AS secs FROM events)
SELECT event_id, printf('%02d:%02d:%05.2f', secs // 3600, (secs // 60) % 60,
                        CAST(secs % 60 AS DOUBLE)) AS duration
FROM s""",
        "format_duration_fractions": """
WITH s AS (SELECT event_id, floor(value * 100) / 4 AS secs FROM events)
SELECT event_id, printf('%02d:%02d:%05.2f', CAST(floor(secs / 3600) AS BIGINT),
                        CAST(floor(secs / 60) AS BIGINT) % 60, secs - 60 * floor(secs / 60)) AS duration
FROM s""",
        "silver_explode": f"""
WITH {_READINGS}
SELECT 'run-1' AS batch_id, sensor_id, location_id, country_code, parameter_id,
       parameter_name, value, unit, from_utc AS measurement_datetime_from_utc,
       to_utc AS measurement_datetime_to_utc, {_RUN_SQL} AS ingestion_datetime,
       TIMESTAMP '2024-01-01' AS ingestion_window_datetime_from,
       TIMESTAMP '2024-01-31' AS ingestion_window_datetime_to, {_RUN_SQL} AS exploded_at
FROM readings""",
        "raw_json": f"WITH {_READINGS} SELECT sensor_id, {_DOCUMENT} AS raw_json FROM readings",
        "latest_snapshot": f"""
SELECT 'snap-2' AS batch_id, '{_RUN_ISO}' AS ingestion_time, count(*) AS locations
FROM customer""",
        "dim_locations_flatten": f"""
WITH {_locations_sql("locs")}
SELECT *, '{_RUN_ISO}' AS bronze_ingestion_time, {_RUN_SQL} AS dim_ingested_at FROM locs""",
        "dim_sensors_flatten": f"""
WITH {_READINGS}
SELECT DISTINCT sensor_id, parameter_name || ' µg/m³' AS name, parameter_id, parameter_name,
       unit AS parameter_units, {_initcap("parameter_name")} AS parameter_display_name,
       location_id, '{_RUN_ISO}' AS bronze_ingestion_time, {_RUN_SQL} AS dim_ingested_at
FROM readings WHERE location_id IN (SELECT c_custkey FROM customer)""",
        "sensors_in_country": f"""
WITH {_READINGS}
SELECT DISTINCT sensor_id, location_id, parameter_id, country_code FROM readings
WHERE country_code = '{COUNTRY}'""",
        "unprocessed_batches": f"""
WITH {_READINGS}, b AS (
  SELECT *, 'day-' || strftime(ts, '%Y-%m-%d') AS batch_id FROM readings)
SELECT batch_id, event_id, sensor_id FROM b
WHERE NOT EXISTS (SELECT 1 FROM b p WHERE p.ts < {_FIRST_SQL} AND p.batch_id = b.batch_id)""",
        "distinct_batches": """
SELECT DISTINCT 'day-' || strftime(ts, '%Y-%m-%d') AS batch_id FROM events""",
        "batch_audit": f"""
WITH {_READINGS}
SELECT 'day-' || strftime(ts, '%Y-%m-%d') AS batch_id,
       count(DISTINCT sensor_id) AS bronze_rows, count(*) AS documents
FROM readings GROUP BY 1""",
        "batch_rejects": f"""
WITH {_READINGS}
SELECT 'parameter-' || parameter_id AS batch_id,
       count(DISTINCT CASE WHEN parameter_id = 4 THEN sensor_id END) AS rejected_payloads,
       CASE WHEN parameter_id <> 4 THEN count(*) FILTER (WHERE parameter_id = 5) END
         AS rejected_instants
FROM readings GROUP BY parameter_id""",
        "high_water_mark": f"""
WITH {_READINGS}, {_WINDOWS_SEEN}
SELECT country_code, arg_max(w_from, w_to) AS last_from, max(w_to) AS last_to
FROM seen GROUP BY country_code""",
        "ingest_window": f"""
WITH {_READINGS}, {_WINDOWS_SEEN},
marks AS (SELECT location_id, max(to_utc) AS last_to FROM seen GROUP BY location_id),
caps AS (
  SELECT CAST(c_custkey AS VARCHAR) AS country_code, last_to,
         TIMESTAMP '2024-01-30 22:00:00' AS cap
  FROM customer LEFT JOIN marks ON location_id = c_custkey
)
SELECT country_code,
       coalesce(last_to, cap - INTERVAL 4 HOUR) AS window_from,
       CASE WHEN last_to IS NULL THEN cap ELSE least(last_to + INTERVAL 8 HOUR, cap) END
         AS window_to
FROM caps WHERE last_to IS NULL OR last_to < cap""",
        "fetch_plan": f"""
WITH {_READINGS}, {_WINDOWS_SEEN},
marks AS (SELECT country_code, max(to_utc) AS last_to FROM seen GROUP BY country_code),
caps AS (
  SELECT DISTINCT replace(n_name, 'ATION_', '') AS country_code,
         TIMESTAMP '2024-01-31 01:00:00' AS cap
  FROM customer JOIN nation ON n_nationkey = c_nationkey
),
windows AS (
  SELECT country_code, coalesce(last_to, cap - INTERVAL 4 HOUR) AS window_from,
         CASE WHEN last_to IS NULL THEN cap ELSE least(last_to + INTERVAL 8 HOUR, cap) END
           AS window_to
  FROM caps LEFT JOIN marks USING (country_code) WHERE last_to IS NULL OR last_to < cap
)
SELECT DISTINCT sensor_id, location_id, parameter_id, country_code, window_from, window_to
FROM readings JOIN windows USING (country_code)""",
        "upsert_locations": f"""
WITH {_locations_sql("older", "2024-01-16")}, {_locations_sql("newer")},
t AS (SELECT * FROM older WHERE locality <> 'BUILDING'),
s AS (SELECT * REPLACE (upper(name) AS name) FROM newer)
{_upserted_locations_sql("t", "s")}""",
        "upsert_sensors": f"""
WITH {_READINGS},
t AS (SELECT DISTINCT sensor_id, parameter_id, parameter_name, location_id FROM readings
      WHERE ts < {_FIRST_SQL}),
s AS (SELECT DISTINCT sensor_id, parameter_id, parameter_name, location_id FROM readings
      WHERE ts >= {_OVERLAP_SQL})
SELECT coalesce(s.sensor_id, t.sensor_id) AS sensor_id,
       CASE WHEN s.sensor_id IS NULL THEN 'first' ELSE 'second' END AS name,
       coalesce(s.parameter_id, t.parameter_id) AS parameter_id,
       coalesce(s.parameter_name, t.parameter_name) AS parameter_name,
       'µg/m³' AS parameter_units,
       {_initcap("coalesce(s.parameter_name, t.parameter_name)")} AS parameter_display_name,
       coalesce(s.location_id, t.location_id) AS location_id,
       CASE WHEN s.sensor_id IS NULL THEN '{_FIRST_ISO}' ELSE '{_RUN_ISO}' END
         AS bronze_ingestion_time,
       CASE WHEN s.sensor_id IS NULL THEN {_FIRST_SQL} ELSE {_RUN_SQL} END AS dim_ingested_at
FROM t FULL JOIN s ON t.sensor_id = s.sensor_id""",
        "merge_fact": f"""
WITH {_READINGS},
r AS (SELECT sensor_id, CASE WHEN parameter_name <> 'signup' THEN parameter_id END
             AS parameter_id, from_utc AS measurement_datetime_from_utc,
             to_utc AS measurement_datetime_to_utc, location_id, country_code, value, ts
      FROM readings),
t AS (SELECT * EXCLUDE (ts), 'run-1' AS batch_id FROM r WHERE ts < {_FIRST_SQL}),
s AS (SELECT * EXCLUDE (ts), 'run-2' AS batch_id FROM r WHERE ts >= {_OVERLAP_SQL})
SELECT * FROM t
UNION ALL
SELECT * FROM s WHERE NOT EXISTS (
  SELECT 1 FROM t WHERE t.sensor_id = s.sensor_id AND t.parameter_id = s.parameter_id
    AND t.measurement_datetime_from_utc = s.measurement_datetime_from_utc
    AND t.measurement_datetime_to_utc = s.measurement_datetime_to_utc)""",
        "upsert_daily_stats": f"""
WITH {_READINGS},
first_half AS (SELECT * FROM readings WHERE ts < {_FIRST_SQL}),
later AS (SELECT * REPLACE (upper(parameter_name) AS parameter_name) FROM readings
          WHERE ts >= {_OVERLAP_SQL}),
t AS ({_stats_sql("first_half")}),
s AS ({_stats_sql("later")})
SELECT coalesce(t.sensor_id, s.sensor_id) AS sensor_id,
       coalesce(t.location_id, s.location_id) AS location_id,
       coalesce(t.country_code, s.country_code) AS country_code,
       coalesce(t.parameter_id, s.parameter_id) AS parameter_id,
       coalesce(t.parameter_name, s.parameter_name) AS parameter_name,
       coalesce(t.day_start, s.day_start) AS day_start,
       {", ".join(f"coalesce(s.{m}, t.{m}) AS {m}" for m in _MEASURES)}
FROM t FULL JOIN s ON t.sensor_id = s.sensor_id AND t.parameter_id = s.parameter_id
  AND t.day_start = s.day_start""",
        "daily_stats": f"""
WITH {_READINGS},
recent AS (SELECT * FROM readings WHERE from_utc >= DATE '2024-02-10' - 30)
{_stats_sql("recent")}""",
        "daily_percentiles": f"""
WITH {_READINGS}
SELECT parameter_id, CAST(ts AS DATE) AS day_start,
       quantile_disc(value, 0.95) AS perc95_value, quantile_disc(value, 0.05) AS perc05_value
FROM readings GROUP BY parameter_id, CAST(ts AS DATE)""",
        "daily_completeness": f"""
WITH {_READINGS}
SELECT sensor_id, CAST(ts AS DATE) AS day_start, CAST(count(*) AS INTEGER) AS reading_count,
       round(count(*) / 24.0, 6) AS completeness_ratio
FROM readings GROUP BY sensor_id, CAST(ts AS DATE)""",
        "daily_with_location": f"""
WITH {_READINGS}
SELECT sensor_id, location_id, c_name AS location_name, CAST(ts AS DATE) AS day_start,
       CAST(count(*) AS INTEGER) AS reading_count
FROM readings
LEFT JOIN (SELECT * FROM customer WHERE c_mktsegment <> 'MACHINERY') c
  ON c.c_custkey = location_id
GROUP BY sensor_id, location_id, c_name, CAST(ts AS DATE)""",
        "alert_breaches": f"WITH {_READINGS}, {_BREACHES} SELECT * FROM breaches",
        "alert_state": f"""
WITH {_READINGS}, {_BREACHES}
SELECT count(country_code) AS breach_count,
       CASE WHEN count(country_code) > 1.0 THEN 'TRIGGERED' ELSE 'OK' END AS state
FROM breaches""",
        "dimensions_run": f"""
WITH {_locations_sql("older", "2024-01-16")}, {_locations_sql("newer")}
{_upserted_locations_sql("older", "newer")}""",
        "dimensions_run_sensors": f"""
WITH {_READINGS}
SELECT DISTINCT sensor_id, parameter_name || ' µg/m³' AS name, parameter_id, parameter_name,
       unit AS parameter_units, {_initcap("parameter_name")} AS parameter_display_name,
       location_id, '{_RUN_ISO}' AS bronze_ingestion_time, {_RUN_SQL} AS dim_ingested_at
FROM readings WHERE location_id IN (SELECT c_custkey FROM customer)""",
        "ingest_run": f"""
WITH {_INGESTED}
SELECT batch_id, sensor_id, country_code, window_from AS ingestion_window_datetime_from, value,
       strftime(from_utc, '%Y-%m-%dT%H:%M:%SZ') AS from_utc FROM came""",
        "stream_pages_run": f"""
WITH {_READINGS}, paged AS (
  SELECT *, (row_number() OVER (PARTITION BY sensor_id ORDER BY event_id) - 1) // 2 + 1 AS page
  FROM readings
), ends AS (
  SELECT sensor_id, min(page) AS stop FROM paged WHERE (sensor_id + page) % 5 = 0 GROUP BY ALL
)
SELECT sensor_id, country_code, value, strftime(from_utc, '%Y-%m-%dT%H:%M:%SZ') AS from_utc
FROM paged LEFT JOIN ends USING (sensor_id)
WHERE country_code IS NOT NULL AND (stop IS NULL OR page < stop)
  AND from_utc >= TIMESTAMP '2024-01-06 12:00:00' AND from_utc < TIMESTAMP '2024-01-06 16:00:00'""",
        "run_log": f"""
WITH {_INGESTED}
SELECT batch_id AS run_id, c.country_code, window_to AS ingestion_window_datetime_to,
       count(DISTINCT sensor_id) AS bronze_rows, count(sensor_id) AS documents
FROM (SELECT DISTINCT country_code FROM readings WHERE country_code IS NOT NULL) c
CROSS JOIN windows LEFT JOIN came USING (batch_id, country_code, window_to) GROUP BY ALL""",
        "window_marks": f"""
WITH {_INGESTED}
SELECT country_code, arg_max(window_from, window_to) AS last_from, max(window_to) AS last_to
FROM (SELECT DISTINCT country_code FROM readings WHERE country_code IS NOT NULL) c
CROSS JOIN windows GROUP BY country_code""",
        "load_log": f"""
WITH {_INGESTED}
SELECT count(*) AS staged, count(*) AS inserted, 0 AS rejected_payloads, 0 AS rejected_instants
FROM came GROUP BY batch_id""",
        "pages_to_daily": f"""
WITH {_INGESTED}
{_stats_sql("came")}""",
        "backlog_run": f"""
WITH {_READINGS}, twice AS (
  SELECT *, day(ts) AS d FROM readings
  UNION ALL SELECT *, greatest(day(ts) - 1, 1) AS d FROM readings)
SELECT 'day-' || d AS batch_id, sensor_id, from_utc AS measurement_datetime_from_utc, value
FROM twice""",
        "alert_run": f"""
WITH {_READINGS}, {_BREACHES}
SELECT * FROM breaches""",
        "facts_run": _RUN_DAILY,
        "stream_facts_run": _RUN_DAILY,
    }


_QUERIES: list[Callable[[SparkSession, str], DataFrame]] = [
    scan_table,
    src_location_pages,
    src_measurement_pages,
    page_prefix,
    page_prefix_requests,
    values_limits,
    bronze_pack,
    bronze_pack_chunks,
    bronze_pack_order,
    batch_stamp,
    append_roundtrip,
    project_columns,
    filter_country,
    filter_trailing_days,
    normalise_country,
    coalesce_parameter,
    parse_iso_ts,
    format_iso,
    format_duration,
    format_duration_fractions,
    silver_explode,
    raw_json,
    latest_snapshot,
    dim_locations_flatten,
    dim_sensors_flatten,
    sensors_in_country,
    unprocessed_batches,
    distinct_batches,
    batch_audit,
    batch_rejects,
    high_water_mark,
    ingest_window,
    fetch_plan,
    upsert_locations,
    upsert_sensors,
    merge_fact,
    upsert_daily_stats,
    daily_stats,
    daily_percentiles,
    daily_completeness,
    daily_with_location,
    alert_breaches,
    alert_state,
    dimensions_run,
    dimensions_run_sensors,
    ingest_run,
    stream_pages_run,
    run_log,
    window_marks,
    load_log,
    pages_to_daily,
    backlog_run,
    alert_run,
    facts_run,
    stream_facts_run,
]


def _configured(query: Callable[[SparkSession, str], DataFrame]):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(configure(spark), sf_dir)

    return run


def entry(spark: SparkSession) -> DataFrame:
    """Daily statistics of every sensor over the trailing days."""
    return daily_stats(configure(spark), SMOKE_DIR)


def core_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {query.__name__: _configured(query) for query in _QUERIES}


def _training_data() -> tuple[dict[str, Callable[[SparkSession, str], DataFrame]], dict[str, str]]:
    """Queries and SQL of the training-data operators, where that subpackage is installed."""
    try:
        import corpus_pipeline
        from gaugeline.llm import queries as numbered
    except ModuleNotFoundError as missing:
        if missing.name not in ("corpus_pipeline", "gaugeline.llm"):
            raise
        return {}, {}
    found = {query.__name__: _configured(query) for query in numbered.QUERIES}
    found["pipeline"] = _configured(corpus_pipeline.run)
    sql = dict(numbered.ORACLE_SQL)
    if corpus_pipeline.ORACLE_SQL:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found, sql


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return core_queries() | _training_data()[0]


def oracle_sql() -> dict[str, str]:
    return _sql() | _training_data()[1]
