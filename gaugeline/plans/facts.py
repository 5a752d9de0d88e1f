"""Fact run: landed measurement pages to bronze, staging, fact and daily statistics."""

from __future__ import annotations

import uuid
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gaugeline import schemas
from gaugeline.functions.instants import day_or_today, instant_or_now, iso_offset
from gaugeline.functions.values import DEFAULT_COUNTRY
from gaugeline.operators import audit, bronze, daily, planning, silver, upsert
from gaugeline.operators.joins import lookup_join
from gaugeline.session import configure, materialise
from gaugeline.sources import catalog, landing

# Planned sensors that pages meet by a broadcast; its bytes are bounded as well.
PLAN_BROADCAST = 1_000_000
BATCH_LOAD = "batch"
UNNAMED_LOAD = "unnamed"


# A write is done this many days after the day it began on, at the latest.
ARRIVAL_MARGIN = 1


def _folded_on(spark: SparkSession, tables: catalog.Tables) -> date | None:
    return spark.table(tables.window_marks).agg(F.max("folded_on")).first()[0]


def windows_seen(spark: SparkSession, tables: catalog.Tables) -> DataFrame:
    """Windows of ingestions that hold the last one of every country.

    These are the marks and what the run log got from the day before they were folded on;
    older days of the log are neither listed nor opened.
    """
    names = ["country_code", "ingestion_window_datetime_from", "ingestion_window_datetime_to"]
    log = spark.table(tables.run_log).where("kind = 'ingest'")
    folded_on = _folded_on(spark, tables)
    if folded_on is not None:
        log = log.where(F.col(catalog.ARRIVED) >= F.date_sub(F.lit(folded_on), ARRIVAL_MARGIN))
    return spark.table(tables.window_marks).select(*names).unionByName(log.select(*names))


def fold_marks(spark: SparkSession, tables: catalog.Tables) -> None:
    """Fold the run log into the marks, at most once a day.

    A window is folded any number of times without harm, so marks lost to another writer
    are made again from the log.
    """
    today, folded_on = _today(), _folded_on(spark, tables)
    if folded_on is not None and folded_on >= today:
        return
    marks = planning.high_water_mark(windows_seen(spark, tables)).select(
        "country_code",
        F.col("last_from").alias("ingestion_window_datetime_from"),
        F.col("last_to").alias("ingestion_window_datetime_to"),
        F.lit(today).alias("folded_on"),
    )
    catalog.publish(marks.coalesce(1), tables.window_marks)


def measurement_plan(
    spark: SparkSession,
    tables: catalog.Tables,
    run_ts: datetime,
    country_code: str | None = DEFAULT_COUNTRY,
) -> DataFrame:
    """Sensors to read and their window, of one country or, with None, of all.

    Windows follow the last one that was logged, also without data.
    """
    locations = spark.table(tables.dim_locations)
    marks = windows_seen(spark, tables)
    if country_code is not None:
        country_code = country_code.upper() or DEFAULT_COUNTRY
        locations = planning.in_country(locations, country_code)
        marks = planning.in_country(marks, country_code)
    windows = planning.country_windows(locations, marks, run_ts)
    sensors = planning.sensors_in_country(spark.table(tables.dim_sensors), locations)
    return planning.fetch_plan(sensors, windows)


def ingest_measurements(
    spark: SparkSession,
    tables: catalog.Tables,
    batch_id: str,
    run_ts: datetime,
    path: str,
    country_code: str | None = DEFAULT_COUNTRY,
) -> None:
    """Append the planned sensors' landed pages as one batch, in one write."""
    plan = materialise(measurement_plan(spark, tables, run_ts, country_code), "plan")
    landed = landing.read_measurement_pages(spark, path, batch_id)
    # Pages nobody planned are dropped before the copy, which then serves twice.
    planned = landing.landed_once(lookup_join(landed, plan, ["sensor_id"], "inner", PLAN_BROADCAST))
    pages = landing.page_prefix(planned, ["sensor_id"]).withColumn(
        "results",
        landing.within_window(F.col("results"), F.col("window_from"), F.col("window_to")),
    )
    rows = bronze.stamp_measurements(
        bronze.pack_pages(pages),
        batch_id,
        run_ts,
        iso_offset(F.col("window_from")),
        iso_offset(F.col("window_to")),
    )
    catalog.append(rows, tables.bronze_measurements)
    written = spark.table(tables.bronze_measurements).where(F.col("batch_id") == batch_id)
    log_run(audit.ingested(plan, written, batch_id), tables, run_ts)
    fold_marks(spark, tables)


def log_run(rows: DataFrame, tables: catalog.Tables, run_ts: datetime) -> None:
    """Append run-log rows; what a kind of run does not count is NULL."""
    nothing = rows.sparkSession.createDataFrame([], schemas.RUN_LOG).drop("logged_at")
    full = nothing.unionByName(rows, allowMissingColumns=True)
    stamped = full.withColumn("logged_at", instant_or_now(run_ts))
    catalog.append(stamped.coalesce(1), tables.run_log)


def _arrivals(spark: SparkSession, tables: catalog.Tables, table: str) -> DataFrame:
    """What reached ``table`` since the last load that found all that was pending.

    The mark is a partition name, and the filter is on partitions: neither what has been
    loaded before nor its log is listed or opened.
    """
    mark = catalog.last_partition(spark, tables.pickup_marks)
    rows = spark.table(table)
    if mark is None:
        return rows
    return rows.where(F.col(catalog.ARRIVED) >= F.date_sub(F.lit(date.fromisoformat(mark)), ARRIVAL_MARGIN))


def _pending(spark: SparkSession, tables: catalog.Tables) -> DataFrame:
    """(arrived_on, batch_id) of the bronze batches that the log does not name.

    Only partition columns are read. Rows without a batch id are no batch. What a batch
    brings on a later day is an arrival of its own.
    """
    names = [catalog.ARRIVED, "batch_id"]
    landed = _arrivals(spark, tables, tables.bronze_measurements).select(*names).distinct()
    done = _arrivals(spark, tables, tables.batch_log).select(*names).distinct()
    return lookup_join(landed.where("batch_id IS NOT NULL"), done, names, "left_anti")


def pending_batches(spark: SparkSession, tables: catalog.Tables) -> list[str]:
    return sorted({r.batch_id for r in _pending(spark, tables).collect()})


def stage(
    rows: DataFrame,
    tables: catalog.Tables,
    load_id: str,
    run_ts: datetime,
    observation: Observation | None = None,
    batches: DataFrame | None = None,
) -> DataFrame:
    """Write the staging rows of a load once and read them back.

    Rows without a batch id have one place, replaced whenever they are tried again. Rows of
    one batch are written by the tasks that parse them, as all of them have one place; those
    of several are first dealt out by batch.
    ``batches`` has the batch_id of all rows, where these are costly to read again.
    """
    unnamed = F.col("batch_id").isNull()
    listed = (rows if batches is None else batches).select("batch_id")
    found = [r.batch_id for r in listed.distinct().limit(2).collect()]
    staged = silver.explode_batches(rows, run_ts, observation)
    own = F.col(catalog.LOAD_ID) == load_id
    if len(found) == 1 and found[0] is not None:
        # Literals, so that the write has no partitions to sort by.
        place = {catalog.LOAD_ID: F.lit(load_id), "batch_id": F.lit(found[0])}
        catalog.replace_partitions(staged.withColumns(place), tables.staging)
    else:
        place = F.when(unnamed, UNNAMED_LOAD).otherwise(load_id)
        staged = staged.withColumn(catalog.LOAD_ID, place)
        catalog.replace_partitions(staged.hint("rebalance", "batch_id"), tables.staging)
        if not listed.where(unnamed).isEmpty():
            own = own | (F.col(catalog.LOAD_ID) == UNNAMED_LOAD)
    return rows.sparkSession.table(tables.staging).where(own)


def append_facts(
    staged: DataFrame, tables: catalog.Tables, run_ts: datetime, load_id: str
) -> None:
    """Append the readings the fact lacks, looking only at the days they fall on."""
    spark = staged.sparkSession
    day = F.to_date("measurement_datetime_from_utc")
    incoming = silver.to_fact(staged, run_ts).withColumn(catalog.FACT_DAY, day)
    on_days = upsert.values_filter(incoming, catalog.FACT_DAY)
    fresh = upsert.absent_readings(spark.table(tables.fact).where(on_days), incoming)
    # Rows go to their buckets' tasks; of a bucket that holds most rows, to several.
    bucket = F.pmod(F.hash(*schemas.FACT_KEY), F.lit(tables.fact_buckets))
    layout = fresh.withColumns({catalog.LOAD_ID: F.lit(load_id), "__bucket": bucket})
    catalog.append(layout.hint("rebalance", "__bucket"), tables.fact)


def touched_days(spark: SparkSession, tables: catalog.Tables, load_id: str) -> DataFrame:
    """Days of the readings of one load, from its partitions."""
    own = spark.table(tables.fact).where(F.col(catalog.LOAD_ID) == load_id)
    return own.select(catalog.FACT_DAY).dropna().distinct()


def note_days(days: DataFrame, tables: catalog.Tables, change: str) -> None:
    """Append (measurement_day, load_id) to the record of changed days, in small files by month."""
    noted = days.select(
        catalog.FACT_DAY,
        catalog.LOAD_ID,
        F.lit(change).alias("change"),
        F.date_format(catalog.FACT_DAY, "yyyy-MM").alias("month"),
    )
    catalog.append(noted.coalesce(1), tables.day_changes)


def log_batches(
    batches: DataFrame,
    tables: catalog.Tables,
    run_ts: datetime,
    load_id: str,
    arrived: date,
) -> None:
    """The commit of a load, one small write: its batches, and one row without batch.

    ``batches`` has batch_id and arrived_on; ``arrived`` is the day of the row without.
    """
    spark = batches.sparkSession
    none = spark.range(1).select(F.lit(arrived).alias(catalog.ARRIVED), F.lit(None).cast("string").alias("batch_id"))
    named = batches.select(catalog.ARRIVED, "batch_id").distinct().where("batch_id IS NOT NULL").union(none)
    logged = named.withColumns(
        {"processed_at": instant_or_now(run_ts), catalog.LOAD_ID: F.lit(load_id)}
    )
    catalog.append(logged.coalesce(1), tables.batch_log)


def _note(spark: SparkSession, tables: catalog.Tables, load_id: str, state: str) -> None:
    row = spark.range(1).select(
        F.lit(load_id).alias(catalog.LOAD_ID),
        F.lit(state).alias("state"),
        F.current_timestamp().alias("noted_at"),
    )
    catalog.append(row, tables.load_starts)


class LoadConflict(RuntimeError):
    """Another load owns the fact; nothing of this one remains, and it can be tried again."""


# A load that is still open after this time has died. A living one commits within half of it.
STALE_AFTER = timedelta(hours=12)


def open_loads(spark: SparkSession, tables: catalog.Tables) -> DataFrame:
    """(load_id, noted_at) of the loads that started and are neither committed nor undone."""
    catalog.refresh(spark, tables)
    starts = spark.table(tables.load_starts)
    settled = starts.where("state = 'undone'").select(catalog.LOAD_ID)
    settled = settled.union(spark.table(tables.batch_log).select(catalog.LOAD_ID))
    begun = starts.where("state = 'started'").groupBy(catalog.LOAD_ID).agg(F.min("noted_at").alias("noted_at"))
    return begun.join(settled, catalog.LOAD_ID, "left_anti")


def undo(spark: SparkSession, tables: catalog.Tables, load_id: str) -> None:
    """Drop what a load wrote; the days it touched count as changed once more."""
    days = touched_days(spark, tables, load_id).withColumn(catalog.LOAD_ID, F.lit(f"undo-{load_id}"))
    note_days(days, tables, "touched")
    for table in (tables.fact, tables.staging):
        catalog.drop_load(spark, table, load_id)
    _note(spark, tables, load_id, "undone")


def undo_unfinished(
    spark: SparkSession,
    tables: catalog.Tables,
    stale_after: timedelta = STALE_AFTER,
    own: str | None = None,
) -> None:
    """Undo open loads that began longer ago than ``stale_after``, or whose name begins with ``own``."""
    dead = F.col("noted_at") <= F.current_timestamp() - F.make_dt_interval(secs=F.lit(stale_after.total_seconds()))
    if own is not None:
        dead = dead | F.startswith(F.col(catalog.LOAD_ID), F.lit(own))
    for row in open_loads(spark, tables).where(dead).collect():  # failed loads since the last run
        undo(spark, tables, row[catalog.LOAD_ID])


def claim(spark: SparkSession, tables: catalog.Tables, load_id: str) -> None:
    """Note the start of a load, unless another one is under way.

    Both write before they look, so of two that start at once at least one sees the
    other and withdraws, possibly both.
    """
    _note(spark, tables, load_id, "started")
    others = [r[catalog.LOAD_ID] for r in open_loads(spark, tables).collect()]
    if others != [load_id]:
        _note(spark, tables, load_id, "undone")
        raise LoadConflict(f"loads under way: {', '.join(sorted(set(others) - {load_id}))}")


def confirm(spark: SparkSession, tables: catalog.Tables, load_id: str) -> None:
    """Refuse to commit a load that another one undid, or may undo meanwhile."""
    alive = F.col("noted_at") > F.current_timestamp() - F.make_dt_interval(
        secs=F.lit(STALE_AFTER.total_seconds() / 2)
    )
    if open_loads(spark, tables).where((F.col(catalog.LOAD_ID) == load_id) & alive).isEmpty():
        raise LoadConflict(f"load {load_id} took too long or was taken for dead and undone")


def load_batches(
    rows: DataFrame,
    tables: catalog.Tables,
    load_id: str,
    run_ts: datetime,
    arrived: date | None = None,
    batches: DataFrame | None = None,
) -> None:
    """One load: claim the fact, stage, append, note the days, confirm, commit.

    A load that fails is undone at once, one whose process dies when it is stale.
    ``batches`` has (arrived_on, batch_id) of all rows, where these are costly to read again.
    """
    spark = rows.sparkSession
    claim(spark, tables, load_id)
    try:
        observation = Observation()
        staged = stage(rows, tables, load_id, run_ts, observation, batches)
        append_facts(staged, tables, run_ts, load_id)
        days = touched_days(spark, tables, load_id).withColumn(catalog.LOAD_ID, F.lit(load_id))
        note_days(days, tables, "touched")
        confirm(spark, tables, load_id)
        log_batches(rows if batches is None else batches, tables, run_ts, load_id, arrived or _today())
    except Exception:
        # What is committed stays, also if only the answer to its commit was lost.
        if not open_loads(spark, tables).where(F.col(catalog.LOAD_ID) == load_id).isEmpty():
            undo(spark, tables, load_id)
        raise
    fact = spark.table(tables.fact).where(F.col(catalog.LOAD_ID) == load_id)
    rejected = observation.get["rejected_payloads"]
    log_run(audit.loaded(staged, fact, load_id, rejected), tables, run_ts)


def _today() -> date:
    """The current day of the session zone, which is UTC."""
    return datetime.now(timezone.utc).date()


def _chosen(bronze_rows: DataFrame, pending: DataFrame) -> tuple[DataFrame, int]:
    """The rows of the pending batches and how many these are; only their files are read."""
    found = pending.limit(upsert.MAX_PRUNE_VALUES + 1).collect()
    if len(found) > upsert.MAX_PRUNE_VALUES:
        pruned = upsert.values_filter(pending, catalog.ARRIVED) & upsert.values_filter(pending, "batch_id")
        rows = lookup_join(bronze_rows.where(pruned), pending, pending.columns, "left_semi")
        return rows, pending.count()
    by_day: dict[date, list[str]] = {}
    for row in found:
        by_day.setdefault(row[catalog.ARRIVED], []).append(row.batch_id)
    chosen = F.lit(False)
    for day, batches in by_day.items():
        chosen = chosen | ((F.col(catalog.ARRIVED) == F.lit(day)) & F.col("batch_id").isin(batches))
    return bronze_rows.where(chosen), len(found)


def transform_measurements(
    spark: SparkSession,
    tables: catalog.Tables,
    run_ts: datetime,
    stale_after: timedelta = STALE_AFTER,
) -> int:
    """Load every batch not yet loaded, all in one load; returns how many there were.

    Only one load may be under way: others fail with ``LoadConflict``. One whose process
    has died is undone after ``stale_after``; 0 undoes it at once, once it is known dead.
    Bronze rows without a batch id cannot be told from loaded ones, so they are
    tried every time.
    """
    undo_unfinished(spark, tables, stale_after)
    listed_on = _today()
    bronze_rows = spark.table(tables.bronze_measurements)
    rows, count = _chosen(bronze_rows, materialise(_pending(spark, tables), "pending"))
    unnamed = bronze_rows.where("batch_id IS NULL")
    if not unnamed.isEmpty():
        rows = rows.unionByName(unnamed)
    elif not count:
        return 0
    load_id = f"{BATCH_LOAD}-{uuid.uuid4().hex}"
    load_batches(rows, tables, load_id, run_ts, listed_on)
    mark = spark.range(1).select(F.lit(load_id).alias(catalog.LOAD_ID), F.lit(listed_on).alias(catalog.ARRIVED))
    catalog.append(mark, tables.pickup_marks)
    return count


def changed_days(spark: SparkSession, tables: catalog.Tables, first_day: Column) -> DataFrame:
    """(measurement_day, load_id) of days from ``first_day`` on that loads touched since
    they were built; months before are not read."""
    noted = spark.table(tables.day_changes).where(
        (F.col("month") >= F.date_format(first_day, "yyyy-MM")) & (F.col(catalog.FACT_DAY) >= first_day)
    )
    key = [catalog.FACT_DAY, catalog.LOAD_ID]
    built = noted.where("change = 'built'").select(*key)
    return noted.where("change = 'touched'").select(*key).distinct().join(built, key, "left_anti")


def build_daily(
    spark: SparkSession, tables: catalog.Tables, as_of: date | None = None, everything: bool = False
) -> None:
    """Recompute those trailing days that loads touched, and replace their partitions.

    A day is always recomputed as a whole, so the outcome is that of recomputing all
    trailing days, which ``everything`` asks for.
    """
    first_day = F.date_sub(day_or_today(as_of), daily.TRAILING_DAYS)
    recent = spark.table(tables.fact).where(F.col(catalog.FACT_DAY) >= first_day)
    changes = materialise(changed_days(spark, tables, first_day), "changes")
    if not everything:
        if changes.isEmpty():
            return
        recent = recent.where(upsert.values_filter(changes, catalog.FACT_DAY))
    stats = daily.daily_stats(daily.trailing_days(recent, as_of=as_of))
    current = spark.table(tables.daily).where(upsert.values_filter(stats, "day_start"))
    merged = upsert.upsert_daily(current, stats).hint("rebalance", "day_start")
    catalog.replace_partitions(merged, tables.daily)
    note_days(changes, tables, "built")


def run_facts(
    spark: SparkSession,
    tables: catalog.Tables,
    batch_id: str,
    run_ts: datetime,
    landing_path: str | None = None,
    country_code: str | None = DEFAULT_COUNTRY,
    as_of: date | None = None,
) -> None:
    """Without ``landing_path`` only batches already in bronze are loaded."""
    configure(spark)
    catalog.ensure_all(spark, tables)
    if landing_path is not None:
        ingest_measurements(spark, tables, batch_id, run_ts, landing_path, country_code)
    transform_measurements(spark, tables, run_ts)
    build_daily(spark, tables, as_of)
