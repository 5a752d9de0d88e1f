"""Catalog tables on parquet: creation, append, partition replacement, publication.

Parquet tables take no row-level changes, so a changed table is written anew: a
small one as a new folder the table is then pointed at, a partitioned one by
overwriting the partitions touched.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeline import schemas

FACT_DAY = "measurement_day"
LOAD_ID = "load_id"
# The day a batch was written to bronze, by the clock of the writer and not by that of
# the run, which is the caller's.
ARRIVED = "arrived_on"


@dataclass(frozen=True)
class Tables:
    """Names of the tables of one database.

    ``fact_buckets`` counts once the fact is created: so many tasks meet it in a load. It
    should grow with the table, to some gigabytes a bucket and month.
    """

    database: str = "sensors"
    fact_buckets: int = 8

    def _name(self, table: str) -> str:
        return f"{self.database}.{table}"

    @property
    def bronze_locations(self) -> str:
        return self._name("bronze_locations_snapshots")

    @property
    def bronze_measurements(self) -> str:
        return self._name("bronze_measurements_batches")

    @property
    def dim_locations(self) -> str:
        return self._name("dim_locations")

    @property
    def dim_sensors(self) -> str:
        return self._name("dim_sensors")

    @property
    def staging(self) -> str:
        return self._name("silver_measurements_exploded")

    @property
    def fact(self) -> str:
        return self._name("fact_measurements")

    @property
    def daily(self) -> str:
        return self._name("sensor_daily_completeness")

    @property
    def batch_log(self) -> str:
        return self._name("processed_batches")

    @property
    def run_log(self) -> str:
        return self._name("run_log")

    @property
    def load_starts(self) -> str:
        return self._name("load_starts")

    @property
    def pickup_marks(self) -> str:
        return self._name("pickup_marks")

    @property
    def day_changes(self) -> str:
        return self._name("day_changes")

    @property
    def window_marks(self) -> str:
        return self._name("window_marks")


def ensure_database(spark: SparkSession, database: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")


def ensure_table(
    spark: SparkSession,
    table: str,
    schema: T.StructType,
    partition_by: Sequence[str] = (),
    bucket_by: Sequence[str] = (),
    buckets: int = 0,
) -> None:
    """Create an empty table unless it exists; partition columns go last."""
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
    layout = f"PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    if bucket_by:
        layout += f" CLUSTERED BY ({', '.join(bucket_by)}) INTO {buckets} BUCKETS"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet {layout}")


def ensure_like(df: DataFrame, table: str) -> None:
    """Create an empty table with the columns of a query."""
    if not df.sparkSession.catalog.tableExists(table):
        df.limit(0).write.format("parquet").saveAsTable(table)


def ensure_all(spark: SparkSession, tables: Tables) -> None:
    """All tables of a database. Bronze and staging are laid out by batch, so a run
    reads only its own files, bronze readings by day of arrival as well; fact and daily
    statistics by day. The fact is bucketed by its key, so that new readings meet it
    without moving it."""
    arrived = T.StructField(ARRIVED, T.DateType())
    ensure_database(spark, tables.database)
    ensure_table(spark, tables.bronze_locations, schemas.BRONZE_LOCATIONS, ["batch_id"])
    ensure_table(
        spark,
        tables.bronze_measurements,
        T.StructType(schemas.BRONZE_MEASUREMENTS.fields + [arrived]),
        [ARRIVED, "batch_id"],
    )
    ensure_table(spark, tables.dim_locations, schemas.DIM_LOCATIONS)
    ensure_table(spark, tables.dim_sensors, schemas.DIM_SENSORS)
    ensure_table(
        spark,
        tables.staging,
        T.StructType(schemas.STAGING.fields + [T.StructField(LOAD_ID, T.StringType())]),
        [LOAD_ID, "batch_id"],
    )
    ensure_table(
        spark,
        tables.fact,
        T.StructType(
            schemas.FACT.fields
            + [T.StructField(FACT_DAY, T.DateType()), T.StructField(LOAD_ID, T.StringType())]
        ),
        [FACT_DAY, LOAD_ID],
        schemas.FACT_KEY,
        tables.fact_buckets,
    )
    ensure_table(spark, tables.daily, schemas.DAILY, ["day_start"])
    ensure_table(spark, tables.batch_log, schemas.BATCH_LOG, [ARRIVED])
    ensure_table(spark, tables.pickup_marks, schemas.PICKUP_MARKS, [ARRIVED])
    ensure_table(spark, tables.day_changes, schemas.DAY_CHANGES, ["month"])
    ensure_table(spark, tables.load_starts, schemas.LOAD_STARTS)
    ensure_table(spark, tables.run_log, T.StructType(schemas.RUN_LOG.fields + [arrived]), ["kind", ARRIVED])
    ensure_table(spark, tables.window_marks, schemas.WINDOW_MARKS)
    refresh(spark, tables)


def refresh(spark: SparkSession, tables: Tables) -> None:
    """Forget cached file listings: another session, a stream's too, may have written."""
    for table in (
        tables.bronze_locations,
        tables.bronze_measurements,
        tables.dim_locations,
        tables.dim_sensors,
        tables.staging,
        tables.fact,
        tables.daily,
        tables.batch_log,
        tables.load_starts,
        tables.run_log,
        tables.pickup_marks,
        tables.day_changes,
        tables.window_marks,
    ):
        spark.catalog.refreshTable(table)


def append(df: DataFrame, table: str) -> None:
    """Append by column name, in one commit; a day of arrival is today unless given."""
    target = df.sparkSession.table(table)
    if ARRIVED in target.columns and ARRIVED not in df.columns:
        df = df.withColumn(ARRIVED, F.current_date())
    df.select(*target.columns).write.mode("append").insertInto(table)


def replace_partitions(df: DataFrame, table: str) -> None:
    """Replace the partitions that ``df`` holds rows of and keep all others."""
    target = df.sparkSession.table(table)
    df.select(*target.columns).write.mode("overwrite").insertInto(table)


def drop_load(spark: SparkSession, table: str, load_id: str, column: str = LOAD_ID) -> None:
    """Drop the partitions one load wrote, or those of one value of another ``column``."""
    quoted = load_id.replace("'", "\\'")
    found = spark.sql(f"SHOW PARTITIONS {table} PARTITION ({column}='{quoted}')").collect()
    for row in found:  # the days or batches of one load
        parts = dict(part.split("=", 1) for part in row.partition.split("/"))
        spec = ", ".join(f"{k}={_partition_literal(v)}" for k, v in parts.items())
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({spec})")


def last_partition(spark: SparkSession, table: str) -> str | None:
    """The largest value of a table's one partition column, from the catalog alone."""
    names = [r.partition.split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]
    return max((unquote(n) for n in names if n != NO_VALUE), default=None)


NO_VALUE = "__HIVE_DEFAULT_PARTITION__"  # fixed name of the partition of NULL


def _partition_literal(name: str) -> str:
    """An SQL literal of a partition value as the catalog writes it."""
    if name == NO_VALUE:
        return "NULL"
    value = unquote(name).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{value}'"


def publish(df: DataFrame, table: str) -> None:
    """Replace a whole table: write a new folder, then point the table at it.

    Readers see the old or the new table, never a mix, and ``df`` may read it. The
    earlier folder is left for readers still on it.
    """
    spark = df.sparkSession
    database, name = table.rsplit(".", 1)
    home = spark.catalog.getDatabase(database).locationUri.rstrip("/")
    version = f"{home}/{name}__{uuid.uuid4().hex}"
    df.select(*spark.table(table).columns).write.parquet(version)
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{version}'")
    spark.catalog.refreshTable(table)
