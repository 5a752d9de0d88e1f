"""Counts per run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.functions.instants import iso_offset


def batch_audit(bronze: DataFrame) -> DataFrame:
    """Bronze rows and documents of every batch."""
    return bronze.groupBy("batch_id").agg(
        F.count("*").alias("bronze_rows"),
        F.sum("rows_fetched").alias("documents"),
    )


def ingested(plan: DataFrame, bronze: DataFrame, run_id: str) -> DataFrame:
    """Run-log rows of an ingestion: every planned country, also one without data."""
    windows = plan.select(
        "country_code",
        iso_offset(F.col("window_from")).alias("ingestion_window_datetime_from"),
        iso_offset(F.col("window_to")).alias("ingestion_window_datetime_to"),
    ).distinct()
    came = bronze.groupBy("country_code").agg(
        F.count("*").alias("bronze_rows"), F.sum("rows_fetched").alias("documents")
    )
    return windows.join(came, "country_code", "left").select(
        F.lit(run_id).alias("run_id"),
        F.lit("ingest").alias("kind"),
        "country_code",
        "ingestion_window_datetime_from",
        "ingestion_window_datetime_to",
        F.coalesce("bronze_rows", F.lit(0)).alias("bronze_rows"),
        F.coalesce("documents", F.lit(0)).alias("documents"),
    )


def loaded(staged: DataFrame, inserted: DataFrame, run_id: str, rejected_payloads: int) -> DataFrame:
    """The run-log row of a load, counted in what it wrote."""
    missing = F.col("measurement_datetime_from_utc").isNull() | F.col(
        "measurement_datetime_to_utc"
    ).isNull()
    counts = staged.agg(
        F.count("*").alias("staged"), F.count_if(missing).alias("rejected_instants")
    )
    return counts.join(inserted.agg(F.count("*").alias("inserted"))).select(
        F.lit(run_id).alias("run_id"),
        F.lit("load").alias("kind"),
        "staged",
        "inserted",
        F.lit(rejected_payloads).cast("bigint").alias("rejected_payloads"),
        "rejected_instants",
    )
