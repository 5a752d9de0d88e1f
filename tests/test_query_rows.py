"""Rows of queries whose own steps, not an operator's, decide how many there are."""

import glob
import os

import duckdb
import __spark_entry__ as entry
import oracle
from gaugeline.sources import landing
from pyspark.sql import functions as F


def _events(folder, sql):
    """The smallest tables with other events; the folder and its DuckDB session."""
    for path in glob.glob(f"{entry.SMOKE_DIR}/*.parquet"):
        if not path.endswith("/events.parquet"):
            os.symlink(path, folder / os.path.basename(path))
    duckdb.execute(f"COPY ({sql}) TO '{folder}/events.parquet'")
    return str(folder), oracle.connect(str(folder))


def test_backlog_keeps_rows_of_one_content(spark, tmp_path):
    """Readings that are all alike fill several bronze rows of one batch; each is its own.

    The rows get their batch id in place: no join by payload, whose tasks grow with the input.
    """
    same = """SELECT range AS event_id, TIMESTAMP '2024-01-01 05:10:00' AS ts, 3::BIGINT AS user_id,
              'view' AS event_type, 1.5::DOUBLE AS value, '{}' AS props FROM range(2000)"""
    path, duck = _events(tmp_path, same)
    found = entry.backlog_run(spark, path)
    assert oracle.differences(found, duck, entry.oracle_sql()["backlog_run"]) == []


def test_a_document_is_dated_once(spark):
    """Dating is most of the work of a window; either bound looks at the one date."""
    rows = spark.createDataFrame(
        [(['{"period":{"datetimeFrom":{"utc":"2024-01-01T05:00:00Z"}}}', "{}", None],), (None,)], "results array<string>"
    )
    bounds = [F.lit(f"2024-01-01T0{h}:00:00Z").cast("timestamp") for h in (5, 6)]
    kept = rows.select(landing.within_window(F.col("results"), *bounds).alias("results"))
    assert [r.results and len(r.results) for r in kept.collect()] == [3, None]
    plan = kept._jdf.queryExecution().analyzed().toString()
    assert plan.count("get_json_object") == 1
