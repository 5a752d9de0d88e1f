"""What runs read again, move or parse once more than they must."""

import json
from datetime import timedelta

from pyspark.sql import functions as F
from test_plans import AS_OF, NOW, bronze_rows, location, measurement, page

from gaugeline.operators import silver
from gaugeline.plans import dimensions, facts
from gaugeline.sources import catalog
from gaugeline.streaming.facts import stream_facts
from gaugeline.streaming.pages import stream_pages

DOCS = [measurement(NOW - timedelta(hours=h), float(h)) for h in range(6)]


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_micro_batch_is_logged_from_its_list(spark, tables, tmp_path, monkeypatch):
    """Its rows are an RDD, so each use would read all payloads again."""
    real, logged = facts.log_batches, []

    def log(batches, *rest):
        logged.append(batches.columns)
        real(batches, *rest)

    monkeypatch.setattr(facts, "log_batches", log)
    catalog.append(bronze_rows(spark, [("a", 1, DOCS), ("b", 1, DOCS[:2])]), tables.bronze_measurements)
    stream_facts(spark, tables, str(tmp_path / "stream"), NOW, AS_OF)
    assert logged == [[catalog.ARRIVED, "batch_id"]]
    done = spark.table(tables.batch_log).dropna(subset=["batch_id"]).collect()
    assert sorted(r.batch_id for r in done) == ["a", "b"]


def test_instants_of_a_row_are_parsed_once(spark):
    plan = optimized(silver.explode_batches(bronze_rows(spark, [("a", 1, DOCS)]), NOW))
    readings, rows = plan.split("Generate", 1)
    for name in ("ingestion_datetime", "ingestion_window_datetime_from", "ingestion_window_datetime_to"):
        assert f"cast({name}" not in readings and f"cast({name}" in rows


def test_readings_of_one_batch_are_not_moved(spark, tables, monkeypatch):
    """Those of several batches are still dealt out; rows without a batch have one place."""
    real, plans = catalog.replace_partitions, []

    def replace(df, table):
        plans.append(optimized(df))
        real(df, table)

    monkeypatch.setattr(catalog, "replace_partitions", replace)
    one = facts.stage(bronze_rows(spark, [("a", 1, DOCS), ("a", 2, DOCS[:1])]), tables, "l1", NOW)
    assert {(r.batch_id, r.load_id) for r in one.collect()} == {("a", "l1")} and one.count() == 7
    two = facts.stage(bronze_rows(spark, [("a", 1, DOCS), ("b", 1, DOCS)]), tables, "l2", NOW)
    assert two.count() == 12
    none = facts.stage(bronze_rows(spark, [(None, 1, DOCS)]), tables, "l3", NOW)
    assert {(r.batch_id, r.load_id) for r in none.collect()} == {(None, facts.UNNAMED_LOAD)}
    assert ["RebalancePartitions" in plan for plan in plans] == [False, True, True]


def test_the_copy_of_pages_holds_the_window_only(spark, tables, land, tmp_path):
    places = land("places", [page([location(1, "PT", [10])])], "d")
    dimensions.run_dimensions(spark, tables, "d", NOW, places)
    inside, outside = measurement(NOW - timedelta(hours=4), 1.0), measurement(NOW - timedelta(days=20), 2.0)
    lines = [
        page([inside, outside], 1, sensor_id=10),
        page([outside, outside], 2, sensor_id=10),
        {**page([inside, inside], 3, sensor_id=10), "status": 500},
    ]
    path, checkpoint = land("pages", lines, "r"), str(tmp_path / "stream")
    stream_pages(spark, tables, "r", NOW, path, checkpoint, "PT", page_limit=2)
    landed = spark.read.parquet(f"{checkpoint}/landed").orderBy("page").collect()
    assert [(r.documents, r.results and len(r.results)) for r in landed] == [(2, 1), (2, []), (2, None)]
    found = spark.table(tables.bronze_measurements).select(F.col("api_payload")).collect()
    assert [[d["value"] for d in json.loads(r.api_payload)] for r in found] == [[1.0]]
