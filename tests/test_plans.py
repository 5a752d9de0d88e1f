import json
from collections import Counter
from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from gaugeline import schemas
from gaugeline.operators import upsert
from gaugeline.operators.dimensions import latest_snapshot
from gaugeline.plans import dimensions, facts
from gaugeline.plans.alert import run_alert
from gaugeline.sources import catalog

NOW = datetime(2024, 1, 31, 12, 0, tzinfo=timezone.utc)
AS_OF = date(2024, 1, 31)


def location(number, country, sensors, last="2024-01-30T00:00:00Z", name="place"):
    return {
        "id": number,
        "name": name,
        "country": {"name": country, "code": country},
        "datetimeLast": {"utc": last},
        "sensors": [
            {"id": s, "name": f"s{s}", "parameter": {"id": 7, "name": "o3"}} for s in sensors
        ],
    }


def measurement(at, value):
    end = at + timedelta(hours=1)
    return {
        "value": value,
        "unit": "ppm",
        "parameter": {"id": 7, "name": "o3"},
        "period": {
            "datetimeFrom": {"utc": at.strftime("%Y-%m-%dT%H:%M:%SZ")},
            "datetimeTo": {"utc": end.strftime("%Y-%m-%dT%H:%M:%SZ")},
        },
    }


def page(results, number=1, **feed):
    return {**feed, "page": number, "status": 200, "results": results}


def contents(spark, table, drop=("load_id",)):
    """Rows with their numbers; sums of doubles depend on their order in the last digits."""
    rows = spark.table(table).drop(*drop).collect()
    return Counter(tuple(round(v, 9) if isinstance(v, float) else v for v in row) for row in rows)


def bronze_rows(spark, rows):
    """(batch, sensor, documents) as bronze rows."""
    at = NOW.isoformat()
    return spark.createDataFrame(
        [(b, s, "7", 1, "PT", at, at, at, len(d), json.dumps(d)) for b, s, d in rows],
        schemas.BRONZE_MEASUREMENTS,
    )


def test_dimension_runs(spark, tables, land):
    first = [location(1, "PT", [10, 11]), location(2, "ES", [20])]
    dimensions.run_dimensions(spark, tables, "b1", NOW, land("one", [page(first)], "b1"))
    changed = [
        location(1, "PT", [10], name="renamed"),
        location(2, "ES", [20], last="2024-01-31T00:00:00Z", name="moved"),
        location(3, "PT", [30]),
    ]
    later = NOW + timedelta(days=7)
    dimensions.run_dimensions(spark, tables, "b2", later, land("two", [page(changed)], "b2"))
    found = {r.location_id: r for r in spark.table(tables.dim_locations).collect()}
    assert {i: r.name for i, r in found.items()} == {1: "place", 2: "moved", 3: "place"}
    sensors = {r.sensor_id: r.bronze_ingestion_time for r in spark.table(tables.dim_sensors).collect()}
    assert {s: t == later.isoformat() for s, t in sensors.items()} == {
        10: True, 11: False, 20: True, 30: True,
    }
    before = contents(spark, tables.dim_locations)
    dimensions.run_dimensions(spark, tables, "b3", later, land("none", [page([])], "b3"))
    assert contents(spark, tables.dim_locations) == before
    newest = spark.table(tables.bronze_locations).where("batch_id = 'b3'").collect()
    assert [(r.rows_fetched, r.api_payload) for r in newest] == [(0, "[]")]


def test_requests_in_one_folder_stay_apart(spark, tables, land):
    """Each run sees the pages of its own request: page 2 follows its own page 1."""
    full = [location(n, "PT", [n]) for n in range(1000)]
    land("all", [page(full[:1])], "b1")
    land("all", [page(full, 1), page([location(5000, "ES", [9000])], 2)], "b2")
    path = land("all", [], "b3")
    dimensions.run_dimensions(spark, tables, "b1", NOW, path)
    assert spark.table(tables.dim_locations).count() == 1
    dimensions.run_dimensions(spark, tables, "b2", NOW + timedelta(days=7), path)
    assert spark.table(tables.dim_locations).count() == 1001
    dimensions.run_dimensions(spark, tables, "nothing landed", NOW + timedelta(days=8), path)
    assert spark.table(tables.dim_locations).count() == 1001


def test_no_snapshot_changes_nothing(spark, tables):
    dimensions.run_dimensions(spark, tables, "b", NOW)
    assert spark.table(tables.dim_locations).count() == 0


def test_landing_to_daily_statistics(spark, tables, land):
    places = [location(1, "PT", [10, 11]), location(2, "ES", [20])]
    dimensions.run_dimensions(spark, tables, "d", NOW, land("places", [page(places)], "d"))
    cap = NOW - timedelta(hours=2)
    hours = [cap - timedelta(hours=h) for h in range(6, -1, -1)]
    pages = [
        page([measurement(t, float(i)) for i, t in enumerate(hours)], sensor_id=10),
        page([], sensor_id=11),
        page([measurement(hours[3], 9.0)], sensor_id=20),
        page([measurement(hours[3], 9.0)], sensor_id=99),
    ]
    for request in ("m1", "m2", "m3"):
        path = land("readings", pages, request)
    facts.run_facts(spark, tables, "m1", NOW, path, "pt", AS_OF)
    (bronze,) = spark.table(tables.bronze_measurements).collect()
    assert (bronze.sensor_id, bronze.rows_fetched, bronze.country_code) == (10, 4, "PT")
    assert bronze.ingestion_window_datetime_from == (cap - timedelta(hours=4)).isoformat()
    assert bronze.ingestion_window_datetime_to == cap.isoformat()
    fact = spark.table(tables.fact)
    assert sorted(r.value for r in fact.collect()) == [2.0, 3.0, 4.0, 5.0]
    (stats,) = spark.table(tables.daily).collect()
    assert (stats.sensor_id, stats.avg_value, stats.reading_count) == (10, 3.5, 4)
    assert stats.day_start == AS_OF

    # Nothing new: up to date at the same clock, then the window moves on.
    facts.run_facts(spark, tables, "m2", NOW, path, "PT", AS_OF)
    assert fact.count() == 4 and spark.table(tables.bronze_measurements).count() == 1
    facts.run_facts(spark, tables, "m3", NOW + timedelta(hours=1), path, None, AS_OF)
    counts = {r.sensor_id: r["count"] for r in spark.table(tables.fact).groupBy("sensor_id").count().collect()}
    assert counts == {10: 5, 20: 1}


def test_one_run_or_two(spark, tables):
    """Batches with disjoint keys give the same fact in one run or two."""
    docs = [measurement(NOW - timedelta(hours=h), float(h)) for h in range(40)]
    first, second = ("a", 1, docs[:25]), ("b", 1, docs[25:])
    other = catalog.Tables(f"{tables.database}_other")
    catalog.ensure_all(spark, other)
    catalog.append(bronze_rows(spark, [first, second]), other.bronze_measurements)
    facts.run_facts(spark, other, "", NOW, as_of=AS_OF)
    for rows in (first, second):
        catalog.append(bronze_rows(spark, [rows]), tables.bronze_measurements)
        facts.run_facts(spark, tables, "", NOW, as_of=AS_OF)
    assert contents(spark, tables.fact) == contents(spark, other.fact)
    assert contents(spark, tables.daily) == contents(spark, other.daily)
    before = contents(spark, tables.fact), contents(spark, tables.staging)
    facts.run_facts(spark, tables, "", NOW + timedelta(hours=1), as_of=AS_OF)
    assert (contents(spark, tables.fact), contents(spark, tables.staging)) == before
    spark.sql(f"DROP DATABASE {other.database} CASCADE")


def test_batches_without_new_readings_are_done_once(spark, tables):
    docs = [measurement(NOW, 1.0), measurement(NOW, 2.0)]
    catalog.append(bronze_rows(spark, [("a", 1, docs)]), tables.bronze_measurements)
    facts.run_facts(spark, tables, "", NOW, as_of=AS_OF)
    assert spark.table(tables.fact).count() == 2  # duplicates inside a batch stay
    again = [("again", 1, docs), ("empty", 1, [])]
    catalog.append(bronze_rows(spark, again), tables.bronze_measurements)
    assert facts.transform_measurements(spark, tables, NOW) == 2
    assert facts.transform_measurements(spark, tables, NOW) == 0
    assert spark.table(tables.fact).count() == 2
    assert spark.table(tables.staging).count() == 4


@pytest.mark.parametrize("step", ["append_facts", "log_batches"])
def test_retry_after_a_failed_step(spark, tables, monkeypatch, step):
    """A retry adds nothing twice, not even readings with a NULL key."""
    undated = {**measurement(NOW, 3.0), "period": None}
    docs = [measurement(NOW, 1.0), undated, undated]
    catalog.append(bronze_rows(spark, [("a b/c+d%", 1, docs)]), tables.bronze_measurements)

    def fail(*args, **kwargs):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(facts, step, fail)
        with pytest.raises(RuntimeError):
            facts.transform_measurements(spark, tables, NOW)
    assert facts.transform_measurements(spark, tables, NOW) == 1
    assert spark.table(tables.fact).count() == 3
    assert spark.table(tables.staging).count() == 3
    assert facts.transform_measurements(spark, tables, NOW) == 0


def test_rows_without_batch_id_are_tried_every_time(spark, tables):
    rows = [(None, 1, [measurement(NOW, 1.0)]), ("a", 2, [measurement(NOW, 2.0)])]
    catalog.append(bronze_rows(spark, rows), tables.bronze_measurements)
    assert facts.transform_measurements(spark, tables, NOW) == 1
    assert facts.transform_measurements(spark, tables, NOW) == 0
    assert sorted(r.value for r in spark.table(tables.fact).collect()) == [1.0, 2.0]
    assert spark.table(tables.staging).count() == 2


def test_overlapping_batches_of_one_run_keep_their_copies(spark, tables, monkeypatch):
    """Whatever the number of pending batches: one load, also where the filter is a range."""
    docs = [measurement(NOW, 1.0), measurement(NOW - timedelta(hours=1), 2.0)]
    rows = [(f"b{i}", 1, docs) for i in range(7)]
    catalog.append(bronze_rows(spark, rows), tables.bronze_measurements)
    monkeypatch.setattr(upsert, "MAX_PRUNE_VALUES", 3)
    assert facts.transform_measurements(spark, tables, NOW) == 7
    assert spark.table(tables.fact).count() == 14
    assert spark.table(tables.batch_log).where("batch_id IS NULL").count() == 1


def test_half_an_append_is_undone(spark, tables):
    """Part of a batch's rows in the fact, not committed: the batch is loaded whole."""
    docs = [measurement(NOW - timedelta(hours=h), float(h)) for h in range(10)]
    undated = {**measurement(NOW, 3.0), "period": None}
    rows = bronze_rows(spark, [("a b/c+d%", 1, [*docs, undated])])
    catalog.append(rows, tables.bronze_measurements)
    facts._note(spark, tables, "lost", "started")
    staged = facts.stage(spark.table(tables.bronze_measurements), tables, "lost", NOW)
    facts.append_facts(staged.where("value < 5"), tables, NOW, "lost")
    assert spark.table(tables.fact).count() == 6
    with pytest.raises(facts.LoadConflict, match="lost"):  # it may be at work
        facts.transform_measurements(spark, tables, NOW)
    assert spark.table(tables.fact).count() == 6
    assert facts.transform_measurements(spark, tables, NOW, stale_after=timedelta(0)) == 1
    assert spark.table(tables.fact).count() == 11
    assert spark.table(tables.staging).count() == 11
    assert facts.transform_measurements(spark, tables, NOW) == 0


def test_fact_lookup_reads_only_the_days_of_the_batch(spark, tables):
    days = [NOW - timedelta(days=d) for d in range(5)]
    rows = [("a", 1, [measurement(t, 1.0) for t in days])]
    catalog.append(bronze_rows(spark, rows), tables.bronze_measurements)
    facts.transform_measurements(spark, tables, NOW)
    fact = spark.table(tables.fact)
    incoming = fact.where(F.col(catalog.FACT_DAY) == date(2024, 1, 30))
    pruned = fact.where(upsert.values_filter(incoming, catalog.FACT_DAY))
    assert len(fact.inputFiles()) == 5 and len(pruned.inputFiles()) == 1


def test_latest_snapshot_reads_only_its_own_files(spark, tables, land):
    for batch_id, run_ts in (("b1", NOW), ("b2", NOW + timedelta(days=1))):
        path = land("weekly", [page([location(1, "PT", [10])])], batch_id)
        dimensions.run_dimensions(spark, tables, batch_id, run_ts, path)
    newest = latest_snapshot(spark.table(tables.bronze_locations))
    assert [r.batch_id for r in newest.collect()] == ["b2"]
    assert all("batch_id=b2" in f for f in newest.inputFiles())


def test_alert_run(spark, tables, land):
    dimensions.run_dimensions(
        spark, tables, "d", NOW, land("places", [page([location(1, "PT", [1, 2], name="here")])], "d")
    )
    rows = [("a", s, [measurement(NOW, 130.0)]) for s in (1, 2)]
    catalog.append(bronze_rows(spark, rows), tables.bronze_measurements)
    facts.run_facts(spark, tables, "", NOW, as_of=AS_OF)
    found, state = run_alert(spark, tables, AS_OF, [(7, 120)])
    assert [(r.location_name, r.avg_value) for r in found.collect()] == [("here", 130.0)]
    assert tuple(state.first()) == (1, "OK")  # one row: both sensors share all its columns
    assert run_alert(spark, tables, AS_OF)[1].first().state == "OK"


def test_gold_keeps_days_outside_the_window(spark, tables):
    old, new = NOW - timedelta(days=90), NOW
    rows = [("a", 1, [measurement(old, 1.0)])]
    catalog.append(bronze_rows(spark, rows), tables.bronze_measurements)
    facts.run_facts(spark, tables, "", NOW, as_of=old.date())
    rows = [("b", 1, [measurement(old, 9.0), measurement(old + timedelta(hours=1), 9.0),
                      measurement(new, 2.0)])]
    catalog.append(bronze_rows(spark, rows), tables.bronze_measurements)
    facts.run_facts(spark, tables, "", NOW, as_of=AS_OF)
    found = {r.day_start: (r.avg_value, r.reading_count) for r in spark.table(tables.daily).collect()}
    assert found == {old.date(): (1.0, 1), new.date(): (2.0, 1)}
    assert spark.table(tables.fact).count() == 3


def test_ddl_is_idempotent(spark, tables):
    catalog.ensure_all(spark, tables)
    daily = spark.table(tables.daily)
    assert set(daily.columns) == set(schemas.DAILY.fieldNames())
    catalog.ensure_like(daily, f"{tables.database}.copy")
    catalog.ensure_like(daily, f"{tables.database}.copy")
    assert spark.table(f"{tables.database}.copy").count() == 0
