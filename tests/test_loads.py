"""Loads beside history and beside each other: what they read, move, rebuild and refuse."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F
from test_plans import AS_OF, NOW, bronze_rows, contents, measurement

from gaugeline import schemas
from gaugeline.operators import upsert
from gaugeline.plans import facts
from gaugeline.sources import catalog
from gaugeline.streaming.facts import stream_facts


def readings(*hours, value=1.0):
    return [measurement(NOW - timedelta(hours=h), value) for h in hours]


def load(spark, tables, *batches):
    catalog.append(bronze_rows(spark, [(b, 1, docs) for b, docs in batches]), tables.bronze_measurements)
    return facts.transform_measurements(spark, tables, NOW)


def plan_of(df):
    return df._jdf.queryExecution().toString()


def test_pickup_does_not_open_history(spark, tables):
    """2,000 batches of long ago: a run lists and opens the newest days only."""
    old = spark.range(2_000).select(
        F.format_string("old-%05d", "id").alias("batch_id"),
        F.date_sub(F.current_date(), (F.col("id") % 40 + 10).cast("int")).alias(catalog.ARRIVED),
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.BRONZE_MEASUREMENTS.fields[1:]],
    )
    catalog.append(old.coalesce(1), tables.bronze_measurements)
    logged = old.select("batch_id", catalog.ARRIVED).withColumns(
        {"processed_at": F.current_timestamp(), catalog.LOAD_ID: F.lit("earlier")}
    )
    catalog.append(logged.coalesce(1), tables.batch_log)
    yesterday = spark.sql("SELECT 'earlier' AS load_id, current_date() - 1 AS arrived_on")
    catalog.append(yesterday, tables.pickup_marks)
    catalog.append(bronze_rows(spark, [("new", 1, readings(1, 2))]), tables.bronze_measurements)
    assert len(spark.table(tables.bronze_measurements).inputFiles()) == 2_001
    assert len(facts._arrivals(spark, tables, tables.bronze_measurements).inputFiles()) == 1
    assert len(facts._arrivals(spark, tables, tables.batch_log).inputFiles()) == 0
    pending = facts._pending(spark, tables)
    rows, count = facts._chosen(spark.table(tables.bronze_measurements), pending)
    assert count == 1 and len(rows.inputFiles()) == 1
    assert facts.transform_measurements(spark, tables, NOW) == 1
    assert facts.transform_measurements(spark, tables, NOW) == 0
    assert spark.table(tables.fact).count() == 2


def test_late_arrivals_are_found(spark, tables):
    """Written yesterday beside a load of today; a batch that goes on the day after; more
    batches than literals."""
    assert load(spark, tables, ("a", readings(1))) == 1
    late = bronze_rows(spark, [("b", 1, readings(2))]).withColumn(catalog.ARRIVED, F.current_date() - 1)
    catalog.append(late, tables.bronze_measurements)
    assert facts.pending_batches(spark, tables) == ["b"]
    again = bronze_rows(spark, [("a", 1, readings(3))]).withColumn(catalog.ARRIVED, F.current_date() + 1)
    catalog.append(again, tables.bronze_measurements)
    assert facts.transform_measurements(spark, tables, NOW) == 2
    assert sorted(r.batch_id for r in spark.table(tables.fact).collect()) == ["a", "a", "b"]
    assert facts.pending_batches(spark, tables) == []


def test_a_load_does_not_shuffle_the_fact(spark, tables):
    """Above the scan of the fact there is no exchange, also where the keys are too many to broadcast."""
    load(spark, tables, ("a", readings(*range(30))))
    incoming = spark.table(tables.fact).select(*schemas.FACT_KEY).withColumn(
        "measurement_datetime_from_utc", F.explode(F.array("measurement_datetime_from_utc", F.lit(NOW)))
    )
    found = upsert.present_readings(spark.table(tables.fact), incoming.hint("merge"))
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = upsert.present_readings(spark.table(tables.fact), incoming)._jdf.queryExecution().executedPlan()
        join = next(p for p in _nodes(plan) if "Join" in p.nodeName())
        fact_side = _nodes(join.children().apply(0))
        assert not any("Exchange" in p.nodeName() for p in fact_side)
        assert any("Bucketed: true" in p.verboseString(1000) for p in fact_side)
        assert found.distinct().count() == 30
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def _nodes(plan):
    found = [plan]
    for at in range(plan.children().size()):
        found += _nodes(plan.children().apply(at))
    return found


def test_present_readings_match_as_in_a_merge(spark, tables):
    """Against the general insert-only merge, with NULL keys, copies and a hot key."""
    undated = {**measurement(NOW, 3.0), "period": None}
    load(spark, tables, ("a", readings(*range(20)) + [undated]))
    rows = bronze_rows(spark, [("b", 1, readings(*range(10, 40)) + [undated] * 3 + readings(*[50] * 200)), ("c", None, readings(1))])
    catalog.append(rows, tables.bronze_measurements)
    staged = facts.stage(spark.table(tables.bronze_measurements).where("batch_id <> 'a'"), tables, "x", NOW)
    fact = spark.table(tables.fact)
    incoming = staged.select(*schemas.FACT_KEY, "value", "batch_id")
    expected = sorted(map(str, upsert.new_readings(fact, incoming).collect()))
    assert sorted(map(str, upsert.absent_readings(fact, incoming).collect())) == expected
    assert len(expected) == 20 + 3 + 200 + 1


def test_daily_statistics_follow_the_days_touched(spark, tables, monkeypatch):
    """A run that adds one day reads and replaces that day, and equals the full recompute."""
    load(spark, tables, ("a", readings(*range(0, 24 * 20, 6))))
    facts.build_daily(spark, tables, AS_OF)
    load(spark, tables, ("b", readings(24 * 3 + 1, 24 * 3 + 2, value=9.0)))
    first_day = F.lit(AS_OF - timedelta(days=30))
    changes = facts.changed_days(spark, tables, first_day)
    assert [r[catalog.FACT_DAY] for r in changes.collect()] == [date(2024, 1, 28)]
    replaced = []
    real = catalog.replace_partitions
    with monkeypatch.context() as patch:
        patch.setattr(
            catalog, "replace_partitions", lambda df, table: (replaced.append(df.select("day_start").distinct().collect()), real(df, table))
        )
        facts.build_daily(spark, tables, AS_OF)
    assert [[r.day_start for r in days] for days in replaced] == [[date(2024, 1, 28)]]
    followed = contents(spark, tables.daily)
    assert facts.changed_days(spark, tables, first_day).isEmpty()
    facts.build_daily(spark, tables, AS_OF, everything=True)
    assert contents(spark, tables.daily) == followed


def test_a_day_outside_the_window_stays_changed(spark, tables):
    load(spark, tables, ("a", readings(0, 24 * 60)))
    facts.build_daily(spark, tables, AS_OF)
    assert spark.table(tables.daily).count() == 1
    facts.build_daily(spark, tables, AS_OF - timedelta(days=50))
    assert spark.table(tables.daily).count() == 2


def test_two_loads_cannot_run_at_once(spark, tables, monkeypatch):
    """B begins while A is appending: B is refused, A commits, then B's batch is loaded."""
    real, refused = facts.append_facts, []

    def append_and_let_another_begin(staged, names, run_ts, load_id):
        real(staged, names, run_ts, load_id)
        if not refused:
            catalog.append(bronze_rows(spark, [("b", 1, readings(1, 2, 3))]), tables.bronze_measurements)
            with pytest.raises(facts.LoadConflict, match="under way"):
                refused.append(load_id)
                facts.transform_measurements(spark, tables, NOW)

    with monkeypatch.context() as patch:
        patch.setattr(facts, "append_facts", append_and_let_another_begin)
        assert load(spark, tables, ("a", readings(1, 2))) == 1
    assert facts.transform_measurements(spark, tables, NOW) == 1
    assert spark.table(tables.fact).count() == 3 and facts.open_loads(spark, tables).isEmpty()


def test_three_loads(spark, tables, monkeypatch):
    """C takes A for dead and undoes it while A lives: A may not commit, nothing is lost or doubled."""
    real, undone = facts.append_facts, []

    def append_and_be_undone(staged, names, run_ts, load_id):
        real(staged, names, run_ts, load_id)
        if not undone:
            undone.append(load_id)
            catalog.append(bronze_rows(spark, [("c", 1, readings(5))]), tables.bronze_measurements)
            assert facts.transform_measurements(spark, tables, NOW, stale_after=timedelta(0)) == 2

    with monkeypatch.context() as patch:
        patch.setattr(facts, "append_facts", append_and_be_undone)
        with pytest.raises(facts.LoadConflict, match="undone"):
            load(spark, tables, ("a", readings(1, 2)))
    assert facts.transform_measurements(spark, tables, NOW) == 0
    assert sorted(r.batch_id for r in spark.table(tables.fact).collect()) == ["a", "a", "c"]
    facts.build_daily(spark, tables, AS_OF)
    assert spark.table(tables.daily).agg(F.sum("reading_count")).first()[0] == 3


def test_a_stream_and_a_load(spark, tables, tmp_path, monkeypatch):
    """A batch load under way stops an epoch with a clear error; the stream then goes on."""
    catalog.append(bronze_rows(spark, [("a", 1, readings(1, 2))]), tables.bronze_measurements)
    facts._note(spark, tables, "another", "started")
    with pytest.raises(Exception, match="under way"):
        stream_facts(spark, tables, str(tmp_path / "s"), NOW, AS_OF)
    assert spark.table(tables.fact).count() == 0
    facts.undo(spark, tables, "another")
    stream_facts(spark, tables, str(tmp_path / "s"), NOW, AS_OF)
    assert spark.table(tables.fact).count() == 2
    assert facts.transform_measurements(spark, tables, NOW) == 0
