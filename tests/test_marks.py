"""Marks of the last window of every country, beside the maximum over the whole run log."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from gaugeline import schemas
from gaugeline.operators import planning
from gaugeline.plans import facts
from gaugeline.sources import catalog

DAY = date(2024, 3, 1)


def log(spark, tables, day, *windows, kind="ingest"):
    """Log (country, day number of the window) as written on ``day``."""
    stamp = lambda n: f"2024-01-{n:02d}T00:00:00+00:00"
    rows = [("r", kind, c, stamp(n), stamp(n + 1), day) for c, n in windows]
    names = schemas.RUN_LOG.fieldNames()
    given = spark.createDataFrame(
        rows,
        "run_id string, kind string, country_code string, ingestion_window_datetime_from string, "
        "ingestion_window_datetime_to string, arrived_on date",
    )
    missing = [F.lit(None).cast(schemas.RUN_LOG[n].dataType).alias(n) for n in names if n not in given.columns]
    catalog.append(given.select("*", *missing).coalesce(1), tables.run_log)


def marks(spark, tables):
    return sorted(map(tuple, planning.high_water_mark(facts.windows_seen(spark, tables)).collect()), key=str)


def by_whole_log(spark, tables):
    whole = spark.table(tables.run_log).where("kind = 'ingest'")
    return sorted(map(tuple, planning.high_water_mark(whole).collect()), key=str)


@pytest.fixture
def on(monkeypatch):
    return lambda day: monkeypatch.setattr(facts, "_today", lambda: day)


def test_nothing_logged(spark, tables, on):
    on(DAY)
    facts.fold_marks(spark, tables)
    assert marks(spark, tables) == []


def test_equal_to_the_whole_log(spark, tables, on):
    """Older windows logged later, countries that come and go, no country, loads, days without a fold."""
    days = [
        [("PT", 1), ("ES", 1)],
        [("PT", 2), (None, 1)],
        [("ES", 9)],
        [("ES", 3), ("FR", 1)],
        [("PT", 2), ("FR", 5), ("PT", 4)],
    ]
    for number, windows in enumerate(days):
        day = DAY + timedelta(days=3 * number)
        on(day)
        log(spark, tables, day, *windows)
        log(spark, tables, day, ("PT", 30), kind="load")
        assert marks(spark, tables) == by_whole_log(spark, tables)
        if number != 1:
            facts.fold_marks(spark, tables)
        assert marks(spark, tables) == by_whole_log(spark, tables)
    kept = spark.table(tables.window_marks).collect()
    assert sorted(str(r.country_code) for r in kept) == ["ES", "FR", "None", "PT"]
    assert {r.folded_on for r in kept} == {day}


def test_seen_late(spark, tables, on):
    """What another writer logged yesterday or after the fold of the day counts as well."""
    on(DAY)
    log(spark, tables, DAY, ("PT", 1))
    facts.fold_marks(spark, tables)
    log(spark, tables, DAY - timedelta(days=1), ("ES", 2))
    log(spark, tables, DAY, ("PT", 3))
    assert marks(spark, tables) == by_whole_log(spark, tables)
    facts.fold_marks(spark, tables)
    assert spark.table(tables.window_marks).count() == 1
    on(DAY + timedelta(days=1))
    facts.fold_marks(spark, tables)
    assert spark.table(tables.window_marks).count() == 2
    assert marks(spark, tables) == by_whole_log(spark, tables)


def test_history_is_not_opened(spark, tables, on):
    for back in range(12, 1, -1):
        log(spark, tables, DAY - timedelta(days=back), ("PT", 20 - back))
    on(DAY)
    facts.fold_marks(spark, tables)
    log(spark, tables, DAY, ("PT", 25))
    assert len(spark.table(tables.run_log).inputFiles()) == 12
    assert len(facts.windows_seen(spark, tables).inputFiles()) == 2
    assert marks(spark, tables) == by_whole_log(spark, tables)
