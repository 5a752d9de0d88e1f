import json
import os
import random
import time
from collections import Counter
from datetime import timedelta

import pytest
from pyspark.sql import functions as F
from test_plans import NOW, contents, location, measurement, page

from gaugeline.plans import dimensions, facts
from gaugeline.sources import catalog, landing
from gaugeline.streaming import pages as stream

LIMIT = 2


def documents(sensor, number, count):
    """Readings of the planned window, told apart by their values."""
    at = NOW - timedelta(hours=4)
    return [measurement(at, sensor * 1000.0 + number * 10 + i) for i in range(count)]


def feeds():
    """Full, short, failed, gapped, empty and repeated feeds, one of a single page,
    one nobody planned, and pages without sensor or number."""
    lines = []

    def add(sensor, counts, status=None):
        for number, count in enumerate(counts, 1):
            if count is not None:
                line = page(documents(sensor or 0, number, count), number, sensor_id=sensor)
                line["status"] = (status or {}).get(number, 200)
                lines.append(line)

    add(10, [2, 2, 2, 2, 2])
    add(11, [2, 2, 1, 2])
    add(12, [2, 2, 2, 2], {3: 500})
    add(13, [2, None, 2, 1])
    add(14, [0, 2])
    add(15, [1])
    add(16, [2] * 9 + [1, 2, 2])
    add(17, [None, 2])
    add(99, [2, 2])
    add(None, [2])
    lines.append(page(documents(10, 1, 2), None, sensor_id=10))
    lines.append(page(documents(10, 2, 2), 2, sensor_id=10))  # a copy
    lines.append(page(None, 6, sensor_id=10))
    return lines


def deal(folder, lines, first):
    """One file a page, in the order given; file times tell the stream the order."""
    folder.mkdir(parents=True, exist_ok=True)
    for number, line in enumerate(lines, first):
        (folder / f"p{number:03}.json").write_text(json.dumps(line) + "\n", encoding="utf-8")
        at = time.time() - 1000 + number
        os.utime(folder / f"p{number:03}.json", (at, at))


def bronze(spark, tables):
    rows = spark.table(tables.bronze_measurements).drop("batch_id", catalog.ARRIVED).collect()
    return Counter(map(tuple, rows))


@pytest.fixture
def batch(spark, tables, land, tmp_path, monkeypatch):
    """The tables of a batch run over all pages at once, beside the stream's."""
    other = catalog.Tables(f"{tables.database}_batch")
    places = land("places", [page([location(1, "PT", range(10, 18))])], "d")
    for target in (tables, other):
        catalog.ensure_all(spark, target)
        dimensions.run_dimensions(spark, target, "d", NOW, places)
    deal(tmp_path / "all" / "request=r", feeds(), 0)
    small = landing.page_prefix
    monkeypatch.setattr(landing, "page_prefix", lambda p, f, limit=LIMIT: small(p, f, LIMIT))
    facts.ingest_measurements(spark, other, "r", NOW, str(tmp_path / "all"), "PT")
    yield other
    spark.sql(f"DROP DATABASE {other.database} CASCADE")


def run(spark, tables, tmp_path, **more):
    stream.stream_pages(
        spark, tables, "r", NOW, str(tmp_path / "some"), str(tmp_path / "state"), "PT", page_limit=LIMIT, **more
    )


def test_pages_over_triggers_equal_one_batch(spark, tables, batch, tmp_path):
    """In any order, over several calls and micro-batches; the first call finds no folder."""
    lines = feeds()
    random.Random(1).shuffle(lines)
    run(spark, tables, tmp_path)
    assert bronze(spark, tables) == Counter()
    for number in range(3):
        deal(tmp_path / "some" / "request=r", lines[number * 15 : number * 15 + 15], number * 15)
        run(spark, tables, tmp_path, files_per_trigger=9, complete=number == 2)
    assert len(lines) <= 45
    assert bronze(spark, tables) == bronze(spark, batch)
    logged = ("run_id", "logged_at")
    assert contents(spark, tables.run_log, logged) == contents(spark, batch.run_log, logged)
    run(spark, tables, tmp_path, complete=True)
    assert spark.table(tables.run_log).count() == 1
    last = max((tmp_path / "state" / "waiting").iterdir(), key=lambda p: int(p.name.split("=")[1]))
    waits = {(r.sensor_id, r.page) for r in spark.read.parquet(str(last)).collect()}
    assert waits == {(13, 3), (13, 4), (17, 2)}


def test_any_order_of_pages_releases_the_prefix(spark):
    """``advance`` and ``settle`` alone, page by page, against a plain reading of the feed."""
    counts = {1: [2, 2, 2, 1, 2], 2: [2, 2, 0, 2], 3: [2] * 6}
    kept = {1: 4, 2: 2, 3: 6}
    schema = "sensor_id int, page int, status int, documents int, landed bigint"
    marks = [(s, p, 200, n, 0) for s, found in counts.items() for p, n in enumerate(found, 1)]
    random.Random(5).shuffle(marks)
    feeds = spark.createDataFrame([], stream._FEEDS)
    waiting = spark.createDataFrame([], schema)
    came = []
    for first in range(0, len(marks), 5):
        new = spark.createDataFrame(marks[first : first + 5], schema)
        released, opened = stream.advance(new.unionByName(waiting), feeds, LIMIT)
        came += [(r.sensor_id, r.page) for r in released.collect()]
        moved, waits = stream.settle(released, opened, LIMIT)
        rows = [tuple(r) for r in moved.collect()] + [tuple(r) for r in feeds.collect()]
        feeds = stream._merged(spark.createDataFrame(rows, stream._FEEDS))
        waiting = spark.createDataFrame([tuple(r) for r in waits.collect()], schema)
    assert sorted(came) == [(s, p) for s, n in kept.items() for p in range(1, n + 1)]
    assert waiting.isEmpty()
    assert {r.sensor_id: r.ended for r in feeds.collect()} == {1: True, 2: True, 3: False}


def test_a_failed_micro_batch_is_repeated(spark, tables, batch, tmp_path, monkeypatch):
    """It fails after its rows are in bronze; their number does not change."""
    deal(tmp_path / "some" / "request=r", list(reversed(feeds())), 0)

    def lost(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(stream, "settle", lost)
        with pytest.raises(Exception, match="lost"):
            run(spark, tables, tmp_path)
    assert bronze(spark, tables) == bronze(spark, batch)
    run(spark, tables, tmp_path, complete=True)
    assert bronze(spark, tables) == bronze(spark, batch)


def test_batches_of_a_stream_are_loaded_as_they_come(spark, tables, batch, tmp_path):
    """The plan stays that of the first call, though the log moves on."""
    lines = feeds()
    for number, part in enumerate((lines[::2], lines[1::2])):
        deal(tmp_path / "some" / "request=r", part, number * 40)
        run(spark, tables, tmp_path, complete=True)
        assert facts.pending_batches(spark, tables) == [stream.batch_of("r", number)]
        facts.transform_measurements(spark, tables, NOW)
    facts.transform_measurements(spark, batch, NOW)
    assert bronze(spark, tables) == bronze(spark, batch)
    windows = spark.table(tables.fact).select(F.to_timestamp("measurement_datetime_from_utc")).distinct()
    assert windows.count() == 1
