import math
import random
from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.errors import PySparkException

from gaugeline import schemas
from gaugeline.operators import daily, upsert

DAY = datetime(2024, 1, 10, tzinfo=timezone.utc)


def reading(sensor, value, at, location=1, parameter=7):
    return (sensor, location, "PT", parameter, "o3", value, "ppm", at, at, "b", None, None)


def facts(spark, rows):
    return spark.createDataFrame(rows, schemas.FACT)


def test_statistics_of_a_day(spark):
    rnd = random.Random(5)
    numbers = [round(rnd.uniform(0, 100), 3) for _ in range(30)]
    rows = [reading(1, v, DAY + timedelta(minutes=i)) for i, v in enumerate(numbers)]
    rows += [reading(2, 4.5, DAY), reading(3, None, DAY), reading(3, 2.0, DAY)]
    stats = daily.daily_stats(facts(spark, rows))
    assert stats.schema.simpleString() == schemas.DAILY.simpleString()
    found = {r.sensor_id: r for r in stats.collect()}
    one = found[1]
    mean = sum(numbers) / 30
    deviation = math.sqrt(sum((v - mean) ** 2 for v in numbers) / 30)
    ordered = sorted(numbers)
    assert one.avg_value == pytest.approx(mean) and one.stddev_value == pytest.approx(deviation)
    assert (one.min_value, one.max_value) == (ordered[0], ordered[-1])
    assert (one.perc95_value, one.perc05_value) == (ordered[28], ordered[1])
    assert (one.reading_count, one.completeness_ratio) == (30, 1.25)
    assert (found[2].stddev_value, found[2].completeness_ratio) == (0.0, 0.041667)
    assert (found[3].reading_count, found[3].avg_value) == (2, 2.0)


def test_day_and_trailing_bounds(spark):
    second = timedelta(seconds=1)
    first = datetime(2024, 1, 11, tzinfo=timezone.utc)
    rows = [
        reading(1, 1.0, first - second),
        reading(1, 1.0, first),
        reading(1, 1.0, first + timedelta(days=1) - second),
        reading(1, 1.0, first + timedelta(days=1)),
        reading(1, 1.0, first + timedelta(days=90)),
        reading(1, 1.0, None),
    ]
    recent = daily.trailing_days(facts(spark, rows), as_of=date(2024, 2, 10))
    counts = {r.day_start: r.reading_count for r in daily.daily_stats(recent).collect()}
    assert counts == {date(2024, 1, 11): 2, date(2024, 1, 12): 1, date(2024, 4, 10): 1}


def test_moved_sensor(spark):
    """Two places on one day give two source rows for one key."""
    current = daily.daily_stats(facts(spark, [reading(1, 1.0, DAY), reading(9, 1.0, DAY)]))
    moved = daily.daily_stats(
        facts(spark, [reading(1, 2.0, DAY), reading(1, 3.0, DAY, location=2), reading(2, 1.0, DAY)])
    )
    with pytest.raises(PySparkException, match="several source rows"):
        upsert.upsert_daily(current, moved).collect()
    # A key the table lacks takes all its rows; a changed place is kept as it was.
    assert upsert.upsert_daily(current.where("sensor_id = 9"), moved).count() == 4
    elsewhere = daily.daily_stats(facts(spark, [reading(1, 5.0, DAY, location=2)]))
    merged = {r.sensor_id: r for r in upsert.upsert_daily(current, elsewhere).collect()}
    assert (merged[1].location_id, merged[1].avg_value, merged[9].avg_value) == (1, 5.0, 1.0)


def test_percentiles_of_large_groups_are_exact(spark):
    """Some 60,000 values a group, far beyond what a sketch keeps; places may be NULL."""
    rnd = random.Random(11)
    numbers = [[rnd.random() ** 3 for _ in range(60_001)] for _ in range(2)]
    numbers.append([float(rnd.randrange(4)) for _ in range(60_001)])
    rows = [(i, v) for i, part in enumerate(numbers) for v in part] + [(0, None), (7, 5.0)]
    fact = spark.createDataFrame(rows, "sensor_id int, value double").repartition(7).selectExpr(
        "sensor_id", "if(sensor_id = 1, null, 4) AS location_id", "cast(null AS string) AS country_code",
        "7 AS parameter_id", "'o3' AS parameter_name", "value",
        "timestamp '2024-01-10 05:00:00' AS measurement_datetime_from_utc",
    )
    found = {r.sensor_id: r for r in daily.daily_stats(fact).collect()}
    assert len(found) == 4 and (found[7].perc95_value, found[7].perc05_value) == (5.0, 5.0)
    for i, part in enumerate(numbers):
        ordered = sorted(part)
        exact = tuple(ordered[(60_001 * percent + 99) // 100 - 1] for percent in (95, 5))
        assert (found[i].perc95_value, found[i].perc05_value) == exact
    assert found[0].reading_count == 60_002 and found[1].location_id is None
