from datetime import date

import pytest

from gaugeline import schemas
from gaugeline.operators import alerts
from gaugeline.sources import limits

TODAY = date(2024, 1, 15)


def day(sensor, parameter, mean, country="PT", location=1, on=TODAY):
    return (sensor, location, country, parameter, "p", on, mean, *[None] * 5, 1, None)


def run(spark, rows):
    dims = spark.createDataFrame([(1, "here"), (1, "here")], "location_id int, name string")
    stats = spark.createDataFrame(rows, schemas.DAILY)
    found = alerts.breaches(stats, dims, limits.limits(spark), TODAY)
    return found.collect(), alerts.alert_state(found).first()


@pytest.mark.parametrize(
    "rows, breaches, counted, state",
    [
        ([], 0, 0, "OK"),
        ([day(1, 1, 45.0)], 0, 0, "OK"),  # equal to the limit
        ([day(1, 1, 45.1)], 1, 1, "OK"),
        ([day(1, 1, 45.1), day(2, 2, 20.5)], 2, 2, "TRIGGERED"),
        ([day(1, 1, 45.1), day(2, 2, 20.5, country=None)], 2, 1, "OK"),
        ([day(1, 99, 9e9), day(2, None, 9e9)], 0, 0, "OK"),  # no limit
        ([day(1, 1, 99.0, on=date(2024, 1, 14)), day(1, 1, None)], 0, 0, "OK"),
        ([day(1, 1, 50.0), day(2, 1, 50.0)], 1, 1, "OK"),  # equal rows count once
        ([day(1, 1, 50.0, location=8), day(2, 1, 51.0)], 2, 2, "TRIGGERED"),
    ],
)
def test_alert(spark, rows, breaches, counted, state):
    found, result = run(spark, rows)
    assert len(found) == breaches
    assert (result.breach_count, result.state) == (counted, state)
    assert {r.location_name for r in found if r.location_id == 8} <= {None}
