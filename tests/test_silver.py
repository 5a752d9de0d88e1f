from datetime import datetime, timezone

import pytest

from gaugeline import schemas
from gaugeline.operators import silver

RUN = datetime(2024, 2, 1, tzinfo=timezone.utc)
GOOD = (
    '{"value": 1.5, "unit": "ppm", "extra": [1], "parameter": {"id": 7, "name": "o3"}, "period": '
    '{"datetimeFrom": {"utc": "2024-01-01T00:00:00Z"}, "datetimeTo": {"utc": "2024-01-01T02:00:00+01:00"}}}'
)
BAD_TIME = '{"value": 2, "period": {"datetimeFrom": {"utc": "yesterday"}}}'


def batch(batch_id, payload, parameter_id="3"):
    at = "2024-02-01T00:00:00+00:00"
    return (batch_id, 1, parameter_id, 2, "PT", at, at, None, 1, payload)


@pytest.fixture(scope="module")
def bronze(spark):
    rows = [
        batch("normal", f"[{GOOD}, {GOOD}]"),
        batch("empty", "[]"),
        batch("null", None),
        batch("truncated", f"[{GOOD}, {GOOD[:30]}"),
        batch("object", GOOD),
        batch("null element", f"[null, {GOOD}]"),
        batch("wrong type", '[{"value": "high", "unit": "ppm"}]'),
        batch("no parameter", f"[{BAD_TIME}]"),
        batch("text parameter", f"[{GOOD}, {BAD_TIME}]", "pm10"),
    ]
    return spark.createDataFrame(rows, schemas.BRONZE_MEASUREMENTS)


def by_batch(df):
    found = {}
    for row in df.collect():
        found.setdefault(row.batch_id, []).append(row)
    return found


def test_explode(bronze):
    staged = silver.explode_batches(bronze, RUN)
    assert staged.schema.simpleString() == schemas.STAGING.simpleString()
    found = by_batch(staged)
    counts = {k: len(v) for k, v in found.items()}
    assert counts == {
        "normal": 2, "object": 1, "null element": 2, "wrong type": 1, "no parameter": 1,
        "text parameter": 2,
    }
    row = found["normal"][0]
    assert (row.parameter_id, row.parameter_name, row.value, row.unit) == (7, "o3", 1.5, "ppm")
    hours = row.measurement_datetime_to_utc - row.measurement_datetime_from_utc
    assert hours.total_seconds() == 3600
    assert "extra" not in row.raw_json and row.raw_json.startswith('{"value":1.5')
    assert [r.value for r in found["wrong type"]] == [None]
    assert [r.parameter_id for r in found["no parameter"]] == [3]
    assert found["no parameter"][0].measurement_datetime_from_utc is None
    assert sorted(str(r.parameter_id) for r in found["text parameter"]) == ["7", "None"]


def test_fact_columns(bronze):
    fact = silver.to_fact(silver.explode_batches(bronze, RUN), RUN)
    assert fact.schema.simpleString() == schemas.FACT.simpleString()


def test_rejects_are_counted(bronze):
    payloads = {r.batch_id: r.rejected_payloads for r in silver.payload_rejects(bronze).collect()}
    assert {k for k, n in payloads.items() if n} == {"null", "truncated"}
    staged = silver.explode_batches(bronze, RUN)
    instants = {r.batch_id: r.rejected_instants for r in silver.instant_rejects(staged).collect()}
    assert instants["normal"] == 0 and instants["no parameter"] == 1


def test_unprocessed_batches(spark):
    bronze = spark.createDataFrame([("a", 1), ("b", 2), (None, 3), ("c", 4)], "batch_id string, v int")
    done = spark.createDataFrame([("a",), ("a",), (None,), ("z",)], "batch_id string")
    left = silver.unprocessed_batches(bronze, done).collect()
    assert sorted(r.v for r in left) == [2, 3, 4]
    assert silver.distinct_batches(done).count() == 3
