from datetime import datetime, timedelta, timezone

from hypothesis import given, settings
from hypothesis import strategies as st

from gaugeline.operators import planning

NOW = datetime(2024, 1, 31, tzinfo=timezone.utc)
CAP = NOW - timedelta(hours=2)


def windows(spark, lasts):
    """{code: last end} to {code: (from, to)} of the windows planned."""
    rows = [(c, t and t.isoformat()) for c, t in lasts.items()]
    marks = spark.createDataFrame(rows, "country_code string, last_to string")
    planned = planning.ingest_window(marks, NOW).collect()
    utc = lambda t: t.astimezone(timezone.utc)
    return {r.country_code: (utc(r.window_from), utc(r.window_to)) for r in planned}


def test_window_cases(spark):
    hour = timedelta(hours=1)
    lasts = {
        "none": None,
        "at cap": CAP,
        "ahead": CAP + hour,
        "short gap": CAP - 3 * hour,
        "eight": CAP - 8 * hour,
        "long gap": CAP - 100 * hour,
        "fraction": CAP - timedelta(microseconds=1),
    }
    assert windows(spark, lasts) == {
        "none": (CAP - 4 * hour, CAP),
        "short gap": (CAP - 3 * hour, CAP),
        "eight": (CAP - 8 * hour, CAP),
        "long gap": (CAP - 100 * hour, CAP - 92 * hour),
        "fraction": (CAP - timedelta(microseconds=1), CAP),
    }


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(-10**11, 10**12), min_size=1, max_size=50))
def test_windows_abut_and_keep_to_their_bounds(spark, gaps):
    lasts = {str(i): CAP - timedelta(microseconds=g) for i, g in enumerate(gaps)}
    planned = windows(spark, lasts)
    assert set(planned) == {c for c, last in lasts.items() if last < CAP}
    for code, (start, end) in planned.items():
        assert start == lasts[code] and start < end <= CAP
        assert end - start <= timedelta(hours=8)
        assert end == CAP or end - start == timedelta(hours=8)


def bronze_windows(spark, rows):
    return spark.createDataFrame(
        rows,
        "country_code string, ingestion_window_datetime_from string, "
        "ingestion_window_datetime_to string",
    )


def test_high_water_mark(spark):
    seen = bronze_windows(
        spark,
        [
            ("PT", "2024-01-01T00:00:00+00:00", "2024-01-01T08:00:00+00:00"),
            ("PT", "2024-01-01T08:00:00+00:00", "2024-01-01T09:00:00.500000+00:00"),
            ("PT", "2024-01-01T08:00:00+00:00", "2024-01-01T09:00:00+00:00"),
            ("PT", None, None),
            ("ES", "2024-01-01T00:00:00+00:00", None),
        ],
    )
    marks = {r.country_code: (r.last_from, r.last_to) for r in planning.high_water_mark(seen).collect()}
    assert marks == {
        "PT": ("2024-01-01T08:00:00+00:00", "2024-01-01T09:00:00.500000+00:00"),
        "ES": ("2024-01-01T00:00:00+00:00", None),
    }


def test_fetch_plan(spark):
    locations = spark.createDataFrame(
        [(1, "PT"), (2, "ES"), (3, None)], "location_id int, country_code string"
    )
    sensors = spark.createDataFrame(
        [(10, 1, 7), (11, 1, 8), (20, 2, 7), (30, 3, 7), (40, 4, 7), (50, None, 7)],
        "sensor_id int, location_id int, parameter_id int",
    )
    up_to_date = bronze_windows(spark, [("ES", "x", NOW.isoformat())])
    windows_ = planning.country_windows(locations, up_to_date, NOW)
    known = planning.sensors_in_country(sensors, locations)
    assert sorted(r.sensor_id for r in known.collect()) == [10, 11, 20, 30]
    plan = planning.fetch_plan(known, windows_).collect()
    assert sorted(r.sensor_id for r in plan) == [10, 11]
    one = planning.sensors_in_country(sensors, locations, "ES").collect()
    assert [tuple(r) for r in one] == [(20, 2, 7, "ES")]
