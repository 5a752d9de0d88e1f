import json

from gaugeline import schemas, session
from gaugeline.operators import dimensions

LOCATIONS = [
    {
        "id": 1, "name": "a", "locality": "x", "country": {"name": "Portugal", "code": "PT"},
        "coordinates": {"latitude": 41, "longitude": -8.5},
        "datetimeLast": {"utc": "2024-01-01T00:00:00Z"},
        "sensors": [
            {"id": 11, "name": "o3 ppm",
             "parameter": {"id": 7, "name": "o3", "units": "ppm", "displayName": "O3"}},
            {"id": 12, "name": "bare"},
        ],
    },
    {"id": 2, "name": "b", "country": None, "sensors": []},
    {"id": 3},
]


def snapshots(spark, rows):
    return spark.createDataFrame(
        [(b, t, len(docs), json.dumps(docs)) for b, t, docs in rows], schemas.BRONZE_LOCATIONS
    )


def test_flatten(spark):
    snapshot = snapshots(spark, [("b", "t", LOCATIONS)])
    locations = dimensions.flatten_locations(snapshot).orderBy("location_id")
    assert locations.schema.simpleString() == schemas.DIM_LOCATIONS.simpleString()
    found = [tuple(r)[:-1] for r in locations.collect()]
    assert found == [
        (1, "a", "x", "Portugal", "PT", 41.0, -8.5, "2024-01-01T00:00:00Z", "t"),
        (2, "b", None, None, None, None, None, None, "t"),
        (3, None, None, None, None, None, None, None, "t"),
    ]
    sensors = dimensions.flatten_sensors(snapshot).orderBy("sensor_id")
    assert sensors.schema.simpleString() == schemas.DIM_SENSORS.simpleString()
    assert [tuple(r)[:-1] for r in sensors.collect()] == [
        (11, "o3 ppm", 7, "o3", "ppm", "O3", 1, "t"),
        (12, "bare", None, None, None, None, 1, "t"),
    ]


def test_latest_snapshot_takes_all_chunks_of_the_newest(spark):
    rows = [
        ("old", "2024-01-01T00:00:00+00:00", LOCATIONS),
        ("new", "2024-01-02T00:00:00+00:00", LOCATIONS[:1]),
        ("new", "2024-01-02T00:00:00+00:00", LOCATIONS[1:]),
        ("lost", None, LOCATIONS),
    ]
    newest = dimensions.latest_snapshot(snapshots(spark, rows))
    assert sorted(r.rows_fetched for r in newest.collect()) == [1, 2]
    only = dimensions.latest_snapshot(snapshots(spark, rows[3:]))
    assert [r.batch_id for r in only.collect()] == ["lost"]
    assert dimensions.latest_snapshot(snapshots(spark, [])).count() == 0


def test_scratch_folder_follows_the_cluster_setting(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert session.scratch_dir(spark, "x").startswith(f"{shared}/gaugeline/x-")
    assert session.scratch_dir(spark, "x") != session.scratch_dir(spark, "x")
