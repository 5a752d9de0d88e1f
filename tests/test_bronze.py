import json
from collections import Counter
from datetime import datetime, timezone

from pyspark.sql import functions as F

from gaugeline import schemas
from gaugeline.operators import audit, bronze

RUN = datetime(2024, 2, 1, 6, 30, tzinfo=timezone.utc)


def pack(spark, documents, max_documents):
    df = spark.createDataFrame(documents, "k int, id int, v int").repartition(4)
    return bronze.pack_documents(df, ["k"], ["id"], F.struct("id", "v"), max_documents).collect()


def test_groups_that_fit_make_one_ordered_row(spark):
    rows = pack(spark, [(1, 3, 0), (1, 1, 1), (1, 2, None), (2, 5, 5)], 3)
    payloads = {r.k: (r.rows_fetched, r.api_payload) for r in rows}
    assert payloads == {
        1: (3, '[{"id":1,"v":1},{"id":2},{"id":3,"v":0}]'),
        2: (1, '[{"id":5,"v":5}]'),
    }


def test_large_groups_split_without_loss(spark):
    """One key and NULL hold most documents; some documents share an identity."""
    documents = [(1, i, i) for i in range(900)] + [(None, i, i) for i in range(300)]
    documents += [(2, 7, i) for i in range(50)] + [(3, 0, 0)]
    rows = pack(spark, documents, 20)
    assert max(r.rows_fetched for r in rows) <= 20
    unpacked = Counter(
        (r.k, d["id"], d["v"]) for r in rows for d in json.loads(r.api_payload)
    )
    assert unpacked == Counter(documents)
    assert all(r.rows_fetched == len(json.loads(r.api_payload)) for r in rows)
    assert sum(1 for r in rows if r.k == 3) == 1


def test_groups_are_cut_in_order_at_any_size(spark):
    """Sizes around the limit, one group over all ranges, copies of one document."""
    documents = [(k, i, -i) for k, n in ((1, 19), (2, 20), (3, 21), (4, 40), (None, 1_203)) for i in range(n)]
    documents += [(5, 7, 7)] * 131
    rows = pack(spark, documents, 20)
    groups = {}
    for row in rows:
        found = json.loads(row.api_payload)
        groups.setdefault(row.k, []).append([(d["id"], d["v"]) for d in found])
    for k, parts in groups.items():
        expected = sorted((i, v) for key, i, v in documents if key == k)
        parts.sort(key=lambda part: (part[0], -len(part)))
        assert parts == [expected[at : at + 20] for at in range(0, len(expected), 20)]
    assert set(groups) == {1, 2, 3, 4, 5, None}


def test_no_documents_no_row(spark):
    assert pack(spark, [], 20) == []


def test_stamps(spark):
    df = spark.createDataFrame(
        [(1, 2, 3, "PT", 4, "[]")],
        "sensor_id int, parameter_id int, location_id int, country_code string, "
        "rows_fetched int, api_payload string",
    )
    stamped = bronze.stamp_measurements(df, "b", RUN, F.lit("from"), F.lit("to"))
    assert stamped.schema.simpleString() == schemas.BRONZE_MEASUREMENTS.simpleString()
    assert tuple(stamped.first()) == (
        "b", 1, "2", 3, "PT", "2024-02-01T06:30:00+00:00", "from", "to", 4, "[]",
    )
    counted = audit.batch_audit(stamped.unionByName(stamped)).first()
    assert tuple(counted) == ("b", 2, 8)
