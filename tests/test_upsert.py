import random
from collections import Counter
from datetime import datetime, timezone

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from gaugeline import schemas
from gaugeline.operators import joins, upsert

SCHEMA = "k int, j int, v string, c string"


def rows_of(df):
    return Counter(map(tuple, df.collect()))


def model(target, source, update, when=lambda t, s: True):
    """The merge rules, row by row: (k, j) is the key, NULL never matches."""

    def matches(t, s):
        return None not in t[:2] and t[:2] == s[:2]

    out = []
    for t in target:
        hits = [s for s in source if matches(t, s) and when(t, s)] if update else []
        assert len(hits) <= 1
        out.append(t[:2] + hits[0][2:] if hits else t)
    out += [s for s in source if not any(matches(t, s) for t in target)]
    return Counter(out)


def differs(t, s):
    return None not in (t[3], s[3]) and t[3] != s[3]


def column_differs(t, s):
    return (t("c") != s("c")) & s("c").isNotNull()


@pytest.mark.parametrize("seed, hot_rows", [(1, 1_000_000), (2, 2)])
def test_against_model(spark, monkeypatch, seed, hot_rows):
    """With and without keys that count as hot; NULL is the hottest."""
    monkeypatch.setattr(joins, "HOT_ROWS", hot_rows)
    rnd = random.Random(seed)
    key = lambda: rnd.choice([None, *range(30)])
    text = lambda: rnd.choice([None, "p", "q"])
    # Target keys repeat; source keys repeat only where the target lacks them.
    target = [(key(), rnd.randrange(2), text(), text()) for _ in range(60)]
    held = {t[:2] for t in target}
    seen, source = set(), []
    for _ in range(90):
        row = (key(), rnd.randrange(3), text(), text())
        if row[:2] not in held or row[:2] not in seen:
            source.append(row)
            seen.add(row[:2])
    target += [(5, 0, "h", "p")] * 20
    source = [r for r in source if r[:2] != (5, 0)] + [(5, 0, "i", "q")]
    source += [(77, 0, "h", "p")] * 20
    t, s = spark.createDataFrame(target, SCHEMA), spark.createDataFrame(source, SCHEMA)
    keys = ["k", "j"]
    assert rows_of(upsert.upsert(t, s, keys)) == model(target, source, True)
    merged = upsert.upsert(t, s, keys, unique_keys=True)
    assert rows_of(merged) == model(target, source, True)
    assert rows_of(upsert.upsert(t, s, keys, set_cols=[])) == model(target, source, False)
    conditional = upsert.upsert(t, s, keys, when=column_differs)
    assert rows_of(conditional) == model(target, source, True, differs)
    merged = upsert.upsert(t, s, keys, when=column_differs, unique_keys=True)
    assert rows_of(merged) == model(target, source, True, differs)


@pytest.mark.parametrize("hot_rows, unique", [(1, False), (1_000_000, False), (1, True)])
def test_several_source_rows_for_one_target_row(spark, monkeypatch, hot_rows, unique):
    monkeypatch.setattr(joins, "HOT_ROWS", hot_rows)
    t = spark.createDataFrame(
        [(1, 0, "old", "p"), (1, 0, "old", "p"), (2, 0, "old", "p"), (3, 0, "old", None)], SCHEMA
    )
    s = spark.createDataFrame(
        [
            (1, 0, "a", "p"),  # would not change anything
            (1, 0, "b", "q"),  # the one row that would
            (2, 0, "c", "p"),
            (2, 0, "d", "p"),
            (3, 0, "e", "p"),
            (3, 0, "f", "q"),
        ],
        SCHEMA,
    )
    kept = upsert.upsert(t, s, ["k", "j"], when=column_differs, unique_keys=unique)
    assert rows_of(kept) == Counter(
        {(1, 0, "b", "q"): 2, (2, 0, "old", "p"): 1, (3, 0, "old", None): 1}
    )
    with pytest.raises(PySparkException, match="several source rows"):
        upsert.upsert(t, s, ["k", "j"], unique_keys=unique).collect()
    s = s.unionByName(spark.createDataFrame([(1, 0, "z", "q")], SCHEMA))
    with pytest.raises(PySparkException, match="several source rows"):
        upsert.upsert(t, s, ["k", "j"], when=column_differs, unique_keys=unique).collect()


def test_deduplicate_is_opt_in_and_keeps_null_keys(spark):
    t = spark.createDataFrame([(9, 0, "x", "x")], SCHEMA)
    s = spark.createDataFrame(
        [(1, 0, "a", "p"), (1, 0, "b", "p"), (None, 0, "n", "p"), (None, 0, "n", "p")], SCHEMA
    )
    assert upsert.new_rows(t, s, ["k", "j"]).count() == 4
    deduped = upsert.new_rows(t, s, ["k", "j"], dedupe_source=True)
    assert rows_of(deduped) == Counter({(1, 0, "b", "p"): 1, (None, 0, "n", "p"): 2})


def test_insert_only_twice_adds_only_null_keys(spark):
    t = spark.createDataFrame([], SCHEMA)
    s = spark.createDataFrame([(1, 0, "a", "p"), (2, 0, "a", "p"), (None, 0, "a", "p")], SCHEMA)
    once = upsert.upsert(t, s, ["k", "j"], set_cols=[])
    twice = upsert.upsert(once, s, ["k", "j"], set_cols=[])
    assert once.count() == 3 and twice.count() == 4


def location(number, name, last):
    return (number, name, None, None, "PT", None, None, last, "b", None)


def test_locations_update_only_on_a_new_known_time(spark):
    run = datetime(2024, 1, 1, tzinfo=timezone.utc)
    dim = spark.createDataFrame(
        [
            location(1, "a", "2024-01-05"),
            location(2, "b", "2024-01-05"),
            location(3, "c", "2024-01-05"),
            location(4, "d", None),
            location(5, "e", "2024-01-05"),
            location(7, "g", "2024-01-05"),
        ],
        schemas.DIM_LOCATIONS,
    )
    incoming = spark.createDataFrame(
        [
            location(1, "A", "2024-01-05"),  # same time
            location(2, "B", "2024-01-06"),  # newer
            location(3, "C", "2024-01-04"),  # older still overwrites
            location(4, "D", "2024-01-06"),  # the dimension's time is unknown
            location(5, "E", None),  # the new time is unknown
            location(6, "F", None),  # not yet known
        ],
        schemas.DIM_LOCATIONS,
    )
    merged = {r.location_id: r for r in upsert.upsert_locations(dim, incoming, run).collect()}
    assert "".join(merged[i].name for i in range(1, 8)) == "aBCdeFg"
    stamped = {i for i, r in merged.items() if r.dim_ingested_at is not None}
    assert stamped == {2, 3, 6}


def test_values_filter_is_a_range_beyond_the_limit(spark, monkeypatch):
    source = spark.createDataFrame([(1,), (4,), (6,), (None,)], "d int")
    target = spark.range(10).select(F.col("id").cast("int").alias("d"))
    few = target.where(upsert.values_filter(source, "d"))
    assert sorted(r.d for r in few.collect()) == [1, 4, 6]
    monkeypatch.setattr(upsert, "MAX_PRUNE_VALUES", 2)
    many = target.where(upsert.values_filter(source, "d"))
    assert sorted(r.d for r in many.collect()) == [1, 2, 3, 4, 5, 6]
    empty = target.where(upsert.values_filter(source.where("d > 9"), "d"))
    assert empty.count() == 0
