"""Hard negatives against scores of all pairs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from gaugeline.llm import hard_negatives

COLUMNS = "vec_id bigint, label bigint, embedding array<float>"


def brute(rows):
    kept = []
    for vec_id, label, vector in rows:
        if None in (vec_id, label, vector) or any(x is None or not math.isfinite(x) for x in vector):
            continue
        kept.append((vec_id, label, [math.floor(256 * float(np.float32(x))) for x in vector]))
    found = []
    for vec_id, label, vector in kept:
        if vec_id % 100:
            continue
        scores = [(-sum(a * b for a, b in zip(vector, other)), i, x) for i, x, other in kept]
        near = sorted((s, i) for s, i, x in scores if x == label and i != vec_id)[:5]
        far = sorted((s, i) for s, i, x in scores if x != label)
        for p, positive in near:
            inside = [(s, i) for s, i in far if 80 * -p <= 100 * -s <= 100 * -p][:5]
            found += [(vec_id, positive, rank, i, -p, -s) for rank, (s, i) in enumerate(inside, 1)]
    return sorted(found)


def mined(rows):
    return sorted(tuple(r) for r in hard_negatives.mine(rows, F.col("vec_id") % 100 == 0).collect())


@pytest.fixture(scope="module")
def odd_rows():
    """Clusters across labels, many equal vectors, nulls, short and non-finite vectors."""
    draw = np.random.default_rng(3)
    centres = draw.normal(size=(4, 6))
    rows = [
        (i, i % 3, [float(x) for x in centres[i % 4] * (1 - i % 5 / 10) + 0.05 * draw.normal(size=6)])
        for i in range(900)
    ]
    rows += [(1000 + i, 0, [0.5] * 6) for i in range(250)]
    rows += [(None, 1, [1.0] * 6), (2100, None, [1.0] * 6), (2200, 1, None), (2300, 1, [None, 1.0])]
    rows += [(2400, 2, [float("nan")] * 6), (2500, 1, []), (2600, 1, [0.3, 0.2]), (2700, -4, [-0.1] * 6)]
    return rows


def test_odd_rows(spark, odd_rows, monkeypatch):
    monkeypatch.setattr(hard_negatives, "GROUP_BYTES", 600)  # several groups
    table = spark.createDataFrame(odd_rows, COLUMNS).selectExpr("*", "1 as tree", "2 as pos", "3 as score")
    expected = brute(odd_rows)
    assert len(expected) > 100 and mined(table) == expected


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{entry.SMOKE_DIR}/embeddings.parquet").select("vec_id", "label", "embedding").collect()]
    moved = [(i, (x + 1) % 10 if i % 7 == 0 else x, v) for i, x, v in rows]
    found = entry.queries()["op11_hard_negatives"](spark, entry.SMOKE_DIR)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(tuple(r) for r in found.collect()) == brute(moved)


def test_repeated_rows_and_no_rows(spark):
    rows = [(100, 1, [1.0, 0.5])] * 2 + [(101, 1, [1.0, 0.4])] * 2 + [(102, 2, [0.9, 0.4])] * 2
    assert mined(spark.createDataFrame(rows, COLUMNS)) == brute(rows)
    assert mined(spark.createDataFrame([], COLUMNS)) == []


def test_bounds_spare_candidates():
    """Near a parent that settles the windows, far candidates are not scored again."""
    draw = np.random.default_rng(1)
    points = np.floor(256 * np.concatenate([draw.normal(size=(40, 8)) * 0.01 + 1, draw.normal(size=(400, 8)) * 0.01 - 1]))
    order, ups, edges = hard_negatives.spanning_tree(points[:40])
    assert sorted(order) == list(range(40)) and all(ups[k] < k for k in range(1, 40))
    assert np.allclose(edges[1:], np.linalg.norm(points[order[1:]] - points[order[ups[1:]]], axis=1))
    group = type("G", (), dict(up=ups, edge=edges, points=points[order]))
    scored = np.zeros(40, int)
    windows = {"wanted": lambda a, lo, hi: hi >= 0, "scored": lambda a, places, s: scored.__setitem__(a, len(places))}
    hard_negatives.descend(group, (0, 40), points, 1.0, **windows)
    assert scored[0] == 440 and (scored[1:] == 40).all()


def test_huge_components_are_exact():
    rows = np.array([[2.0**60, 3.0], [1.0, 2.0**40]])
    assert hard_negatives.exact(rows, np.array([1.0, 2.0**20]), 2.0**80).tolist() == [2**60 + 3 * 2**20, 2**60 + 1]
    assert hard_negatives.exact(rows, np.array([2.0**60, 0.0]), 2.0**120).tolist()[0] == 1 << 62
