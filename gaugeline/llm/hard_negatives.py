"""Hard negatives of anchors by bounds along a spanning tree.

Anchors of one label are joined to spanning trees of at most ``TREE`` by short edges. A
candidate x whose score with a parent anchor p lies between lo and hi has, by the
inequality of Cauchy and Schwarz, a score between lo - |a - p| |x| and hi + |a - p| |x|
with the child a. Only candidates whose bounds reach into a window that is still open are
scored with a; the others pass their wider bounds on. Roots are scored with everything.

The candidates stay where they are: every task reads its rows once for a group of
trees, whose bytes are bounded and which is broadcast, and keeps the best few for each
anchor. Groups follow each other. What tasks have kept meets in a ranking by anchor.

Vectors are scaled and rounded down to integers, so scores are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gaugeline.session import materialise, scratch_dir

TREE = 512
CHUNK = 4_096
GROUP_BYTES = 32 << 20  # vectors of the anchors that are broadcast together
LOWEST = -(1 << 62)
KEY = ["tree", "pos"]


def vectors(batch: pa.RecordBatch, scale: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, labels, integer vectors) of the rows that take part."""
    named = batch.column("vec_id").is_valid().to_numpy(zero_copy_only=False)
    named &= batch.column("label").is_valid().to_numpy(zero_copy_only=False)
    named &= batch.column("embedding").is_valid().to_numpy(zero_copy_only=False)
    rows = batch.filter(pa.array(named))
    lists = rows.column("embedding")
    counts = np.diff(lists.offsets.to_numpy()) if len(lists) else np.empty(0, np.int64)
    values = np.asarray(lists.flatten().to_numpy(zero_copy_only=False), np.float64)
    found = np.zeros((len(lists), int(counts.max(initial=0))))
    found[np.arange(found.shape[1]) < counts[:, None]] = np.floor(scale * values)
    whole = np.isfinite(found).all(1)
    ids = rows.column("vec_id").to_numpy().astype(np.int64)
    labels = rows.column("label").to_numpy().astype(np.int64)
    return ids[whole], labels[whole], found[whole]


def spanning_tree(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, parent's place in that order, edge length): a least spanning tree.

    The root comes first and is its own parent; every parent comes before its children.
    """
    n = len(points)
    near, parent = np.full(n, np.inf), np.zeros(n, np.int64)
    left, at = np.ones(n, bool), 0
    order, ups, edges, place = [], [], [], np.zeros(n, np.int64)
    for step in range(n):
        order.append(at)
        ups.append(place[parent[at]] if step else 0)
        edges.append(near[at] if step else 0.0)
        place[at], left[at] = step, False
        away = np.sqrt(((points - points[at]) ** 2).sum(1))
        closer = left & (away < near)
        near[closer], parent[closer] = away[closer], at
        at = int(np.where(left, near, np.inf).argmin()) if step + 1 < n else at
        if step + 1 < n and not left[at]:  # all that is left is infinitely far
            at = int(np.flatnonzero(left)[0])
    return np.array(order), np.array(ups), np.array(edges)


ANCHORS = "tree bigint, pos int, vec_id bigint, label bigint, vector binary, up int, edge double"


def plant(anchors: DataFrame, scale: int) -> DataFrame:
    """The anchors (vec_id, label, embedding) in trees (``ANCHORS``), parents first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            ids, labels, points = vectors(batch, scale)
            ends = np.append(np.flatnonzero(labels[1:] != labels[:-1]) + 1, len(labels)) if len(labels) else []
            start = 0
            for end in ends:
                for at in range(start, end, TREE):
                    part = slice(at, min(at + TREE, end))
                    order, ups, edges = spanning_tree(points[part])
                    n = len(order)
                    yield pa.record_batch(
                        [
                            pa.array(np.full(n, number)),
                            pa.array(np.arange(n, dtype=np.int32)),
                            pa.array(ids[part][order]),
                            pa.array(labels[part][order]),
                            pa.array([p.tobytes() for p in points[part][order]], pa.binary()),
                            pa.array(ups.astype(np.int32)),
                            pa.array(edges),
                        ],
                        [c.split()[0] for c in ANCHORS.split(", ")],
                    )
                    number += 1
                start = end

    order = ["label", "vec_id", "_from"]
    placed = anchors.withColumn("_from", F.spark_partition_id())
    placed = placed.repartitionByRange(*order).sortWithinPartitions(*order)
    return placed.select("vec_id", "label", "embedding").mapInArrow(run, ANCHORS)


class Best:
    """The first ``most`` (score, id) of many lists: higher scores first, then smaller ids."""

    def __init__(self, lists: int, most: int):
        self.scores = np.full((lists, most), LOWEST, np.int64)
        self.ids = np.zeros((lists, most), np.int64)
        self.most = most

    def put(self, at: int, scores: np.ndarray, ids: np.ndarray) -> None:
        reach = scores >= self.scores[at, -1]
        if not reach.any():
            return
        scores, ids = scores[reach], ids[reach]
        if len(scores) > self.most:
            reach = scores >= np.partition(scores, -self.most)[-self.most]
            scores, ids = scores[reach], ids[reach]
        scores, ids = np.append(self.scores[at], scores), np.append(self.ids[at], ids)
        first = np.lexsort((ids, -scores))[: self.most]
        self.scores[at], self.ids[at] = scores[first], ids[first]


def exact(rows: np.ndarray, anchor: np.ndarray, peak: float) -> np.ndarray:
    """Integer inner products; those beyond 62 bits are set to the largest kept number."""
    if len(anchor) * peak < 2**53:
        return (rows @ anchor).astype(np.int64)
    whole = [int(v) for v in anchor]
    sums = [sum(int(u) * v for u, v in zip(row, whole)) for row in rows]
    return np.array([max(LOWEST + 1, min(-LOWEST, s)) for s in sums], np.int64)


class Group:
    """Trees that are searched together, as numpy arrays: sent to every task once."""

    def __init__(self, table: pa.Table):
        table = table.sort_by([("tree", "ascending"), ("pos", "ascending")])
        take = lambda name: table.column(name).to_numpy()
        self.tree, self.pos, self.ids = take("tree"), take("pos"), take("vec_id")
        self.labels, self.up, self.edge = take("label"), take("up"), take("edge")
        width = max((len(v) for v in table.column("vector").to_pylist()), default=0) // 8
        self.points = np.zeros((len(self.ids), width))
        for at, v in enumerate(table.column("vector").to_pylist()):
            self.points[at, : len(v) // 8] = np.frombuffer(v)
        self.windows = None
        if "scores" in table.column_names:
            self.windows = [np.array(w, np.int64) for w in table.column("scores").to_pylist()]
        starts = np.flatnonzero(np.append(True, self.tree[1:] != self.tree[:-1])) if len(self.ids) else []
        self.spans = list(zip(starts, [*starts[1:], len(self.ids)]))
        self.peak = float(np.abs(self.points).max(initial=0))


def descend(group: Group, span: tuple[int, int], rows: np.ndarray, peak: float, wanted, scored) -> None:
    """Score the rows with each anchor of a tree, as far as its bounds ask for.

    ``wanted(anchor, lo, hi)`` tells which rows' bounds reach into the anchor's windows,
    ``scored(anchor, places, scores)`` takes the exact scores of those.
    """
    start, end = span
    lo = np.empty((end - start, len(rows)))
    hi = np.empty((end - start, len(rows)))
    norms = np.sqrt((rows**2).sum(1))
    for k in range(end - start):
        anchor = start + k
        if k:
            up = group.up[anchor]
            reach = group.edge[anchor] * norms
            # Room for the rounding of square roots and sums.
            reach = reach + 1e-9 * (reach + np.abs(lo[up]) + np.abs(hi[up])) + 1e-3
            lo[k], hi[k] = lo[up] - reach, hi[up] + reach
            places = np.flatnonzero(wanted(anchor, lo[k], hi[k]))
        else:
            places = np.arange(len(rows))
        if len(places):
            part = rows if len(places) == len(rows) else rows[places]
            scores = exact(part, group.points[anchor], peak)
            lo[k, places] = hi[k, places] = scores
            scored(anchor, places, scores)


FOUND = "tree bigint, pos int, place int, vec_id bigint, score bigint"


def search(
    batches: Iterator[pa.RecordBatch], group: Group, scale: int, most: int, low: int, high: int
) -> Iterator[pa.RecordBatch]:
    """The task's best rows for each list of each anchor (``FOUND``).

    Without windows: one list, other rows of the anchor's label. With windows: one list
    for each positive score p, rows of other labels of scores s with low p <= high s <= high p.
    """
    lists = max((len(w) for w in group.windows), default=1) if group.windows is not None else 1
    best = Best(len(group.ids) * lists, most)
    for batch in batches:
        for at in range(0, batch.num_rows, CHUNK):
            ids, labels, points = vectors(batch.slice(at, CHUNK), scale)
            if not len(ids):
                continue
            width = max(points.shape[1], group.points.shape[1])
            points = np.pad(points, ((0, 0), (0, width - points.shape[1])))
            if group.points.shape[1] < width:
                group.points = np.pad(group.points, ((0, 0), (0, width - group.points.shape[1])))
            peak = group.peak * float(np.abs(points).max(initial=0))
            order = np.argsort(labels, kind="stable")
            ids, labels, points = ids[order], labels[order], points[order]
            for span in group.spans:
                first, last = np.searchsorted(labels, [group.labels[span[0]], group.labels[span[0]] + 1])
                if group.windows is None:
                    _positives(group, span, ids[first:last], points[first:last], peak, best)
                else:
                    keep = np.r_[0:first, last : len(ids)]
                    _negatives(group, span, ids[keep], points[keep], peak, best, lists, low, high)
    at, k = np.nonzero(best.scores > LOWEST)
    anchor = at // lists
    yield pa.record_batch(
        [
            pa.array(group.tree[anchor]),
            pa.array(group.pos[anchor].astype(np.int32)),
            pa.array((at % lists).astype(np.int32)),
            pa.array(best.ids[at, k]),
            pa.array(best.scores[at, k]),
        ],
        [c.split()[0] for c in FOUND.split(", ")],
    )


def _positives(group, span, ids, rows, peak, best) -> None:
    if not len(ids):
        return

    def wanted(anchor, lo, hi):
        # The anchor itself may be among the rows, so one more lower bound must be passed.
        more = best.most + 1 + int(np.count_nonzero(ids == group.ids[anchor]))
        least = np.partition(lo, -more)[-more] if len(lo) >= more else -np.inf
        return hi >= max(least, best.scores[anchor, -1])

    def scored(anchor, places, scores):
        other = ids[places] != group.ids[anchor]
        best.put(anchor, scores[other], ids[places][other])

    descend(group, span, rows, peak, wanted, scored)


def _negatives(group, span, ids, rows, peak, best, lists, low, high) -> None:
    if not len(ids):
        return

    def windows(anchor):
        for k, score in enumerate(group.windows[anchor].tolist()):
            least = -((-low * score) // high)
            if least <= score:
                yield anchor * lists + k, max(least, int(best.scores[anchor * lists + k, -1])), score

    def wanted(anchor, lo, hi):
        found = np.zeros(len(ids), bool)
        for _, least, greatest in windows(anchor):
            found |= (hi >= least) & (lo <= greatest)
        return found

    def scored(anchor, places, scores):
        for at, least, greatest in windows(anchor):
            inside = (scores >= least) & (scores <= greatest)
            if inside.any():
                best.put(at, scores[inside], ids[places][inside])

    descend(group, span, rows, peak, wanted, scored)


def _over_groups(
    spark: SparkSession, rows: DataFrame, anchors: DataFrame, scale: int, most: int, low: int, high: int
) -> DataFrame:
    """``FOUND`` rows of all tasks and all groups of trees, one pass over the rows a group."""
    home, found = scratch_dir(spark, "mining-groups"), scratch_dir(spark, "mining-found")
    size = anchors.agg(F.sum(F.octet_length("vector") + 64)).first()[0] or 0
    groups = -(-size // GROUP_BYTES)
    number = F.pmod(F.xxhash64("tree"), F.lit(max(1, groups)))
    anchors.withColumn("part", number).write.partitionBy("part").parquet(home)
    parts = spark.read.schema(f"{', '.join(f'{n} {t}' for n, t in anchors.dtypes)}, part bigint").parquet(home)
    spark.createDataFrame([], FOUND).write.parquet(found)
    for part in range(groups):
        table = parts.where(F.col("part") == part).drop("part").toArrow()
        if not table.num_rows:
            continue
        sent = spark.sparkContext.broadcast(Group(table))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            return search(batches, sent.value, scale, most, low, high)

        rows.mapInArrow(run, FOUND).write.mode("append").parquet(found)
        sent.unpersist()
    return spark.read.schema(FOUND).parquet(found)


def _ranked(found: DataFrame, most: int) -> DataFrame:
    """The first ``most`` of each list, numbered from 1."""
    order = Window.partitionBy(*KEY, "place").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def mine(
    rows: DataFrame,
    is_anchor: Column,
    scale: int = 256,
    positives: int = 5,
    negatives: int = 5,
    low: int = 80,
    high: int = 100,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``rows``: vec_id, label, embedding. Components x count as floor(scale x), scores are
    inner products. An anchor's positives are its first ``positives`` other rows of its
    label by falling score, then vec_id; the negatives of a positive of score p are the
    first ``negatives`` rows of other labels with low p <= high s <= high p.

    Rows without vec_id, label or vector, or with a null or non-finite component, take no
    part. Shorter vectors end in zeros. Rows of the anchor's vec_id are never its
    positives; repeated rows count each, also as anchors. Scores beyond 62 bits count as
    the largest number of 62 bits. Other columns are ignored; no rows give no rows.
    """
    spark = rows.sparkSession
    rows = rows.select(
        F.col("vec_id").cast("bigint"), F.col("label").cast("bigint"), "embedding", is_anchor.alias("_anchor")
    )
    own = rows.where("_anchor and label is not null and embedding is not null").drop("_anchor")
    anchors = materialise(plant(own, scale), "mining-anchors")
    rows = rows.drop("_anchor")
    near = materialise(
        _ranked(_over_groups(spark, rows, anchors, scale, positives, low, high), positives), "mining-positives"
    )
    windows = near.groupBy(*KEY).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("rank", "score"))), lambda x: x["score"]).alias("scores")
    )
    far = _over_groups(spark, rows, anchors.join(windows, KEY), scale, negatives, low, high)
    chosen = near.select(
        *KEY,
        (F.col("rank") - 1).alias("place"),
        F.col("vec_id").alias("positive_id"),
        F.col("score").alias("positive_score"),
    )
    return (
        _ranked(far, negatives)
        .join(chosen, [*KEY, "place"])
        .join(anchors.select(*KEY, F.col("vec_id").alias("anchor_id")), KEY)
        .select(
            "anchor_id",
            "positive_id",
            "rank",
            F.col("vec_id").alias("negative_id"),
            "positive_score",
            F.col("score").alias("negative_score"),
        )
    )
