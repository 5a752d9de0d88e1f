"""Prefix trie of conversations, by van Emde Boas recursion on depth.

Sequences of turns are cut at half their greatest depth. The prefix up to the cut gets a
name, which stands for it wherever it occurs: so the upper trie and the forests below the
cuts are independent, and all are cut on in the same round. A name is a pair of 64-bit
polynomials of the turns' hashes; that of a prefix follows from those of its two parts.
Totals go the other way: what lies below a cut is grafted onto the part above it, again
all parts of one size in one round. Depth D takes log D rounds, however many
conversations there are; parts of at most ``LEAF`` turns are cut on inside a task.

A node belongs to its smallest member. The nodes that one conversation owns are the lower
end of its path, so the totals of a subtree are the sums, over the members of its top, of
what each of them owns from there on.

No task sees a whole conversation, a whole node or all members of one: turns get their
places from a sort by ranges, members are counted before any shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeline.session import materialise

LEAF = 64
CHUNK = 4_096  # ids of members that are written out together
# Odd multipliers of the two polynomials.
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
NODE = ["depth", "a", "b"]


def ranked(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, a, b, size): turns in order from 1, their hashes and bytes of text.

    Order is by turn, null first; turns of one number by the hash of role and text.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("bigint"),
        "turn",
        F.xxhash64(role, text).alias("a"),
        F.xxhash64(F.lit(1), text, role).alias("b"),
        F.octet_length(text).cast("bigint").alias("size"),
        # Deals out a row that is repeated very often, too.
        F.spark_partition_id().alias("_from"),
    )
    order = ["conv_id", "turn", "a", "b", "_from"]

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, count = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            conv, at = batch.column("conv_id").to_numpy(), np.arange(n)
            new = np.append(last is None or conv[0] != last, conv[1:] != conv[:-1])
            start = np.maximum.accumulate(np.where(new, at, -count))
            pos = at - start + 1
            last, count = conv[-1], int(pos[-1])
            yield pa.record_batch(
                [
                    batch.column("conv_id"),
                    pa.array(np.full(n, part, np.int32)),
                    pa.array(pos.astype(np.int64)),
                    *[batch.column(c) for c in ("a", "b", "size")],
                ],
                ["conv_id", "part", "pos", "a", "b", "size"],
            )

    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = materialise(
        placed.mapInArrow(number, "conv_id bigint, part int, pos bigint, a bigint, b bigint, size bigint"),
        "trie-turns",
    )
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        numbered.groupBy("conv_id", "part")
        .agg(F.max("pos").alias("n"))
        .select("conv_id", "part", F.sum("n").over(earlier).alias("base"))
        .where("base > 0")
    )
    # A part goes on with at most one conversation, so there are fewer rows than parts.
    return numbered.join(F.broadcast(bases), ["conv_id", "part"], "left").select(
        "conv_id", (F.col("pos") + F.coalesce("base", F.lit(0))).alias("pos"), "a", "b", "size"
    )


def blocks(turns: DataFrame, leaf: int = LEAF) -> DataFrame:
    """(conv_id, block, turns): each conversation in parts of ``leaf`` turns."""
    block = ((F.col("pos") - 1) / leaf).cast("bigint")
    return (
        turns.withColumn("block", block)
        .repartition("conv_id", "block")
        .groupBy("conv_id", "block")
        .agg(F.sort_array(F.collect_list(F.struct("pos", "a", "b", "size"))).alias("turns"))
    )


def recursion(
    parts: DataFrame,
    levels: int,
    merge: Callable[[Column, Column], Column],
    nothing: Column,
    downward: bool,
) -> DataFrame:
    """(conv_id, block, state): the states of all other parts on one side, merged.

    ``parts`` are (conv_id, block, state). Two neighbours of one size make a part of twice
    the size, up to whole conversations; then each is cut in half again and both halves
    go on with what lies outside: the lower half adds the upper one if ``downward``, else
    the upper half adds the lower one.
    """
    cuts, state = [], parts
    for _ in range(levels):
        half = F.col("block") % 2
        pairs = (
            state.groupBy("conv_id", F.floor(F.col("block") / 2).alias("block"))
            .agg(
                F.max(F.when(half == 0, F.col("state"))).alias("upper"),
                F.max(F.when(half == 1, F.col("state"))).alias("lower"),
            )
            .withColumns({c: F.coalesce(c, nothing) for c in ("upper", "lower")})
        )
        cuts.append(materialise(pairs, "trie-cuts"))
        state = cuts[-1].select("conv_id", "block", merge(F.col("upper"), F.col("lower")).alias("state"))
    outside = state.select("conv_id", "block", nothing.alias("state"))
    for pairs in reversed(cuts):
        both = pairs.join(outside, ["conv_id", "block"])
        upper, lower = F.col("state"), F.col("state")
        if downward:
            lower = merge(F.col("state"), F.col("upper"))
        else:
            upper = merge(F.col("state"), F.col("lower"))
        outside = materialise(
            both.select("conv_id", (2 * F.col("block")).alias("block"), upper.alias("state")).union(
                both.select("conv_id", 2 * F.col("block") + 1, lower)
            ),
            "trie-cuts",
        )
    return outside


def _power(base: int, exponents: np.ndarray) -> np.ndarray:
    """``base`` to the power of each exponent, modulo 2**64."""
    found, factor, left = np.ones(len(exponents), np.uint64), np.uint64(base), exponents.astype(np.uint64)
    with np.errstate(over="ignore"):
        while left.any():
            found = np.where(left & np.uint64(1), found * factor, found)
            factor, left = factor * factor, left >> np.uint64(1)
    return found


def _unsigned(values) -> np.ndarray:
    return np.asarray(values, np.int64).view(np.uint64)


def joined(first: Column, second: Column) -> Column:
    """The name and length of two sequences one after the other."""

    @F.pandas_udf("a bigint, b bigint, n bigint")
    def run(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        lanes = {
            lane: (_unsigned(x[lane]) * _power(base, y["n"].to_numpy()) + _unsigned(y[lane])).view(np.int64)
            for lane, base in zip("ab", BASES)
        }
        return pd.DataFrame({**lanes, "n": x["n"] + y["n"]})

    return run(first, second)


def _matrix(lists: pa.ListArray, field: str, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(one row a list, padded with 0; which places are filled)."""
    counts = np.diff(lists.offsets.to_numpy())
    filled = np.arange(width) < counts[:, None]
    found = np.zeros(filled.shape, np.int64)
    found[filled] = lists.flatten().field(field).to_numpy()
    return found, filled


def _halved(turns: np.ndarray, start: np.ndarray, base: int) -> np.ndarray:
    """Names of the prefixes that end with each turn of each row; ``start``: those before.

    Rows have 2**k places. Parts of twice the size are named first, then every part is
    cut in half: the upper half goes on from the same prefix, the lower from the cut.
    """
    sizes, parts = [1], [turns]
    with np.errstate(over="ignore"):
        while parts[-1].shape[1] > 1:
            power = _power(base, np.array([sizes[-1]]))
            parts.append(parts[-1][:, ::2] * power + parts[-1][:, 1::2])
            sizes.append(2 * sizes[-1])
        before = start[:, None]
        for size, part in zip(sizes[-2::-1], parts[-2::-1]):
            cut = before * _power(base, np.array([size])) + part[:, ::2]
            before = np.stack([before, cut], axis=2).reshape(len(turns), -1)
        return before * np.uint64(base) + turns


def _width(lists: pa.ListArray) -> int:
    most = int(np.diff(lists.offsets.to_numpy()).max())
    return 1 << (most - 1).bit_length()


def _pieces(batches: Iterator[pa.RecordBatch], rows: int = 4_000) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The name of each block on its own."""
    for batch in _pieces(batches):
        turns = batch.column("turns")
        counts = np.diff(turns.offsets.to_numpy())
        lanes = []
        for lane, base in zip("ab", BASES):
            found, _ = _matrix(turns, lane, _width(turns))
            whole = _halved(found.view(np.uint64), np.zeros(len(found), np.uint64), base)
            lanes.append(whole[np.arange(len(found)), counts - 1].view(np.int64))
        state = pa.StructArray.from_arrays(
            [pa.array(lanes[0]), pa.array(lanes[1]), pa.array(counts.astype(np.int64))], ["a", "b", "n"]
        )
        yield pa.record_batch(
            [batch.column("conv_id"), batch.column("block"), state], ["conv_id", "block", "state"]
        )


def _prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each turn: its node and the node above."""
    for batch in _pieces(batches):
        turns, columns = batch.column("turns"), {}
        for lane, base in zip("ab", BASES):
            found, filled = _matrix(turns, lane, _width(turns))
            start = _unsigned(batch.column(f"start_{lane}").to_numpy())
            names = _halved(found.view(np.uint64), start, base)
            above = np.concatenate([start[:, None], names[:, :-1]], axis=1)
            columns[lane] = names[filled].view(np.int64)
            columns[f"up_{lane}"] = above[filled].view(np.int64)
        flat = turns.flatten()
        row = np.repeat(np.arange(batch.num_rows), np.diff(turns.offsets.to_numpy()))
        yield pa.record_batch(
            [
                batch.column("conv_id").take(pa.array(row)),
                flat.field("pos"),
                *[pa.array(columns[c]) for c in ("a", "b", "up_a", "up_b")],
                flat.field("size"),
            ],
            ["conv_id", "depth", "a", "b", "up_a", "up_b", "size"],
        )


STATE = "struct<a: bigint, b: bigint, n: bigint>"
ROWS = "conv_id bigint, depth bigint, a bigint, b bigint, up_a bigint, up_b bigint, size bigint"


def paths(turns: DataFrame, leaf: int = LEAF) -> tuple[DataFrame, int]:
    """A row for each turn (conv_id, pos, a, b, size) with its node and the one above, and
    how often conversations had to be cut before their parts had ``leaf`` turns."""
    parts = materialise(blocks(turns, leaf), "trie-blocks")
    levels = int(parts.agg(F.max("block")).first()[0] or 0).bit_length()
    nothing = F.struct(*[F.lit(0).cast("bigint").alias(c) for c in ("a", "b", "n")])
    if levels:
        long = parts.where("block > 0").select("conv_id").distinct()
        cut = parts.join(long, "conv_id", "left_semi").mapInArrow(
            _names, f"conv_id bigint, block bigint, state {STATE}"
        )
        starts = recursion(cut, levels, joined, nothing, downward=True)
        begun = parts.join(starts, ["conv_id", "block"], "left")
    else:
        begun = parts.withColumn("state", nothing)
    start = [F.coalesce(f"state.{c}", F.lit(0)).cast("bigint").alias(f"start_{c}") for c in "ab"]
    return begun.select("conv_id", "turns", *start).mapInArrow(_prefixes, ROWS), levels


def _digests(ends: DataFrame) -> DataFrame:
    """(depth, a, b, ends_sha256) of (depth, a, b, conv_id).

    Ids are written out in runs of ``CHUNK`` first, spread over tasks however many a node
    has; a hash goes through its text in order, so it takes the runs of a node one by one.
    """
    order = [*NODE, "conv_id"]

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.column_stack([batch.column(c).to_numpy() for c in NODE])
            conv = batch.column("conv_id").to_pylist()
            if not conv:
                continue
            new = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(1))).tolist() + [len(conv)]
            runs = [(k, min(k + CHUNK, end)) for at, end in zip(new, new[1:]) for k in range(at, end, CHUNK)]
            first = pa.array([k for k, _ in runs], pa.int64())
            texts = pa.array([",".join(map(str, conv[k:end])) for k, end in runs], pa.string())
            rest = [batch.column(c).take(first) for c in order]
            yield pa.record_batch([*rest, texts], [*order, "ids"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done() -> pa.RecordBatch:
            columns = [pa.array([v], pa.int64()) for v in key]
            return pa.record_batch([*columns, pa.array([digest.hexdigest()])], [*NODE, "ends_sha256"])

        key, digest = None, None
        for batch in batches:
            for *node, ids in zip(*[batch.column(c).to_pylist() for c in (*NODE, "ids")]):
                if node == key:
                    digest.update(b",")
                else:
                    if key:
                        yield done()
                    key, digest = node, hashlib.sha256()
                digest.update(ids.encode())
        if key:
            yield done()

    kinds = ", ".join(f"{c} bigint" for c in NODE)
    runs = (
        ends.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .mapInArrow(listed, f"{kinds}, conv_id bigint, ids string")
    )
    return (
        runs.repartition(*NODE)
        .sortWithinPartitions(*order)
        .mapInArrow(hashed, f"{kinds}, ends_sha256 string")
    )


NO_ENDS = hashlib.sha256(b"").hexdigest()


def trie(convs: DataFrame, turns: DataFrame, leaf: int = LEAF) -> DataFrame:
    """The trie of the sequences ``turns`` (conv_id, pos, a, b, size; pos from 1, gapless).

    ``convs`` (conv_id) names every conversation once, those without turns too. Columns:
    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256. No conversations make no nodes, not even a root.
    """
    rows, levels = paths(turns, leaf)
    zero, null = F.lit(0).cast("bigint"), F.lit(None).cast("bigint")
    tops = convs.select("conv_id", *[zero] * 3, null, null, zero)
    rows = materialise(rows.union(tops), "trie-rows")

    nodes = rows.groupBy(*NODE).agg(
        F.min("conv_id").alias("owner"),
        F.count("*").alias("n_convs"),
        F.min("up_a").alias("up_a"),
        F.min("up_b").alias("up_b"),
        F.max("size").alias("size"),
    )
    nodes = materialise(nodes, "trie-nodes")
    children = (
        nodes.where("depth > 0")
        .groupBy((F.col("depth") - 1).alias("depth"), F.col("up_a").alias("a"), F.col("up_b").alias("b"))
        .agg(F.count("*").alias("n_children"))
    )
    nodes = materialise(nodes.join(children, NODE, "left").fillna(0, ["n_children"]), "trie-nodes")

    own = nodes.select(
        F.col("owner").alias("conv_id"),
        "depth",
        ((F.col("n_convs") - 1) * F.col("size")).alias("saved"),
        (F.col("n_children") == 0).cast("bigint").alias("leaves"),
    )
    block = (F.greatest(F.col("depth") - 1, F.lit(0)) / leaf).cast("bigint")
    path = rows.join(own, ["conv_id", "depth"], "left").select(
        "conv_id", *NODE, block.alias("block"), *[F.coalesce(c, zero).alias(c) for c in ("saved", "leaves")]
    )
    onward = Window.partitionBy("conv_id", "block").orderBy(F.desc("depth"))
    onward = onward.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    path = path.repartition("conv_id", "block")
    if levels:
        path = materialise(path, "trie-path")
    inside = path.withColumns({c: F.sum(c).over(onward) for c in ("saved", "leaves")})
    if levels:
        sums = path.groupBy("conv_id", "block").agg(
            F.struct(F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves")).alias("state")
        )
        nothing = F.struct(*[zero.alias(c) for c in ("saved", "leaves")])
        below = recursion(
            sums,
            levels,
            lambda x, y: F.struct(*[(x[c] + y[c]).alias(c) for c in ("saved", "leaves")]),
            nothing,
            downward=False,
        )
        inside = inside.join(below, ["conv_id", "block"], "left").withColumns(
            {c: F.col(c) + F.coalesce(f"state.{c}", zero) for c in ("saved", "leaves")}
        )
    totals = (
        inside.where("saved > 0 or leaves > 0")
        .groupBy(*NODE)
        .agg(F.sum("saved").alias("saved_tokens"), F.sum("leaves").alias("n_leaves"))
    )

    last = rows.groupBy("conv_id").agg(F.max(F.struct(*NODE)).alias("end")).select("end.*", "conv_id")
    digests = _digests(materialise(last, "trie-ends"))
    parents = nodes.select(
        (F.col("depth") + 1).alias("depth"),
        F.col("a").alias("up_a"),
        F.col("b").alias("up_b"),
        F.col("owner").alias("parent_conv_id"),
    )
    return (
        nodes.join(totals, NODE, "left")
        .join(digests, NODE, "left")
        .join(parents, ["depth", "up_a", "up_b"], "left")
        .select(
            F.col("owner").alias("conv_id"),
            "depth",
            "parent_conv_id",
            "n_convs",
            "n_children",
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"),
        )
    )


GROUP, MOST_HEAD = 5, 9


def regrown(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conversations, turns) in which each conversation starts with another one's turns.

    Conversation c has the first h turns of c - c % 5 (fewer if that has fewer, none if it
    is absent), then its own after its first h; h = crc32 of c in decimal, modulo 9. For
    negative c the remainder is the non-negative one.
    """
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % MOST_HEAD
    first = turns.where(F.col("pos") < MOST_HEAD)
    lengths = first.groupBy("conv_id").agg(F.max("pos").alias("length"))
    donors = lengths.select(F.col("conv_id").alias("donor"), F.col("length").alias("given"))
    convs = materialise(
        lengths.select(
            "conv_id", (F.col("conv_id") - F.pmod("conv_id", F.lit(GROUP))).alias("donor"), head.alias("head")
        )
        .join(donors, "donor", "left")
        .select("conv_id", "donor", "head", F.least("head", F.coalesce("given", F.lit(0))).alias("given")),
        "trie-convs",
    )
    sources = first.where(F.pmod("conv_id", F.lit(GROUP)) == 0).withColumnRenamed("conv_id", "donor")
    given = sources.join(convs, "donor").where("pos <= given").select("conv_id", "pos", "a", "b", "size")
    # Where fewer turns were given than dropped, the rest moves up.
    moved = convs.where("given < head").select("conv_id", (F.col("head") - F.col("given")).alias("by"))
    own = (
        turns.where(F.col("pos") > head)
        .join(moved, "conv_id", "left")
        .select("conv_id", F.col("pos") - F.coalesce("by", F.lit(0)), "a", "b", "size")
    )
    return convs.select("conv_id"), given.union(own)


def conversation_trie(conversations: DataFrame, leaf: int = LEAF) -> DataFrame:
    """The trie of ``regrown`` conversations (conv_id, turn, role, text); columns of ``trie``.

    A null role or text is empty; rows without conv_id belong to no conversation. Turns of
    one number, repeated rows too, all count, in the order of ``ranked``. Other columns
    are ignored; no rows give no rows.
    """
    convs, turns = regrown(ranked(conversations))
    return trie(convs, turns, leaf)
