"""Equi-joins that stay balanced when one key holds a large share of the left side.

A bounded sketch finds the left side's heaviest keys (``hot_salts``). Their left rows
are dealt over several salts (``deal``) and the right rows of just those keys are
repeated once per salt (``repeat``); then both sides join on the keys and the salt.
The sketch only decides where rows go, so the result is that of the plain join
whatever it finds.

Keys are weighed by their rows' bytes: a page of a thousand documents counts as many
narrow rows, so a key of few but heavy rows is dealt out, too.

``lookup_join`` writes the right side once, broadcasts it when it turns out small, in rows
and in bytes, and takes the salted way beyond that.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeline.session import materialise

HOT_ROWS = 1_000_000  # left rows of one key that one task should take, if they are narrow
ROW_BYTES = 256  # a row counts once, and once more for each such piece of it
HOT_KEYS = 2_048  # heaviest keys kept: they stay a literal-sized map
SKETCH_ITEMS = 10_000  # counters of one heavy-hitter sketch
SKETCH_GROUPS = 512  # sketches left after the first of two merges
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 64 << 20

SALT = "__salt"


def _bytes(value: Column, kind: T.DataType) -> Column:
    """About the bytes of a value, by its type; 8 for numbers and the like."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        size = F.octet_length(value)
    elif isinstance(kind, T.ArrayType):
        if isinstance(kind.elementType, (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.StructType)):
            parts = F.transform(value, lambda x: _bytes(x, kind.elementType))
            size = F.aggregate(parts, F.lit(0).cast("bigint"), lambda total, x: total + x)
        else:
            size = F.size(value) * 8
    elif isinstance(kind, T.MapType):
        size = _bytes(F.map_keys(value), T.ArrayType(kind.keyType)) + _bytes(
            F.map_values(value), T.ArrayType(kind.valueType)
        )
    elif isinstance(kind, T.StructType):
        size = F.lit(0)
        for field in kind:
            size = size + _bytes(value.getField(field.name), field.dataType)
    else:
        size = F.lit(0)
    return F.coalesce(size, F.lit(0)).cast("bigint") + 8


def row_bytes(df: DataFrame) -> Column:
    """About the bytes of a row of ``df``; values are measured, not written out."""
    size = F.lit(0).cast("bigint")
    for field in df.schema:
        size = size + _bytes(F.col("`" + field.name.replace("`", "``") + "`"), field.dataType)
    return size


def hot_salts(left: DataFrame, keys: Sequence[str], hot_rows: int | None = None) -> Column:
    """One map from key hash to number of salts, holding hot keys only.

    Each task sketches its own rows; sketches are merged in two steps, so that the
    last one gets a fixed number of them. Keys are counted by hash: two keys that
    collide share their salts, which is harmless, as both sides use the same map. A row
    enters its sketch once for each ``ROW_BYTES`` of it, at least once.
    """
    hot_rows = hot_rows or HOT_ROWS
    times = (F.floor(row_bytes(left) / ROW_BYTES) + 1).cast("int")
    hashed = left.select(
        F.explode(F.array_repeat(F.xxhash64(*keys), times)).alias("__key"),
        F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS)).alias("__group"),
    )
    sketches = hashed.groupBy("__group").agg(
        F.expr(f"approx_top_k_accumulate(__key, {SKETCH_ITEMS})").alias("__sketch")
    )
    top = F.expr(
        f"approx_top_k_estimate(approx_top_k_combine(__sketch, {SKETCH_ITEMS}), {HOT_KEYS})"
    )
    hot = F.filter(top, lambda x: x["count"] > hot_rows)
    salts = F.transform(
        hot,
        lambda x: F.struct(x["item"], F.ceil(x["count"] / hot_rows).cast("int")),
    )
    # Grouped by a constant: without rows there is no group and the map is NULL,
    # whereas combining nothing at all fails.
    merged = sketches.groupBy(F.lit("all")).agg(F.map_from_entries(salts).alias("salts"))
    return merged.select("salts").scalar()


def _salts_of_row(salts: Column, keys: Sequence[str]) -> Column:
    return F.coalesce(F.try_element_at(salts, F.xxhash64(*keys)), F.lit(1))


def deal(left: DataFrame, keys: Sequence[str], salts: Column) -> DataFrame:
    """Give every row one of the salts of its key.

    The partition number deals out copies of one row too, and unlike a random
    number it is the same when a lost task runs again. Rows of other keys are not hashed.
    """
    spread = F.xxhash64(*[F.col(f"`{c}`") for c in left.columns]) + F.spark_partition_id()
    number = _salts_of_row(salts, keys)
    dealt = F.when(number > 1, F.pmod(spread, number)).otherwise(0)
    return left.withColumn(SALT, dealt.cast("int"))


def repeat(right: DataFrame, keys: Sequence[str], salts: Column) -> DataFrame:
    """Repeat every row for each salt of its key; most keys have one."""
    last = _salts_of_row(salts, keys) - 1
    return right.withColumn(SALT, F.explode(F.sequence(F.lit(0), last)))


def spread_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str,
    hot_rows: int | None = None,
) -> DataFrame:
    """Join on ``keys``; ``how`` is inner, left, left_semi or left_anti.

    NULL keys match nothing, as in a plain equi-join, and are dealt out like any
    other hot key. For semi and anti joins the right side is reduced to distinct
    keys; for the others keep few right rows per key.
    """
    keys = list(keys)
    salts = hot_salts(left, keys, hot_rows)
    if how in ("left_semi", "left_anti"):
        # Distinct after the salt, so that the join reuses the shuffle.
        right = repeat(right.select(*keys).dropna(), keys, salts).distinct()
    else:
        right = repeat(right, keys, salts)
    return deal(left, keys, salts).join(right, [*keys, SALT], how).drop(SALT)


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str,
    broadcast_rows: int = BROADCAST_ROWS,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join to a side of few narrow rows; it is written once and measured there first."""
    held = materialise(right, "lookup")
    rows = held.count()
    if rows <= broadcast_rows and _fits(held, rows, broadcast_bytes):
        return left.join(F.broadcast(held), list(keys), how)
    return spread_join(left, held, keys, how)


def _fits(held: DataFrame, rows: int, most: int) -> bool:
    """Whether the rows are within ``most`` bytes; a fixed width is not read for that."""
    kinds = (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.StructType)
    if not any(isinstance(f.dataType, kinds) for f in held.schema):
        return rows * 8 * len(held.columns) <= most
    return (held.agg(F.sum(row_bytes(held))).first()[0] or 0) <= most
