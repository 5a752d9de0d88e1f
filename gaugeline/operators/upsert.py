"""Key-based upserts as joins: the new contents of a table, or the rows to append.

Keys match as in a merge: NULL never matches, so a row with a NULL key is inserted
every time. Rows found only in the target stay. Several source rows of a key the
target lacks are all inserted; several that would update one target row are an
error, as the outcome would depend on their order.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline import schemas
from gaugeline.functions.instants import instant_or_now
from gaugeline.operators.joins import SALT, deal, hot_salts, lookup_join, repeat, spread_join

# Given a column name, the target's or the source's column of that name.
Side = Callable[[str], Column]
Condition = Callable[[Side, Side], Column]

MAX_PRUNE_VALUES = 4_000


def _known(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(keys))


def deduplicate(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key, the largest by its other columns; NULL keys are all kept."""
    others = [c for c in source.columns if c not in keys] or list(keys)
    best = _known(source, keys).groupBy(*keys).agg(F.max(F.struct(*others)).alias("__row"))
    missing = F.lit(False)
    for key in keys:
        missing = missing | F.col(key).isNull()
    return (
        best.select(*[c if c in keys else F.col(f"__row.{c}") for c in source.columns])
        .unionByName(source.where(missing))
    )


def new_rows(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    dedupe_source: bool = False,
) -> DataFrame:
    """Source rows whose key the target lacks: the rows an insert-only merge appends.

    The target is reduced to its distinct keys before it is shuffled.
    """
    if dedupe_source:
        source = deduplicate(source, keys)
    return spread_join(source, target, keys, "left_anti").select(*source.columns)


def _ambiguous(keys: Sequence[str]) -> Column:
    return F.raise_error(
        F.lit(f"upsert: several source rows would update one target row on ({', '.join(keys)})")
    )


def _updated(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    set_cols: Sequence[str],
    when: Condition | None,
    stamp: Mapping[str, Column],
) -> DataFrame:
    """The target's rows after their matching source rows are applied."""
    keys = list(keys)
    source_only = [c for c in source.columns if c not in keys]
    # Copies of a key collapse on the map side; one source row per key remains. It is
    # grouped by key and salt, so the join needs no further shuffle.
    salts = hot_salts(target, keys)
    by_key = (
        repeat(_known(source, keys), keys, salts)
        .groupBy(*keys, SALT)
        .agg(F.count("*").alias("__n"), F.max(F.struct(*source_only)).alias("__s"))
    )
    matched = deal(target, keys, salts).join(by_key, [*keys, SALT], "left").drop(SALT)

    def of_target(name: str) -> Column:
        return F.col(name)

    def of_source(name: str) -> Column:
        return F.col(name) if name in keys else F.col(f"__s.{name}")

    hit = F.col("__n").isNotNull()
    if when is not None:
        hit = hit & F.coalesce(when(of_target, of_source), F.lit(False))

    def result(name: str, hit: Column) -> Column:
        if name in stamp:
            return F.when(hit, stamp[name]).otherwise(F.col(name)).alias(name)
        if name in set_cols:
            return F.when(hit, of_source(name)).otherwise(F.col(name)).alias(name)
        return F.col(name)

    if when is None:
        checked = matched.withColumn(
            "__n", F.when(F.col("__n") > 1, _ambiguous(keys)).otherwise(F.col("__n"))
        )
        return checked.select(*[result(c, hit) for c in target.columns])

    single = matched.where(F.coalesce("__n", F.lit(1)) == 1)
    single = single.select(*[result(c, hit) for c in target.columns])

    # Keys with several source rows: all of them are tried against each target row.
    # Target rows of equal content fare alike, so they are grouped and counted.
    several = matched.where(F.col("__n") > 1).drop("__s")
    rows = _known(source, keys).select(*keys, F.struct(*source_only).alias("__s"))
    tried = spread_join(rows, several, keys, "inner").withColumn("__hit", hit)
    settled = (
        tried.groupBy(*target.columns, "__n")
        .agg(
            (F.count("*") / F.col("__n")).cast("int").alias("__copies"),
            F.count_if("__hit").alias("__hits"),
            F.max(F.when(F.col("__hit"), F.col("__s"))).alias("__s"),
        )
        .withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies"))))
        .withColumn(
            "__hit",
            F.when(F.col("__hits") > F.col("__copies"), _ambiguous(keys).cast("boolean"))
            .otherwise(F.col("__hits") > 0),
        )
    )
    settled = settled.select(*[result(c, F.col("__hit")) for c in target.columns])
    return single.unionByName(settled)


def _merged(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    set_cols: Sequence[str],
    when: Condition | None,
    stamp: Mapping[str, Column],
) -> DataFrame:
    """Both sides met once, by a full join of the target with the source rows of each key.

    For keys that are unique by contract, so that the rows of one key are few.
    """
    keys = list(keys)
    source_only = [c for c in source.columns if c not in keys]
    by_key = (
        _known(source, keys)
        .groupBy(*keys)
        .agg(F.collect_list(F.struct(*source_only)).alias("__rows"))
    )
    present = target.withColumn("__old", F.struct(*target.columns))
    joined = present.select(*keys, "__old").join(by_key, keys, "full")

    def of_target(name: str) -> Column:
        return F.col(f"__old.{name}")

    def hits_of(row: Column) -> Column:
        def of_source(name: str) -> Column:
            return F.col(name) if name in keys else row[name]

        return F.coalesce(when(of_target, of_source), F.lit(False))

    hits = F.col("__rows") if when is None else F.filter("__rows", hits_of)
    joined = joined.withColumn("__hits", hits)
    several = F.col("__old").isNotNull() & (F.size("__hits") > 1)
    hit = F.when(several, _ambiguous(keys).cast("boolean")).otherwise(
        F.coalesce(F.size("__hits") == 1, F.lit(False))
    )
    joined = joined.withColumn("__hit", hit)

    def updated(name: str) -> Column:
        if name in stamp:
            new = stamp[name]
        elif name in set_cols and name in keys:
            new = F.col(name)
        elif name in set_cols:
            new = F.get("__hits", F.lit(0))[name]
        else:
            return of_target(name).alias(name)
        return F.when(F.col("__hit"), new).otherwise(of_target(name)).alias(name)

    def inserted(row: Column) -> Column:
        return F.struct(*[(F.col(c) if c in keys else row[c]).alias(c) for c in target.columns])

    old = F.array(F.struct(*[updated(c) for c in target.columns]))
    rows = F.when(F.col("__old").isNotNull(), old).otherwise(F.transform("__rows", inserted))
    missing = F.lit(False)
    for key in keys:
        missing = missing | F.col(key).isNull()
    met = joined.select(F.explode(rows).alias("__row")).select("__row.*")
    return met.unionByName(source.where(missing).select(*target.columns))


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    set_cols: Sequence[str] | None = None,
    when: Condition | None = None,
    stamp: Mapping[str, Column] | None = None,
    dedupe_source: bool = False,
    unique_keys: bool = False,
) -> DataFrame:
    """The whole target after merging ``source``.

    ``set_cols`` are the columns an update sets: all but the keys by default, none
    for insert-only. ``when`` restricts updates and is given both sides, as in
    ``lambda t, s: t("v") != s("v")``. ``stamp`` columns are set on update and insert.
    ``unique_keys`` says that keys are unique by contract: both sides are then read once
    and joined without a search for hot keys. The result is the same.
    """
    stamp = dict(stamp or {})
    source = source.withColumns(stamp) if stamp else source
    source = source.select(*target.columns)
    if dedupe_source:
        source = deduplicate(source, keys)
    if set_cols is None:
        set_cols = [c for c in target.columns if c not in keys and c not in stamp]
    if unique_keys and set_cols:
        return _merged(target, source, keys, set_cols, when, stamp)
    kept = target
    if set_cols:
        kept = _updated(target, source, keys, set_cols, when, stamp)
    return kept.select(*target.columns).unionByName(new_rows(target, source, keys))


def values_filter(source: DataFrame, column: str) -> Column:
    """A literal filter that holds for every non-NULL ``column`` of the source.

    Put on a partition column of a target that rows must agree on to match, it
    prunes partitions before anything is read. Beyond a few thousand values the
    filter is their range.
    """
    values = source.select(column).where(F.col(column).isNotNull()).distinct()
    found = [r[0] for r in values.limit(MAX_PRUNE_VALUES + 1).collect()]
    if len(found) <= MAX_PRUNE_VALUES:
        return F.col(column).isin(found)
    low, high = values.agg(F.min(column), F.max(column)).first()
    return F.col(column).between(low, high)


# --- the four upserts of the domain ------------------------------------------------


def upsert_locations(
    dim: DataFrame, incoming: DataFrame, run_ts: datetime | None = None, **options
) -> DataFrame:
    """Update a location when its last reading time differs and the new one is known.

    A dimension row without that time is therefore never updated, and an older
    snapshot overwrites a newer row.
    """
    return upsert(
        dim,
        incoming,
        schemas.LOCATION_KEY,
        when=lambda t, s: (t("last_updated_utc") != s("last_updated_utc"))
        & s("last_updated_utc").isNotNull(),
        stamp={"dim_ingested_at": instant_or_now(run_ts)},
        unique_keys=True,
        **options,
    )


def upsert_sensors(
    dim: DataFrame, incoming: DataFrame, run_ts: datetime | None = None, **options
) -> DataFrame:
    return upsert(
        dim,
        incoming,
        schemas.SENSOR_KEY,
        stamp={"dim_ingested_at": instant_or_now(run_ts)},
        unique_keys=True,
        **options,
    )


def new_readings(fact: DataFrame, incoming: DataFrame, dedupe_source: bool = False) -> DataFrame:
    """Readings to append to the fact: the first write of a reading wins."""
    return new_rows(fact, incoming, schemas.FACT_KEY, dedupe_source)


def present_readings(fact: DataFrame, incoming: DataFrame) -> DataFrame:
    """Keys of incoming readings that the fact holds.

    The fact is never shuffled: incoming keys, of which copies collapse on the map side,
    are broadcast if few, else they go to the fact's buckets.
    """
    keys = _known(incoming.select(*schemas.FACT_KEY), schemas.FACT_KEY).distinct()
    return fact.select(*schemas.FACT_KEY).join(keys, schemas.FACT_KEY, "left_semi")


def absent_readings(fact: DataFrame, incoming: DataFrame) -> DataFrame:
    """As ``new_readings``, for a fact bucketed by its key.

    Incoming rows stay where they are unless very many of them are present already.
    """
    return lookup_join(incoming, present_readings(fact, incoming).distinct(), schemas.FACT_KEY, "left_anti")


DAILY_MEASURES = [
    "avg_value",
    "min_value",
    "max_value",
    "stddev_value",
    "perc95_value",
    "perc05_value",
    "reading_count",
    "completeness_ratio",
]


def upsert_daily(daily: DataFrame, incoming: DataFrame) -> DataFrame:
    """Overwrite the measures; place and parameter name of an existing row are kept."""
    return upsert(daily, incoming, schemas.DAILY_KEY, DAILY_MEASURES, unique_keys=True)
