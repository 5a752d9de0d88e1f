"""Bronze rows: documents packed as a JSON array, stamped with their run."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeline.functions.instants import utc
from gaugeline.operators.joins import lookup_join
from gaugeline.session import materialise
from gaugeline.sources.landing import PAGE_LIMIT


def pack_pages(pages: DataFrame) -> DataFrame:
    """One bronze row per landed page with documents: no shuffle, no re-serialising.

    A page holds a bounded number of documents, so a feed of any length becomes
    many small rows instead of one giant one.
    """
    texts = F.transform("results", lambda d: F.coalesce(d, F.lit("null")))
    return (
        pages.withColumn("rows_fetched", F.size("results"))
        .where(F.col("rows_fetched") > 0)
        .withColumn("api_payload", F.concat(F.lit("["), F.array_join(texts, ","), F.lit("]")))
        .drop("results")
    )


def pack_documents(
    documents: DataFrame,
    keys: Sequence[str],
    identity: Sequence[str],
    document: Column,
    max_documents: int = PAGE_LIMIT,
) -> DataFrame:
    """Pack the documents of each group into rows of ``max_documents``, the last may be shorter.

    A group is cut in order of ``identity``, the columns that tell its documents apart,
    whatever its size; documents of one identity follow in order of their content. Groups
    that fit into one row are gathered at once; larger ones get their places from a sort
    by ranges (``ranked``), so no task receives a whole one. NULL keys are groups, too.
    """
    keys = list(keys)
    rows = documents.select(
        # A hash stands in for the key so that NULL keys are counted and split too.
        F.xxhash64(F.lit(0), *keys).alias("__key"),
        F.struct(F.lit(0).alias("none"), *keys).alias("__group"),
        F.struct(*identity).alias("__id"),
        document.alias("__content"),
    )
    large = materialise(
        rows.groupBy("__key").count().where(F.col("count") > max_documents).select("__key"), "large-groups"
    )
    small = rows.withColumn("__cut", F.lit(0).cast("bigint"))
    if not large.isEmpty():
        small = lookup_join(small, large, ["__key"], "left_anti")
        among = lookup_join(rows, large, ["__key"], "left_semi")
        cut = F.floor((F.col("__rank") - 1) / max_documents)
        placed = ranked(among, ["__key", "__group"], ["__id", "__content"]).withColumn("__cut", cut)
        small = small.unionByName(placed.drop("__rank"))
    # Documents become text after the shuffle, which so carries their bare columns.
    texts = small.select("__group", "__cut", F.struct("__id", F.to_json("__content").alias("text")).alias("__doc"))
    packed = F.transform(F.array_sort(F.collect_list("__doc")), lambda x: x["text"])
    return texts.groupBy("__group", "__cut").agg(
        F.count("*").cast("int").alias("rows_fetched"),
        F.concat(F.lit("["), F.array_join(packed, ","), F.lit("]")).alias("api_payload"),
    ).select(*[F.col(f"__group.{k}") for k in keys], "rows_fetched", "api_payload")


def ranked(rows: DataFrame, group: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``rows`` with ``__rank``, their place from 1 in their group by ``order``.

    Rows are dealt out by ranges of group and order and sorted there; copies of one row
    are told apart by where they came from, so that even they are dealt over tasks. A
    range counts the rows of its groups; a group's rows in earlier ranges are added. The
    counts are one row for each group and one for each range.
    """
    sort = [*group, *order, "__from"]
    placed = rows.withColumn("__from", F.spark_partition_id()).repartitionByRange(*sort)
    # The number tells the range in its upper and the place there in its lower bits.
    numbered = materialise(
        placed.sortWithinPartitions(*sort).drop("__from").withColumn("__at", F.monotonically_increasing_id()),
        "ranked",
    ).withColumns({"__range": F.shiftright("__at", 33), "__at": F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))})
    by_range = [F.col(c) for c in group]
    counts = numbered.groupBy(*by_range, "__range").agg(
        F.min("__at").alias("__first"), F.count("*").alias("__n")
    )
    earlier = Window.partitionBy(*by_range).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        # Hashes join NULL keys as well.
        F.xxhash64(*by_range).alias("__hash"),
        "__range",
        (F.coalesce(F.sum("__n").over(earlier), F.lit(0)) - F.col("__first") + 1).alias("__shift"),
    )
    hashed = numbered.withColumn("__hash", F.xxhash64(*by_range))
    return (
        lookup_join(hashed, starts, ["__hash", "__range"], "inner")
        .withColumn("__rank", F.col("__at") + F.col("__shift"))
        .drop("__hash", "__range", "__at", "__shift")
    )


def stamp(packed: DataFrame, batch_id: str | Column, constants: Mapping[str, Column]) -> DataFrame:
    """Add the batch id and the run's other constants; both are the caller's.

    Rows of several batches name theirs by a column.
    """
    return packed.withColumns({"batch_id": F.lit(batch_id), **constants})


def stamp_locations(packed: DataFrame, batch_id: str, run_ts: datetime) -> DataFrame:
    stamped = stamp(packed, batch_id, {"ingestion_time": F.lit(utc(run_ts).isoformat())})
    return stamped.select("batch_id", "ingestion_time", "rows_fetched", "api_payload")


def stamp_measurements(
    packed: DataFrame,
    batch_id: str | Column,
    run_ts: datetime,
    window_from: Column,
    window_to: Column,
) -> DataFrame:
    """``window_from`` and ``window_to`` are ISO text."""
    stamped = stamp(
        packed,
        batch_id,
        {
            "parameter_id": F.col("parameter_id").cast("string"),
            "ingestion_datetime": F.lit(utc(run_ts).isoformat()),
            "ingestion_window_datetime_from": window_from,
            "ingestion_window_datetime_to": window_to,
        },
    )
    return stamped.select(
        "batch_id",
        "sensor_id",
        "parameter_id",
        "location_id",
        "country_code",
        "ingestion_datetime",
        "ingestion_window_datetime_from",
        "ingestion_window_datetime_to",
        "rows_fetched",
        "api_payload",
    )
