"""Landed page responses: scans, page prefix, window filter.

A page lands as one JSON document per line, ``{"page", "status", "results": [...]}``
(measurements also carry ``sensor_id``). Documents inside ``results`` stay raw text.
Pages that answer one request (a run's batch id) lie in a folder of their own,
``request=<id>``: page numbers count within a request, and a run reads its folder only.
"""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeline import schemas
from gaugeline.functions.instants import parse_instant
from gaugeline.operators.joins import lookup_join
from gaugeline.session import materialise

# Fixed values of the feed: documents of a full page, and the status of a page that came.
PAGE_LIMIT = 1000
STATUS_OK = 200


def request_folder(path: str, request: str) -> str:
    """Where the pages that answer one request land below a landing path."""
    return f"{path.rstrip('/')}/request={quote(request, safe='')}"


def _read(spark: SparkSession, path: str, schema: T.StructType, request: str | None) -> DataFrame:
    reader = spark.read.schema(schema)
    if request is None:
        return reader.json(path)
    try:
        return reader.json(request_folder(path, request))
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)  # no page has landed


def read_location_pages(
    spark: SparkSession, path: str, request: str | None = None
) -> DataFrame:
    """Pages of one request, whose folder alone is read, or of all that lie in ``path``."""
    return _read(spark, path, schemas.LOCATION_PAGE, request)


def read_measurement_pages(
    spark: SparkSession, path: str, request: str | None = None
) -> DataFrame:
    return _read(spark, path, schemas.MEASUREMENT_PAGE, request)


def stream_measurement_pages(
    spark: SparkSession, path: str, request: str, files_per_trigger: int | None = None
) -> DataFrame | None:
    """Pages of one request as they land, as a stream; None while its folder is missing."""
    reader = spark.readStream.schema(schemas.MEASUREMENT_PAGE)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    try:
        return reader.json(request_folder(path, request))
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def landed_once(pages: DataFrame) -> DataFrame:
    """The pages as a columnar copy with ``documents`` counted.

    Finding where feeds end reads the pages a second time; of the copy that is a few
    narrow columns instead of all the JSON again.
    """
    counted = pages.withColumn("documents", document_count(F.col("results")))
    return materialise(counted, "pages")


def document_count(results: Column) -> Column:
    return F.coalesce(F.size(results), F.lit(0))


def page_prefix(
    pages: DataFrame,
    feed: Sequence[str],
    page_limit: int = PAGE_LIMIT,
) -> DataFrame:
    """The pages 1..n of each feed that a reader following the pages would keep.

    A feed ends before its first failed, empty or missing page and after its first
    short page; earlier pages are kept. ``feed`` may be empty: all pages are one feed.
    Documents are counted in ``results`` unless there is a ``documents`` column.

    The end of a feed is a minimum over per-page marks, so it combines on the map
    side and no feed is ever gathered in one task, however many pages it has.
    """
    feed = list(feed)
    counted = "documents" in pages.columns
    documents = F.col("documents") if counted else document_count(F.col("results"))
    marks = pages.where(F.col("page").isNotNull()).select(
        *feed,
        "page",
        ((F.col("status") != STATUS_OK) | F.col("status").isNull() | (documents == 0)).alias("bad"),
        (documents < page_limit).alias("short"),
    )
    # Every page vouches for its successor: a page nobody vouches for follows a gap.
    vouched = marks.select(
        *feed,
        F.explode(
            F.array(
                F.struct(F.col("page").alias("page"), F.lit(True).alias("here"),
                         "bad", "short"),
                F.struct((F.col("page") + 1).alias("page"), F.lit(False).alias("here"),
                         F.lit(None).cast("boolean").alias("bad"),
                         F.lit(None).cast("boolean").alias("short")),
            )
        ).alias("m"),
    ).select(*feed, "m.*")
    per_page = vouched.groupBy(*feed, "page").agg(
        F.bool_or("here").alias("here"),
        F.bool_or(~F.col("here")).alias("follows"),
        F.bool_or("bad").alias("bad"),
        F.bool_or(F.col("short") & ~F.col("bad")).alias("short"),
    )
    gap = (F.col("page") != 1) & ~F.col("follows")
    ends = (
        per_page.where("here")
        .groupBy(*feed)
        .agg(
            F.min(F.when(F.col("bad") | gap, F.col("page"))).alias("stop_before"),
            F.min(F.when(F.col("short"), F.col("page"))).alias("stop_after"),
            F.max("page").alias("last_page"),
        )
        # Feeds kept whole need no cut; what is left is normally tiny.
        .where((F.col("last_page") >= F.col("stop_before"))
               | (F.col("last_page") > F.col("stop_after")))
        .drop("last_page")
    )
    kept = (
        (F.col("page") < F.coalesce("stop_before", F.lit(2**31 - 1)))
        & (F.col("page") <= F.coalesce("stop_after", F.lit(2**31 - 1)))
    )
    if feed:
        # A feed key that is NULL matches no cut, so such pages are left out.
        known = pages.where(F.col("page").isNotNull()).dropna(subset=feed)
        cut = lookup_join(known, ends, feed, "left")
    else:
        stop = ends.agg(F.struct(F.min("stop_before"), F.min("stop_after")).alias("stop"))
        cut = pages.where(F.col("page").isNotNull()).withColumn("stop", stop.scalar())
        cut = cut.select(
            *pages.columns,
            F.col("stop")[F.lit("col1")].alias("stop_before"),
            F.col("stop")[F.lit("col2")].alias("stop_after"),
        )
    return cut.where(kept).select(*pages.columns)


def within_window(results: Column, window_from: Column, window_to: Column) -> Column:
    """Documents whose reading starts in [from, to); one without a start is kept.

    The bounds carry no fraction of a second, as in a feed request.
    """
    start = F.date_trunc("second", window_from)
    end = F.date_trunc("second", window_to)

    def dated(document: Column) -> Column:
        at = parse_instant(F.get_json_object(document, "$.period.datetimeFrom.utc"))
        return F.struct(document.alias("document"), at.alias("at"))

    def inside(x: Column) -> Column:
        return F.coalesce((x["at"] >= start) & (x["at"] < end), F.lit(True))

    # Dated first, so that the document is parsed once and not for either bound.
    return F.transform(F.filter(F.transform(results, dated), inside), lambda x: x["document"])
