"""Landed pages to bronze as an available-now stream, for feeds that land over time.

Pages of a feed may come in any order and over any number of micro-batches. A page goes
to bronze as soon as all pages before it have come, so that bronze holds at any time
what ``page_prefix`` keeps of the pages landed so far.

What is open is kept per feed in small tables beside the stream's checkpoint: how far
the feed has been released, whether it has ended, and narrow marks of the pages that
wait for an earlier one. The pages themselves are written once, as they land, with their
documents inside the window, and read again when their turn comes; none is moved by its feed. Joins of marks and feeds move
about 40 bytes a page, of the pages one micro-batch takes up and of those that wait.
"""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeline.functions.instants import iso_offset
from gaugeline.functions.values import DEFAULT_COUNTRY
from gaugeline.operators import audit, bronze
from gaugeline.operators.joins import lookup_join
from gaugeline.plans import facts
from gaugeline.session import configure
from gaugeline.sources import catalog, landing

FEED = ["sensor_id"]
# Marks of this many released pages are broadcast to the landed ones.
RELEASED_BROADCAST = 1_000_000

_FEEDS = T.StructType(
    [
        T.StructField("sensor_id", T.IntegerType()),
        T.StructField("reached", T.IntegerType()),
        T.StructField("ended", T.BooleanType()),
    ]
)
_MARKS = T.StructType(
    [
        T.StructField("sensor_id", T.IntegerType()),
        T.StructField("page", T.IntegerType()),
        T.StructField("status", T.IntegerType()),
        T.StructField("documents", T.IntegerType()),
        T.StructField("landed", T.LongType()),
    ]
)


def batch_of(request: str, epoch: int) -> str:
    """The batch a micro-batch writes; batches are loaded whole, so each is its own."""
    return f"{request}@{epoch}"


def _folder(state: str, name: str, epoch: int) -> str:
    return f"{state}/{name}/epoch={epoch}"


def _write(df: DataFrame, state: str, name: str, epoch: int) -> DataFrame:
    """Write one micro-batch's part; one that is repeated replaces it by the same rows."""
    path = _folder(state, name, epoch)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _before(spark: SparkSession, state: str, epoch: int) -> tuple[DataFrame, DataFrame]:
    """The feeds, merged over all earlier micro-batches, and the marks left by the last one."""
    if epoch == 0:
        return spark.createDataFrame([], _FEEDS), spark.createDataFrame([], _MARKS)
    known = spark.read.schema(T.StructType([*_FEEDS, T.StructField("epoch", T.LongType())]))
    feeds = known.option("basePath", f"{state}/feeds").parquet(f"{state}/feeds").where(F.col("epoch") < epoch)
    waiting = spark.read.schema(_MARKS).parquet(_folder(state, "waiting", epoch - 1))
    return _merged(feeds), waiting


def _merged(feeds: DataFrame) -> DataFrame:
    """One row a feed: it only ever gets further, and ends once."""
    return feeds.groupBy(*FEED).agg(F.max("reached").alias("reached"), F.bool_or("ended").alias("ended"))


def advance(
    marks: DataFrame, feeds: DataFrame, page_limit: int = landing.PAGE_LIMIT
) -> tuple[DataFrame, DataFrame]:
    """Pages to release, and the pages of open feeds with how far their feed was.

    ``marks`` are new and waiting pages (sensor_id, page, status, documents, landed),
    ``feeds`` has (sensor_id, reached, ended). A good copy of a page released before is
    released, too; a failed one comes too late and is dropped. Pages beyond the end of
    a feed are dropped, and so are those without sensor or number.
    """
    known = marks.dropna(subset=[*FEED, "page"])
    placed = known.join(feeds, FEED, "left").withColumns(
        {"reached": F.coalesce("reached", F.lit(0)), "ended": F.coalesce("ended", F.lit(False))}
    )
    good = F.coalesce(F.col("status") == landing.STATUS_OK, F.lit(False)) & (F.col("documents") > 0)
    copies = placed.where((F.col("page") >= 1) & (F.col("page") <= F.col("reached")) & good)
    opened = placed.where((F.col("page") > F.col("reached")) & ~F.col("ended"))
    # Counted from where the feed stands, the rule is that of a feed that landed at once.
    shifted = opened.withColumns({"at": F.col("page"), "page": F.col("page") - F.col("reached")})
    following = landing.page_prefix(shifted, FEED, page_limit).withColumn("page", F.col("at"))
    names = [*marks.columns, "reached"]
    return copies.select(*names).unionByName(following.select(*names)), opened.select(*names)


def settle(
    released: DataFrame, opened: DataFrame, page_limit: int = landing.PAGE_LIMIT
) -> tuple[DataFrame, DataFrame]:
    """The feeds that moved or ended, and the marks that still wait.

    A short page ends its feed, and so does a failed or empty one whose turn has come:
    nothing that lands later can be released.
    """
    moved = released.where(F.col("page") > F.col("reached")).groupBy(*FEED).agg(
        F.max("page").alias("now"), F.bool_or(F.col("documents") < page_limit).alias("ended")
    )
    rest = (
        opened.join(moved, FEED, "left")
        .withColumn("now", F.coalesce("now", "reached"))
        .where((F.col("page") > F.col("now")) & ~F.coalesce("ended", F.lit(False)))
    )
    bad = ~F.coalesce(F.col("status") == landing.STATUS_OK, F.lit(False)) | (F.col("documents") <= 0)
    failed = rest.where((F.col("page") == F.col("now") + 1) & bad).select(
        *FEED, F.col("now").alias("reached"), F.lit(True).alias("ended")
    )
    feeds = _merged(moved.withColumnRenamed("now", "reached").unionByName(failed))
    waiting = rest.join(failed.select(*FEED).distinct(), FEED, "left_anti")
    return feeds.select(*_FEEDS.names), waiting.select(*_MARKS.names)


def _inside() -> Column:
    return landing.within_window(F.col("results"), F.col("window_from"), F.col("window_to"))


def _plan(
    spark: SparkSession, tables: catalog.Tables, state: str, run_ts: datetime, country_code: str | None
) -> str:
    """The folder of the request's windows, which are fixed when its stream first runs.

    The plan is named by a note of one file, written after it, so half a plan is never read.
    """
    note = "path string"
    try:
        named = spark.read.schema(note).json(f"{state}/plan").first()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        named = None
    if named is None:
        path = f"{state}/plan-{uuid.uuid4().hex}"
        facts.measurement_plan(spark, tables, run_ts, country_code).write.parquet(path)
        spark.createDataFrame([(path,)], note).coalesce(1).write.mode("append").json(f"{state}/plan")
        return path
    return named.path


def stream_pages(
    spark: SparkSession,
    tables: catalog.Tables,
    request: str,
    run_ts: datetime,
    path: str,
    checkpoint: str,
    country_code: str | None = DEFAULT_COUNTRY,
    files_per_trigger: int | None = None,
    page_limit: int = landing.PAGE_LIMIT,
    complete: bool = False,
) -> None:
    """Append to bronze what the pages landed since the last call make readable.

    Call it again while pages of ``request`` land, in the end with ``complete``, which
    logs the run: the next window of its countries is planned from there. Over all calls
    bronze gets the rows of ``ingest_measurements``, in batches named ``batch_of``. The one
    difference: a failed copy of a page that lands after the page was released does not
    take it back. A country without data is logged, too; a folder that does not exist yet
    holds no pages.

    ``checkpoint`` is a durable folder of this request. A micro-batch that is repeated
    after a failure reads the same files and state, and replaces what it wrote.
    """
    configure(spark)
    catalog.ensure_all(spark, tables)
    state = checkpoint.rstrip("/")
    plan = _plan(spark, tables, state, run_ts, country_code)

    def ingest(pages: DataFrame, epoch: int) -> None:
        session = pages.sparkSession
        planned = lookup_join(pages, session.read.parquet(plan), FEED, "inner", facts.PLAN_BROADCAST)
        # The copy is read again each time one of its pages has its turn, so it holds only
        # what can reach bronze; documents are counted before.
        documents = landing.document_count(F.col("results"))
        good = (F.col("status") == landing.STATUS_OK) & (documents > 0)
        inside = F.when(good, _inside())
        landed = _write(planned.withColumns({"documents": documents, "results": inside}), state, "landed", epoch)
        feeds, waiting = _before(session, state, epoch)
        marks = landed.select(*FEED, "page", "status", "documents", F.lit(epoch).cast("bigint").alias("landed"))
        released, opened = advance(marks.unionByName(waiting), feeds, page_limit)
        released = _write(released, state, "released", epoch)
        opened = _write(opened, state, "opened", epoch)
        append(session, landed.schema, released, epoch)
        moved, waits = settle(released, opened, page_limit)
        _write(moved, state, "feeds", epoch)
        _write(waits, state, "waiting", epoch)

    def append(session: SparkSession, schema: T.StructType, released: DataFrame, epoch: int) -> None:
        batch = batch_of(request, epoch)
        catalog.refresh(session, tables)
        catalog.drop_load(session, tables.bronze_measurements, batch, "batch_id")
        epochs = sorted(r.landed for r in released.select("landed").distinct().collect())
        if not epochs:
            return
        whole = T.StructType([*schema, T.StructField("epoch", T.LongType())])
        folders = [_folder(state, "landed", e) for e in epochs]
        pages = session.read.schema(whole).option("basePath", f"{state}/landed").parquet(*folders)
        turn = released.select(*FEED, "page", F.col("landed").alias("epoch")).distinct()
        # Of a page released before, only good copies come later. One with nothing to bring
        # need not be looked for; copies of an earlier form hold all documents.
        good = (F.col("status") == landing.STATUS_OK) & (F.col("documents") > 0)
        bring = pages.where(good).withColumn("results", _inside()).where(F.size("results") > 0)
        due = lookup_join(bring, turn, [*FEED, "page", "epoch"], "left_semi", RELEASED_BROADCAST)
        rows = bronze.stamp_measurements(
            bronze.pack_pages(due),
            batch,
            run_ts,
            iso_offset(F.col("window_from")),
            iso_offset(F.col("window_to")),
        )
        catalog.append(rows, tables.bronze_measurements)

    pages = landing.stream_measurement_pages(spark, path, request, files_per_trigger)
    if pages is not None:
        query = (
            pages.writeStream.foreachBatch(ingest)
            .option("checkpointLocation", f"{state}/query")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        catalog.refresh(spark, tables)
    if complete:
        _log(spark, tables, request, run_ts, spark.read.parquet(plan))


def _log(
    spark: SparkSession, tables: catalog.Tables, request: str, run_ts: datetime, plan: DataFrame
) -> None:
    """Log the run once, counted over all its batches."""
    logged = spark.table(tables.run_log).where((F.col("kind") == "ingest") & (F.col("run_id") == request))
    if logged.isEmpty():
        own = F.startswith(F.col("batch_id"), F.lit(batch_of(request, 0)[:-1]))
        written = spark.table(tables.bronze_measurements).where(own)
        facts.log_run(audit.ingested(plan, written, request), tables, run_ts)
