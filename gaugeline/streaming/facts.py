"""The fact run as an available-now stream over the bronze table.

The checkpoint tracks bronze files, so a batch that arrives in pieces is still
loaded whole. There is no watermark: late readings are accepted at any age.
"""

from __future__ import annotations

import uuid
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline.operators import upsert
from gaugeline.operators.joins import lookup_join
from gaugeline.plans import facts
from gaugeline.session import configure, materialise
from gaugeline.sources import catalog


def stream_facts(
    spark: SparkSession,
    tables: catalog.Tables,
    checkpoint: str,
    run_ts: datetime,
    as_of: date | None = None,
    files_per_trigger: int | None = None,
) -> None:
    """Load all bronze files not seen before, then rebuild the daily statistics.

    ``checkpoint`` is a durable folder that belongs to this stream; its name marks the
    stream's loads. ``files_per_trigger`` bounds a micro-batch; readings of one batch
    that fall into several are de-duplicated against each other, as if they were batches.
    """
    configure(spark)
    catalog.ensure_all(spark, tables)

    stream = checkpoint.rstrip("/").rsplit("/", 1)[-1]

    def load(rows: DataFrame, epoch: int) -> None:
        """One commit an epoch: a replay undoes what a stopped attempt left, or does nothing."""
        session = rows.sparkSession
        catalog.refresh(session, tables)
        # Only one query runs on a checkpoint, so open loads of this stream are dead.
        facts.undo_unfinished(session, tables, own=f"{stream}@")
        # Whatever is asked of a micro-batch reads its payloads, so it is asked once.
        names = [catalog.ARRIVED, "batch_id"]
        came = materialise(rows.select(*names).distinct(), "came")
        last = came.agg(F.max(catalog.ARRIVED)).first()[0]
        if last is None:
            return
        log = session.table(tables.batch_log).where(upsert.values_filter(came, catalog.ARRIVED))
        own = F.startswith(F.col(catalog.LOAD_ID), F.lit(f"{stream}@"))
        this = F.startswith(F.col(catalog.LOAD_ID), F.lit(f"{stream}@{epoch}@"))
        if not log.where(this).isEmpty():
            return
        # Batches that other loads brought are done; a batch of this stream may go on.
        done = materialise(log.where(~own).select(*names).distinct(), "done")
        fresh, batches = (lookup_join(df, done, names, "left_anti") for df in (rows, came))
        load_id = f"{stream}@{epoch}@{uuid.uuid4().hex}"
        facts.load_batches(fresh, tables, load_id, run_ts, last, batches)

    reader = spark.readStream
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    query = (
        reader.table(tables.bronze_measurements)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    catalog.refresh(spark, tables)
    facts.build_daily(spark, tables, as_of)
