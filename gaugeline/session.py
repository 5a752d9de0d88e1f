"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Day boundaries follow the session zone, so it is pinned. Dynamic overwrite makes
# a partitioned overwrite replace only the partitions it writes.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def scratch_dir(spark: SparkSession, name: str) -> str:
    """The path of a new folder under the shared folder the cluster names.

    A session on one machine may leave ``spark.checkpoint.dir`` unset and gets a folder
    below its warehouse; on a cluster the setting is required.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/checkpoints"
    return f"{root.rstrip('/')}/gaugeline/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    For results used several times: it cuts lineage, outlives lost executors and
    lets the planner see the real size.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
