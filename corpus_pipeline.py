"""The corpus pipeline: stages over documents, each written and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gaugeline.llm import stages
from gaugeline.session import scratch_dir

STAGES = [
    ("quality rules", stages.quality_rules),
    ("toxicity", stages.toxicity),
    ("near duplicates", stages.near_duplicates),
    ("repeated spans", stages.repeated_spans),
    ("packing", stages.packing),
]

# Toxicity is a trained model and packing depends on how rows are dealt to tasks; the
# tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage for the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        path = scratch_dir(spark, f"corpus-{number}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
