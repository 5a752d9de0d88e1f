"""The stages of the corpus pipeline: (spark, docs, sf_dir) -> the documents that stay."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from gaugeline.llm import packing as best_fit
from gaugeline.llm import quality, simhash, spans
from gaugeline.llm import toxicity as toxic

# What the labels table knows, in the order of the chain; the last one decides.
CATEGORIES = {"low_quality": "quality = 0", "toxic": "toxic = 1"}


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, less the lines their host repeats."""
    return quality.clean(docs)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the chain trained on ``labels`` does not find toxic."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    # Trained on the labelled documents as they were, not as the stage before left them.
    whole = spark.read.parquet(f"{sf_dir}/documents.parquet")
    chain = toxic.train(whole, labels, CATEGORIES)
    return toxic.judge(docs, chain).where("not toxic").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: shingle length and bits as in op6's query.

    Fingerprints at most three bits apart are near duplicates without a further check. A
    missing text, an empty one and one without words have one fingerprint; one of them stays.
    """
    return simhash.keep_one(docs, simhash.near_duplicates(docs))


def repeated_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents less the passages that an earlier document holds; those left empty go."""
    return spans.remove_repeats(docs).where("n_removed = 0 or n_chars > 0").drop("n_removed")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every document with their sequence and offset, and their ids."""
    return best_fit.pack(docs, public_tokenizers.path("word_bpe_49k.json"))
