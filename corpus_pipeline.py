"""A training-data pipeline over ``documents``: each stage is written as Parquet and read again by the next."""

from __future__ import annotations

import functools

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from granary.llm import decontamination, jaccard, packing, quality, toxicity
from granary.llm.common import materialised, table


BATCH_ROWS = 1000  # most rows of an Arrow batch, which JVM and Python both hold whole while it is handed over


def small_batches(spark: SparkSession) -> None:
    """Lower the session's batches to BATCH_ROWS; a smaller setting stays."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, BATCH_ROWS)


def bounded(stage):
    @functools.wraps(stage)
    def run_bounded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return stage(spark, docs, sf_dir)

    return run_bounded


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.keep_one(docs)


def unseen(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.keep_unseen(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json")).drop("queue")


STAGES = [
    (name, bounded(stage)) for name, stage in (
        ("quality", good_quality), ("toxicity", not_toxic), ("jaccard", one_of_each), ("decontamination", unseen),
        ("packing", packed),
    )
]

# Trained scores, latent search and tokenization are beyond SQL.  tests/llm compares the Jaccard, decontamination and
# packing stages with brute force on a small fixture; the two trained stages are not compared with anything there.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialised(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
