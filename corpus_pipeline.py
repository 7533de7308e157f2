"""The corpus pipeline: five stages, each working on all that the one before has kept.

Part of the subpackage siltworks.llm. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from siltworks.llm import exact_dedup, near_dedup, packing, quality, toxicity
from siltworks.llm.common import bounded_batches, shared_dir, table
from siltworks.llm.queries import tokenizer_path


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxic documents go."""
    bounded_batches(spark)
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of low quality go."""
    bounded_batches(spark)
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest doc_id stays."""
    bounded_batches(spark)
    return exact_dedup.drop_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest doc_id."""
    bounded_batches(spark)
    return near_dedup.keep_one(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as sequences of at most 2048 tokens; one row per piece."""
    bounded_batches(spark)
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"), 2048).drop("row")


STAGES = [
    ("toxicity", clean),
    ("quality", good),
    ("exact_dedup", without_copies),
    ("near_dedup", without_near_copies),
    ("packing", packed),
]

#: SQL cannot express the stages; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, from ``documents``. Each but the last is written as Parquet, which the next one reads."""
    docs, folder = table(spark, sf_dir, "documents"), f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
