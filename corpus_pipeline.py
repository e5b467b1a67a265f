"""The training-data pipeline: stages over ``documents``, each written and read again.

Good documents stay, one of each group of near copies; findings of the secret scan are
masked; the mix repeats, cuts and drops documents towards its targets; the last stage
gives the pieces of the packed sequences instead of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tagtide.llm import mixing, near_dedup, packing, quality, secrets
from tagtide.workspace import stored


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.dedup(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs, most_repositories=None)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs, more=())


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(
        docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), special=True
    )


STAGES = [
    ("quality", good_quality),
    ("near_dedup", without_copies),
    ("secrets", without_secrets),
    ("mixing", mixed),
    ("packing", packed),
]
#: Trained scores, MinHash groups and random draws have no SQL; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, one after another."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
