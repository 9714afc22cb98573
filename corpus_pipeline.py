"""Corpus pipeline over ``documents``: each stage calls one operator of
``turnmill.llm``; its result is written as Parquet and reread as the next
stage's documents."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

from turnmill.llm import decontaminate, mixing, probminhash, quality, sharding
from turnmill.llm.common import discard, read
from turnmill.session import ensure_checkpoint_dir


def accepted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject."""
    return quality.accepted(docs, read(spark, sf_dir, "labels"))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    return probminhash.deduplicated(docs)


def unleaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.clean(docs, read(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A draw of documents that brings the mix to its target weights."""
    return mixing.mixed(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Uniform shuffle into 40 shards of exact size; adds shard and slot."""
    return sharding.shard_documents(docs)


STAGES = [
    ("quality", accepted),
    ("near-duplicates", distinct),
    ("decontamination", unleaked),
    ("mixing", mixed),
    ("shards", shards),
]

# Trained models, hash signatures and random draws have no SQL twin; the
# tests hold every stage against brute-force versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    folder = os.path.join(ensure_checkpoint_dir(spark), f"pipeline-{uuid.uuid4().hex}")
    for i, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{i}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        before, docs = docs, spark.read.parquet(path)
        if i:
            discard(before)
    return docs
