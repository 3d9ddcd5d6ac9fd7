"""From raw documents to the shards of a training corpus.

Each stage is one operator over all documents that the stage before it kept, and is written
before the next one reads it. All but the last return the columns of ``documents``.

Defined results: documents without text fail the quality rules; repeated rows and rows without
doc_id are documents like others, so one of each group of copies stays; a NULL source is a source;
further columns of ``documents`` pass through (``shard`` and ``slot`` are replaced by the last
stage); without documents the result has no rows, without benchmark items none is left out for one.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sevscope.llm import decontam, mixing, quality, sharding, simhash
from sevscope.llm.common import table
from sevscope.session import write_stage


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality.keep(docs)


def unique(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies."""
    return simhash.keep_one(docs)


def unseen(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's rate has them."""
    return mixing.mix(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixed documents with their shard and slot."""
    return sharding.place(docs)


STAGES = [("quality", good), ("near_dedup", unique), ("decontaminate", unseen), ("mix", mixed), ("shard", sharded)]

#: Fingerprints and hash-ordered shards are beyond SQL; tests/llm holds the result against plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = write_stage(stage(spark, docs, sf_dir), f"corpus-{name}")
    return docs
