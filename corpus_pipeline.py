"""From raw documents to training shards: each stage works on all that the one before kept.

Toxic documents go, one document of each near-duplicate group stays, documents with benchmark passages go, the sources are
mixed to their weights (a document may stand several times then, or not at all), and what is left is dealt to shards in random
order. Every stage keeps the columns of ``documents``; the last adds ``shard`` and ``slot``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import decontamination, mixing, sharding, simhash, toxicity
from millrace.llm.queries import load
from millrace.session import materialize

# SQL cannot say the learned and the hashed stages; tests/llm checks each against a plain version.
ORACLE_SQL = None


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.reject(docs, load(spark, sf_dir, "labels"))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.near_dedup(docs, marks=True)


def unseen(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.decontaminate(docs, load(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.shards(docs)


STAGES = [
    ("toxicity", clean), ("simhash", distinct), ("decontamination", unseen), ("mixing", mixed), ("sharding", sharded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written before the next one reads it."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
