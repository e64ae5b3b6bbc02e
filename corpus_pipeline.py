"""A training-corpus pipeline: language ID, SimHash near-dedup, decontamination, mixing, sharding.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it kept. All but the last return the columns
of ``docs``; the last returns (doc_id, size, text_crc32, shard, slot). Empty tables, nulls, repeated rows and other
columns are dealt with as the operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontamination, language_id, mixing, sharding, simhash
from tidemark.llm.common import staged, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from the labelled documents; rejects texts whose language is not identified."""
    profiles = language_id.learn(docs)
    return language_id.identified(docs, profiles, language_id.least_scores(docs, profiles))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies (five-word shingles, similarity 0.8)."""
    return simhash.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold ten consecutive words of a benchmark item."""
    return decontamination.uncontaminated(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes sources by weight; documents come up to three times."""
    return mixing.mixed(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Gives each document a shard of 16 and a slot in it."""
    return sharding.shard(docs).select("doc_id", "size", "text_crc32", "shard", "slot")


STAGES = [("language_id", language), ("simhash_near_dedup", near_dedup), ("decontamination", decontaminate), ("mixing", mix), ("sharding", shard)]

#: Profiles, fingerprints and seeded orders are beyond SQL; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
