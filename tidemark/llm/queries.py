"""The queries of this subpackage: each operator over its whole table, with production parameters."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontamination, language_id, mixing, pii, secrets, sharding, simhash, substring_dedup, topk, training_order
from tidemark.llm.common import table

#: Folder of the public vocabulary files; TIDEMARK_TOKENIZERS names another.
TOKENIZERS = "/opt/tokenizers"
#: Pre-tokenisation of the 50k byte-level vocabulary (a fixed value of that vocabulary).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
END_OF_TEXT = 50256


def vocabulary(folder: str | None = None, name: str = "byte_bpe_50k.tiktoken") -> bytes:
    with open(os.path.join(folder or os.environ.get("TIDEMARK_TOKENIZERS", TOKENIZERS), name), "rb") as f:
        return f.read()


def _count(kind: str):
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")


def op1_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = training_order.training_order(table(spark, sf_dir, "documents"), vocabulary(), PATTERN, END_OF_TEXT)
    return out.withColumn("record_crc32", F.crc32("record"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source", "quotas", "words")


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.secrets(table(spark, sf_dir, "documents"))
    count = {k: _count(k) for k in secrets.KINDS}
    base = F.sha2(secrets.digest(F.col("spans"), secrets.KINDS[:3]).cast("binary"), 256).alias("base_sha256")
    return found.select("doc_id", count["assign"], count["access"], count["hex"], base, secrets.digest(F.col("spans"), secrets.KINDS).alias("spans"), count["lit"])


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.deduplicate(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("bigint").alias("n_spans"), "kept_sha256", "n_passage")


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.shard(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    ids = F.sha2(F.concat_ws(",", "items").cast("binary"), 256)
    return out.select("doc_id", "n_words", "n_hit", "n_items", ids.alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"), "n_near")


def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), lambda i: F.pmod(i, F.lit(20)) == 0)


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.personal_data(table(spark, sf_dir, "documents"))
    count = [_count(k) for k in pii.KINDS]
    base = F.sha2(pii.digest(F.col("spans"), pii.KINDS[:4]).cast("binary"), 256).alias("base_sha256")
    return found.select("doc_id", *count[:4], base, pii.digest(F.col("spans"), pii.KINDS).alias("spans"), count[4])


def _held_out():
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    profiles = language_id.learn(docs.where(~_held_out()))
    return language_id.predict(docs, profiles).select("doc_id", _held_out().alias("held_out"), "lang_pred", "score")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


QUERIES = {
    f.__name__: f
    for f in (op1_training_order, op2_mixing, op3_secrets, op4_suffix_dedup, op5_sharding, op6_decontamination, op7_topk, op8_pii, op9_language_id, op10_simhash)
}
