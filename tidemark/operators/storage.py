"""Shards, manifests, rekeying and the parameter store, over Parquet partitioned by ticker and UTC date."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import scalar as S


def write_shards(df: DataFrame, path: str, ts: str = "ts_ms", today: date | None = None) -> None:
    """Replaces the days that ``df`` holds and no others; today's rows stay out. Rows of a shard are in time order."""
    day = S.utc_date(F.col(ts))
    closed = df.withColumn("date", day).where(F.col("date") < (F.lit(today) if today else F.current_date()))
    out = closed.repartition("ticker_id", "date").sortWithinPartitions("ticker_id", "date", ts)
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("ticker_id", "date").parquet(path)


def read_shards(spark: SparkSession, path: str, start: date | None = None, end: date | None = None) -> DataFrame:
    df = spark.read.option("ignoreCorruptFiles", "true").parquet(path)
    if start:
        df = df.where(F.col("date") >= F.lit(start))
    return df.where(F.col("date") <= F.lit(end)) if end else df


def manifest(df: DataFrame, ts: str = "ts_ms") -> DataFrame:
    """A row for each shard: first, last, count, and a digest that doesn't depend on the rows' order."""
    key = F.conv(F.substring(F.md5(F.concat_ws("|", *(F.col(x).cast("string") for x in sorted(df.columns)))), 1, 8), 16, 10).cast("bigint")
    return df.groupBy("ticker_id", S.utc_date(F.col(ts)).alias("date")).agg(F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"), F.count("*").alias("n_records"), F.sum(key).alias("digest"))


def rekey(df: DataFrame, ids: DataFrame) -> DataFrame:
    """Renames ticker ids by a small map (old_id, new_id); ids that it lacks stay."""
    return df.join(ids, df["ticker_id"] == ids["old_id"], "left").withColumn("ticker_id", F.coalesce("new_id", "ticker_id")).drop("old_id", "new_id")


def same_shards(a: DataFrame, b: DataFrame) -> DataFrame:
    """Manifest rows that only one of both has."""
    return a.exceptAll(b).withColumn("side", F.lit("a")).union(b.exceptAll(a).withColumn("side", F.lit("b")))


def heal_tree(spark: SparkSession, path: str, target: str, ms: int = 200, today: date | None = None) -> None:
    """Heals every closed day of a tree into another tree; days route by timestamp, so strays land in their own shard."""
    from tidemark.operators.bars import heal

    src = read_shards(spark, path).drop("date")
    write_shards(heal(src, ms), target, today=today)


def save_params(params: DataFrame, path: str, run_id: str) -> None:
    """One partition for each run; a rerun replaces its own alone."""
    params.withColumn("run_id", F.lit(run_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(path)


def pending(roster: DataFrame, spark: SparkSession, path: str, run_id: str) -> DataFrame:
    """Tickers that a run has not calibrated yet."""
    return roster.join(spark.read.parquet(path).where(F.col("run_id") == run_id).select("ticker_id"), "ticker_id", "left_anti")
