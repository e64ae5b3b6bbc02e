"""Filters on ticks and records; none of them shuffles unless it looks at preceding rows."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark import config as c
from tidemark.functions import scalar as S


def valid_quotes(df: DataFrame) -> DataFrame:
    return df.where((F.col("bid") > 0) & (F.col("ask") > 0) & (F.col("ask") >= F.col("bid")))


def skip_sentinels(df: DataFrame) -> DataFrame:
    return df.where(F.col("flags").bitwiseAND(F.lit(c.SENTINEL)) == 0)


def finite_mid(df: DataFrame) -> DataFrame:
    m = S.mid()
    return df.where(~F.isnan(m) & (m > 0) & (m < float("inf")))


def zscore_gate(df: DataFrame, limit: float = 6.0, keys=("ticker_id", "provider_id"), order=("ts_ms", "event_id"), depth: int = 500) -> DataFrame:
    """Adds ``rejected_z``: the mid is further than ``limit`` deviations from the mean of the ``depth`` rows before it."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(-depth, -1)
    mean, dev = F.avg(S.mid()).over(w), F.stddev_samp(S.mid()).over(w)
    return df.withColumn("rejected_z", F.coalesce((dev > 0) & (F.abs(S.mid() - mean) > limit * dev), F.lit(False)))


def late(df: DataFrame, ms: int, arrival=("event_id",), keys=("ticker_id",)) -> DataFrame:
    """Adds ``is_late``: the row's bucket is before the latest one that arrived earlier."""
    w = Window.partitionBy(*keys).orderBy(*arrival).rowsBetween(Window.unboundedPreceding, -1)
    b = S.bucket(F.col("ts_ms"), ms)
    return df.withColumn("is_late", F.coalesce(b < F.max(b).over(w), F.lit(False)))


def between(df: DataFrame, start_ms: int | None = None, end_ms: int | None = None) -> DataFrame:
    if start_ms is not None:
        df = df.where(F.col("ts_ms") >= start_ms)
    return df if end_ms is None else df.where(F.col("ts_ms") <= end_ms)


def closed_days(df: DataFrame, today: date | None = None) -> DataFrame:
    return df.where(S.utc_date(F.col("ts_ms")) < (F.lit(today) if today else F.current_date()))


def without_providers(df: DataFrame, denied: DataFrame) -> DataFrame:
    return df.join(denied.select("provider_id"), "provider_id", "left_anti")


def bootstrap_discard(df: DataFrame, days: int = 27) -> DataFrame:
    """Rows from ``days`` after each ticker's first on."""
    first = df.groupBy("ticker_id").agg(F.min("ts_ms").alias("first_ms"))
    return df.join(first, "ticker_id").where(F.col("ts_ms") >= F.col("first_ms") + days * c.DAY_MS).drop("first_ms")


def trailing(df: DataFrame, days: int) -> DataFrame:
    """Rows within ``days`` of each ticker's last."""
    last = df.groupBy("ticker_id").agg(F.max("ts_ms").alias("last_ms"))
    return df.join(last, "ticker_id").where(F.col("ts_ms") >= F.col("last_ms") - days * c.DAY_MS).drop("last_ms")


def plausible_dates(df: DataFrame, year: int) -> DataFrame:
    """Without rows dated ``year`` + 1 or later."""
    return df.where(F.year(S.utc_date(F.col("ts_ms"))) <= year)


def retained(df: DataFrame, existing: DataFrame, cutoff_ms: int) -> DataFrame:
    """New rows only: after the cutoff and after what each ticker has already."""
    mark = existing.groupBy("ticker_id").agg(F.max("ts_ms").alias("mark"))
    j = df.join(mark, "ticker_id", "left").where((F.col("ts_ms") >= cutoff_ms) & (F.col("mark").isNull() | (F.col("ts_ms") > F.col("mark"))))
    return j.drop("mark")


def delta_gate(df: DataFrame, values=("bid", "ask", "vbid", "vask", "ci_ubp"), order=("ts_ms", "event_id")) -> DataFrame:
    """Drops rows whose values repeat the row before, except a UTC day's first; so no window is longer than a day."""
    w = Window.partitionBy("ticker_id", F.floor(F.col("ts_ms") / c.DAY_MS)).orderBy(*order)
    own = F.struct(*values)
    before = F.lag(own).over(w)
    return df.withColumn("_keep", before.isNull() | ~own.eqNullSafe(before)).where("_keep").drop("_keep")


def own_ticker(df: DataFrame, shard_ticker: str = "shard_ticker_id") -> DataFrame:
    """Without records that were written to another ticker's shard; the shard's id counts."""
    return df.where(F.col("ticker_id") == F.col(shard_ticker))
