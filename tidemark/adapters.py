"""The driver's tables as market data.

``ticks``: an event is a trade; its type is the ticker, its user the provider. ``records``: the trades as index records
with a spread and deterministic sentinels, crossed quotes and rows without a book.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import config as c
from tidemark.functions import scalar as S

TICKERS = ("click", "error", "purchase", "signup", "view")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def trades(events: DataFrame) -> DataFrame:
    ticker = F.array_position(F.array(*map(F.lit, TICKERS)), F.col("event_type"))
    return events.select(
        "event_id",
        ticker.cast("bigint").alias("ticker_id"),
        (F.col("user_id") % 4).cast("int").alias("provider_id"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("ts_ms"),
        (F.lit(100.0) + F.col("value") / 10).alias("price"),
        S.to_u32(F.col("value")).alias("volume"),
        (F.col("event_id") % 2 == 0).alias("is_buyer"),
    )


def ticks(events: DataFrame) -> DataFrame:
    return S.honest_ticks(trades(events), "event_id")


def records(events: DataFrame) -> DataFrame:
    e = F.col("event_id")
    t = ticks(events)
    book = e % 7 != 0
    flags = F.when(e % 97 == 0, c.SENTINEL).otherwise(0) + F.when(~book, c.NO_BOOK).otherwise(0)
    ask = F.when(e % 101 == 0, F.col("bid") - 0.05).when(book, F.col("bid") + 0.02).otherwise(F.col("bid"))
    return t.select(
        "event_id", "ticker_id", "provider_id", "ts_ms", "bid", ask.alias("ask"), "vbid", "vask",
        ((e % 50) / 10).alias("ci_ubp"), (1 + e % 9).cast("int").alias("tick_count"), (1 + e % 4).cast("int").alias("confidence"),
        (1 + e % 5).cast("int").alias("accepted"), (e % 3).cast("int").alias("rejected"), flags.cast("int").alias("flags"),
    )
