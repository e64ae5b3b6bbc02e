"""Aggregations of ticks and records into cycles, bars and coarser bars.

All group by ticker and time bucket, so a busy ticker spreads over its buckets and partial aggregation works map-side.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark import config as c
from tidemark.functions import scalar as S


def capped(x, most):
    return F.least(x, F.lit(most)).cast("bigint")


def weighted(value: str, volume: str):
    """Volume-weighted mean, the plain mean without volume."""
    return F.coalesce(F.sum(F.col(value) * F.col(volume)) / F.nullif(F.sum(volume), F.lit(0)), F.avg(value))


def cycles(df: DataFrame, ms: int) -> DataFrame:
    """A record for each non-empty cycle of a provider, stamped with the cycle's end; cycles count from its first tick."""
    anchor = df.groupBy("ticker_id", "provider_id").agg(F.min("ts_ms").alias("anchor"))
    j = df.join(anchor, ["ticker_id", "provider_id"])
    end = F.col("anchor") + (F.floor((F.col("ts_ms") - F.col("anchor")) / ms) + 1) * ms
    return j.groupBy("ticker_id", "provider_id", end.cast("bigint").alias("boundary_ms")).agg(
        weighted("bid", "vbid").alias("bid"), weighted("ask", "vask").alias("ask"),
        capped(F.sum("vbid"), c.U32).alias("vbid"), capped(F.sum("vask"), c.U32).alias("vask"), capped(F.count("*"), c.U16).alias("tick_count"),
    )


def ohlc(df: DataFrame, ms: int, order=("ts_ms", "event_id")) -> DataFrame:
    """Time bars over mids; sentinels and broken quotes must be filtered before."""
    m, o = S.mid(), F.struct(*order)
    b = S.bucket(F.col("ts_ms"), ms)
    return (
        df.groupBy("ticker_id", b.alias("open_ts_ms"))
        .agg(F.min_by(m, o).alias("open"), F.max(m).alias("high"), F.min(m).alias("low"), F.max_by(m, o).alias("close"), F.sum("vbid").alias("vbid"), F.sum("vask").alias("vask"), F.count("*").alias("tick_count"))
        .withColumn("close_ts_ms", F.col("open_ts_ms") + (ms - 1))
    )


def microstructure(df: DataFrame, ms: int, order=("ts_ms", "event_id")) -> DataFrame:
    """Realized and bipower variance, drift, imbalance, spread, largest return and reject rate of each bar."""
    t = df.withColumn("b", S.bucket(F.col("ts_ms"), ms)).withColumn("lm", F.log(S.mid()))
    w = Window.partitionBy("ticker_id", "b").orderBy(*order)
    t = t.withColumn("r", F.col("lm") - F.lag("lm").over(w))
    t = t.withColumn("r1", F.lag("r").over(w))
    volume = F.sum("vbid") + F.sum("vask")
    book = F.col("flags").bitwiseAND(F.lit(c.NO_BOOK)) == 0
    tried = F.sum("accepted") + F.sum("rejected")
    return t.groupBy("ticker_id", F.col("b").alias("open_ts_ms")).agg(
        F.coalesce(F.sum(F.col("r") * F.col("r")), F.lit(0.0)).alias("realized_var"),
        F.coalesce(F.sum(F.abs("r") * F.abs("r1")) * (math.pi / 2), F.lit(0.0)).alias("bipower_var"),
        F.regr_slope("lm", (F.col("ts_ms") - F.col("b")) / 1000.0).alias("drift"),
        F.when(volume > 0, (F.sum("vask") - F.sum("vbid")) / volume).otherwise(0.0).alias("vol_imbalance"),
        F.avg(F.when(book, S.spread_bps())).alias("avg_spread_bps"),
        F.coalesce(F.max(F.abs("r")), F.lit(0.0)).alias("max_abs_return"),
        (F.sum("rejected") / F.nullif(tried, F.lit(0))).alias("reject_rate"),
    )


def gap_fill(bars: DataFrame, ms: int) -> DataFrame:
    """Flat bars of the last close between each ticker's first and last bar.

    Each bar makes the empty buckets up to the next one, so there is no grid to join with.
    """
    w = Window.partitionBy("ticker_id").orderBy("open_ts_ms")
    reach = F.coalesce(F.lead("open_ts_ms").over(w) - ms, F.col("open_ts_ms"))
    long = bars.withColumn("reach", reach).withColumn("at", F.explode(F.sequence("open_ts_ms", "reach", F.lit(ms))))
    real = F.col("at") == F.col("open_ts_ms")
    price = [F.when(real, F.col(x)).otherwise(F.col("close")).alias(x) for x in ("open", "high", "low", "close")]
    total = [F.when(real, F.col(x)).otherwise(0).cast("bigint").alias(x) for x in ("vbid", "vask", "tick_count")]
    return long.select("ticker_id", F.col("at").alias("open_ts_ms"), *price, *total, (F.col("at") + (ms - 1)).alias("close_ts_ms"))


def rollup(bars: DataFrame, ms: int) -> DataFrame:
    """Coarser bars: first, max, min, last and sums. The operation is associative."""
    return (
        bars.groupBy("ticker_id", S.bucket(F.col("open_ts_ms"), ms).alias("b"))
        .agg(*(f(F.col(x), F.col("open_ts_ms")).alias(x) for f, x in ((F.min_by, "open"), (F.max_by, "close"))), F.max("high").alias("high"), F.min("low").alias("low"), *(F.sum(x).alias(x) for x in ("vbid", "vask", "tick_count")))
        .withColumnRenamed("b", "open_ts_ms")
        .withColumn("close_ts_ms", F.col("open_ts_ms") + (ms - 1))
    )


def heal(df: DataFrame, ms: int, single_verbatim: bool = True) -> DataFrame:
    """Merges records of the same bin: weighted quotes, saturated sums, pooled confidence interval, greatest counts."""
    n = F.count("*")
    volume = F.col("vbid") + F.col("vask")
    square = F.col("ci_ubp") * F.col("ci_ubp")

    def pooled(weight):
        return F.sqrt(F.sum(square * weight) / F.nullif(F.sum(weight), F.lit(0)))

    ci = F.coalesce(pooled(volume), pooled(F.col("tick_count")), F.max("ci_ubp"))
    flags = F.bit_or("flags")
    healed = F.when(n == 1, flags).otherwise(flags.bitwiseOR(F.lit(c.HEALED))) if single_verbatim else flags.bitwiseOR(F.lit(c.HEALED))
    return df.groupBy("ticker_id", S.bucket(F.col("ts_ms"), ms).alias("ts_ms")).agg(
        weighted("bid", "vbid").alias("bid"), weighted("ask", "vask").alias("ask"), capped(F.sum("vbid"), c.U32).alias("vbid"), capped(F.sum("vask"), c.U32).alias("vask"),
        ci.alias("ci_ubp"), capped(F.sum("tick_count"), c.U16).alias("tick_count"), *(F.max(x).alias(x) for x in ("confidence", "accepted", "rejected")), healed.alias("flags"),
    )


def resample_last(df: DataFrame, ms: int, order=("ts_ms", "event_id")) -> DataFrame:
    """Each bin's last record, stamped with the bin's start and marked."""
    keep = [x for x in df.columns if x not in ("ticker_id", "ts_ms", "flags")]
    last = F.max_by(F.struct(*keep, "flags"), F.struct(*order))
    out = df.groupBy("ticker_id", S.bucket(F.col("ts_ms"), ms).alias("bin_ms")).agg(last.alias("r"))
    return out.select("ticker_id", F.col("bin_ms").alias("ts_ms"), *(F.col(f"r.{x}").alias(x) for x in keep), F.col("r.flags").bitwiseOR(F.lit(c.HEALED)).alias("flags"))
