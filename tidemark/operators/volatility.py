"""Volatility estimates and anomaly statistics."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark import config as c
from tidemark.functions import scalar as S
from tidemark.operators import bars as B

EMA_LENGTH, EMA_REACH = 28, 520


def bins(bars: DataFrame) -> DataFrame:
    """Rogers-Satchell volatility of each 30-minute bin; bars with a price of 0 or less are left out."""
    good = bars.where((F.col("open") > 0) & (F.col("high") > 0) & (F.col("low") > 0) & (F.col("close") > 0))
    return B.rollup(good, c.VOL_BIN_MS).select("ticker_id", F.col("open_ts_ms").alias("bin_ts_ms"), S.rs_sigma().alias("sigma_pct"))


def ema(vol: DataFrame, length: int = EMA_LENGTH, reach: int = EMA_REACH) -> DataFrame:
    """Adds ``ema``: the mean of the first ``length`` bins while they last, then the recursion with 2/(length + 1).

    The recursion runs over the last ``reach`` bins; what lies before has a weight below 1e-16.
    """
    a = 2.0 / (length + 1)
    w = Window.partitionBy("ticker_id").orderBy("bin_ts_ms")
    n = F.row_number().over(w)
    seen = F.collect_list("sigma_pct").over(w.rowsBetween(-reach, 0))
    lead = F.aggregate(F.slice("seen", 1, length), F.lit(0.0), lambda s, x: s + x) / length
    start = F.when(F.col("n") <= reach + 1, lead).otherwise(F.col("seen")[0])
    rest = F.when(F.col("n") <= reach + 1, F.expr(f"slice(seen, {length + 1}, greatest(size(seen) - {length}, 0))")).otherwise(F.col("seen"))
    folded = F.aggregate(rest, start, lambda s, x: s * (1 - a) + x * a)
    early = F.avg("sigma_pct").over(w.rowsBetween(Window.unboundedPreceding, 0))
    t = vol.select("ticker_id", "bin_ts_ms", "sigma_pct", n.alias("n"), seen.alias("seen"), early.alias("early"))
    return t.select("ticker_id", "bin_ts_ms", "sigma_pct", F.when(F.col("n") <= length, F.col("early")).otherwise(folded).alias("ema"))


def blend(vol: DataFrame, days=(14, 60, 180), least: int = 5, fast: int = 3, cap: float = 8.0) -> DataFrame:
    """Adds ``blended``: the mean over windows of winsorized means (5th to 95th percentile), raised by recent spikes.

    Windows end before the bin itself. The spike is the largest of the last ``fast`` bins, at most ``cap`` times the mean.
    """
    order = Window.partitionBy("ticker_id").orderBy("bin_ts_ms")
    t = vol
    for d in days:
        w = order.rangeBetween(-d * c.DAY_MS, -1)
        t = t.withColumn(f"v{d}", F.sort_array(F.collect_list("sigma_pct").over(w)))

    def mean(name):
        v, n = F.col(name), F.size(name)
        low, high = (F.get(v, F.round((n - 1) * q).cast("int")) for q in (0.05, 0.95))
        held = F.when(n >= least, F.transform(v, lambda x: F.least(F.greatest(x, low), high))).otherwise(v)
        return F.when(n > 0, F.aggregate(held, F.lit(0.0), lambda s, x: s + x) / n)

    means = [mean(f"v{d}") for d in days]
    t = t.withColumn("mean", sum(means[1:], means[0]) / len(days))
    spike = F.max("sigma_pct").over(order.rowsBetween(-fast, -1))
    return t.select("ticker_id", "bin_ts_ms", "sigma_pct", F.greatest(F.col("mean"), F.least(spike, F.col("mean") * cap)).alias("blended"))


def parkinson(bars: DataFrame) -> DataFrame:
    """Annualised Parkinson volatility from daily highs and lows."""
    day = bars.groupBy("ticker_id", S.bucket(F.col("open_ts_ms"), c.DAY_MS).alias("day")).agg(F.max("high").alias("h"), F.min("low").alias("l"))
    x = F.log(F.col("h") / F.col("l"))
    return day.groupBy("ticker_id").agg((F.sqrt(F.avg(x * x) / (4 * math.log(2))) * math.sqrt(365)).alias("sigma"), F.count("*").alias("days"))


def returns(bars: DataFrame) -> DataFrame:
    w = Window.partitionBy("ticker_id").orderBy("open_ts_ms")
    return bars.withColumn("r", F.log(F.col("close") / F.lag("close").over(w))).where("r is not null").select("ticker_id", "open_ts_ms", "r")


def mad_outliers(r: DataFrame, limit: float = 8.0) -> DataFrame:
    """Per ticker: median and median absolute deviation of returns, how many lie beyond ``limit`` deviations, the worst."""
    med = r.groupBy("ticker_id").agg(F.median("r").alias("med"))
    dev = r.join(med, "ticker_id").withColumn("dev", F.abs(F.col("r") - F.col("med")))
    mad = dev.groupBy("ticker_id").agg(F.median("dev").alias("mad"))
    z = F.col("dev") / (F.col("mad") * 1.4826)
    j = dev.join(mad, "ticker_id").where("mad > 0")
    return j.groupBy("ticker_id").agg(F.first("med").alias("med"), F.first("mad").alias("mad"), F.count(F.when(z > limit, 1)).alias("outliers"), F.max(z).alias("worst"))


def cusum(r: DataFrame, k: float = 0.5, h: float = 8.0) -> DataFrame:
    """Alarms of the two-sided CUSUM over standardised returns; both sums restart after an alarm. Streams; holds a state."""
    stats = r.groupBy("ticker_id").agg(F.avg("r").alias("m"), F.stddev_samp("r").alias("s"))
    z = r.join(stats, "ticker_id").where("s > 0").select("ticker_id", "open_ts_ms", ((F.col("r") - F.col("m")) / F.col("s")).alias("z"))
    parts = int(r.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, up, down = None, 0.0, 0.0
        for pdf in batches:
            out = []
            for t, ts, x in zip(pdf["ticker_id"], pdf["open_ts_ms"], pdf["z"]):
                if t != now:
                    now, up, down = t, 0.0, 0.0
                up, down = max(0.0, up + x - k), max(0.0, down - x - k)
                if up > h or down > h:
                    out.append((t, ts, 1 if up > h else -1))
                    up = down = 0.0
            yield pd.DataFrame(out, columns=["ticker_id", "open_ts_ms", "side"])

    return z.repartition(parts, "ticker_id").sortWithinPartitions("ticker_id", "open_ts_ms").mapInPandas(run, "ticker_id bigint, open_ts_ms bigint, side int")
