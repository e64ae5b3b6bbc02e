"""Seeded synthetic price paths.

Parameters are annual; a step is 500 ms. Paths of many tickers are generated side by side; each is a product of step
returns, taken as a running sum of logarithms in one ordered window per ticker and path. Heston's volatility depends on
its own past and is folded per ticker.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

STEP_MS = 500
YEAR_MS = 365 * 86_400_000


def _noise(key: str, seed: int):
    """Standard normal from two hashes (Box-Muller); the same for the same seed, ticker and step, however partitioned."""
    u = [(F.pmod(F.xxhash64(F.lit(seed), F.lit(key), F.lit(i), "ticker_id", "i"), F.lit(1 << 52)) + 1) / float((1 << 52) + 1) for i in (0, 1)]
    return F.sqrt(F.log(u[0]) * -2) * F.cos(u[1] * (2 * np.pi))


def _uniform(key: str, seed: int):
    return F.pmod(F.xxhash64(F.lit(seed), F.lit(key), "ticker_id", "i"), F.lit(1 << 52)) / float(1 << 52)


def _paths(spark: SparkSession, tickers: int, steps: int, start_ms: int, s0: float, step_log) -> DataFrame:
    grid = spark.range(tickers * steps).select((F.col("id") / steps).cast("bigint").alias("ticker_id"), (F.col("id") % steps).alias("i"))
    t = grid.withColumn("d", step_log)
    w = Window.partitionBy("ticker_id").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    return t.select("ticker_id", (F.lit(start_ms) + F.col("i") * STEP_MS).alias("ts_ms"), (F.lit(s0) * F.exp(F.sum("d").over(w))).alias("price"))


def gbm(spark, tickers: int, steps: int, mu=0.0, sigma=0.5, s0=100.0, seed=1, start_ms=1_704_067_200_000) -> DataFrame:
    dt = STEP_MS / YEAR_MS
    return _paths(spark, tickers, steps, start_ms, s0, F.lit((mu - sigma * sigma / 2) * dt) + _noise("z", seed) * (sigma * dt**0.5))


def scaled_gbm(spark, tickers: int, steps: int, hurst=0.7, mu=0.0, sigma=0.5, s0=100.0, seed=1, start_ms=1_704_067_200_000) -> DataFrame:
    """Noise scaled by 1 + 2 (H - 1/2): no long memory."""
    dt = STEP_MS / YEAR_MS
    return _paths(spark, tickers, steps, start_ms, s0, F.lit((mu - sigma * sigma / 2) * dt) + _noise("z", seed) * (sigma * dt**0.5 * (1 + 2 * (hurst - 0.5))))


def merton(spark, tickers: int, steps: int, rate=50.0, jump_mu=0.0, jump_sigma=0.02, sigma=0.5, s0=100.0, seed=1, start_ms=1_704_067_200_000) -> DataFrame:
    """Normal jumps at ``rate`` a year."""
    dt = STEP_MS / YEAR_MS
    jump = F.when(_uniform("n", seed) < rate * dt, F.lit(jump_mu) + _noise("j", seed) * jump_sigma).otherwise(0.0)
    return _paths(spark, tickers, steps, start_ms, s0, F.lit(-sigma * sigma / 2 * dt) + _noise("z", seed) * (sigma * dt**0.5) + jump)


def kou(spark, tickers: int, steps: int, rate=50.0, up=0.5, eta_up=50.0, eta_down=50.0, sigma=0.5, s0=100.0, seed=1, start_ms=1_704_067_200_000) -> DataFrame:
    """Exponential jumps, upwards with probability ``up``."""
    dt = STEP_MS / YEAR_MS
    size = -F.log(F.greatest(_uniform("e", seed), F.lit(1e-15)))
    jump = F.when(_uniform("n", seed) < rate * dt, F.when(_uniform("s", seed) < up, size / eta_up).otherwise(-size / eta_down)).otherwise(0.0)
    return _paths(spark, tickers, steps, start_ms, s0, F.lit(-sigma * sigma / 2 * dt) + _noise("z", seed) * (sigma * dt**0.5) + jump)


def heston(spark, tickers: int, steps: int, kappa=2.0, theta=0.25, xi=0.5, rho=-0.5, s0=100.0, seed=1, start_ms=1_704_067_200_000, floor=1e-4) -> DataFrame:
    dt = STEP_MS / YEAR_MS
    grid = spark.range(tickers * steps).select((F.col("id") / steps).cast("bigint").alias("ticker_id"), (F.col("id") % steps).alias("i"))
    noise = grid.select("ticker_id", "i", _noise("z", seed).alias("a"), _noise("v", seed).alias("b"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now = price = var = None
        for pdf in batches:
            out = []
            for t, i, a, b in zip(pdf["ticker_id"], pdf["i"], pdf["a"], pdf["b"]):
                if t != now:
                    now, price, var = t, s0, theta
                price *= float(np.exp(-var / 2 * dt + (var * dt) ** 0.5 * a))
                var = max(floor, var + kappa * (theta - var) * dt + xi * (var * dt) ** 0.5 * (rho * a + (1 - rho * rho) ** 0.5 * b))
                out.append((t, start_ms + i * STEP_MS, price))
            yield pd.DataFrame(out, columns=["ticker_id", "ts_ms", "price"])

    return noise.repartition(parts, "ticker_id").sortWithinPartitions("ticker_id", "i").mapInPandas(run, "ticker_id bigint, ts_ms bigint, price double")


MODELS = {"gbm": gbm, "scaled_gbm": scaled_gbm, "heston": heston, "merton": merton, "kou": kou}


def quotes(prices: DataFrame, seed: int = 1) -> DataFrame:
    """Prices as quotes: one basis point of spread; a seeded coin puts a volume below 10,000 on one side."""
    h = F.xxhash64(F.lit(seed), "ticker_id", "ts_ms")
    volume = F.pmod(h, F.lit(10_000))
    buyer = F.pmod(F.shiftright(h, 20), F.lit(2)) == 0
    half = F.col("price") * 0.00005
    return prices.select("ticker_id", F.lit(0).alias("provider_id"), "ts_ms", (F.col("price") - half).alias("bid"), (F.col("price") + half).alias("ask"), F.when(buyer, 0).otherwise(volume).alias("vbid"), F.when(buyer, volume).otherwise(0).alias("vask"))
