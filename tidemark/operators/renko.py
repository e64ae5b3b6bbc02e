"""Renko bricks: the fold, its counts, and calibration of the multiplier k.

Brick size is snap(price * max(k * sigma, min_pct)), a column that is computed before the fold. The fold itself is
path-dependent: it streams each ticker's ticks in order, in Arrow batches, and holds one small state, so a ticker need
not fit in memory. The solver replays paths and takes one ticker's (time, mid, sigma) as arrays.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark import config as c
from tidemark.functions import scalar as S


@dataclass
class State:
    """Where the fold stands: the last close and how many ticks in a row were too far from it."""

    last: float | None = None
    trips: int = 0

    def step(self, mid: float, brick: float) -> tuple[float, int]:
        """(open of the first brick, signed number of bricks) that this tick completes."""
        if self.last is None:
            self.last = mid
            return mid, 0
        if abs(mid - self.last) / self.last > c.MAX_JUMP:
            self.trips += 1
            if self.trips >= c.RESEED_AFTER:
                self.last, self.trips = mid, 0
            return self.last, 0
        self.trips = 0
        n = min(c.MAX_BRICKS, int(abs(mid - self.last) / brick + 1e-9))
        first = self.last
        if n:
            n = n if mid > first else -n
            self.last = first + n * brick
        return first, n


def sized(ticks: DataFrame, k: float = 0.5, min_pct: float = 0.0005) -> DataFrame:
    """(ticker_id, ts_ms, event_id, mid, brick) of ticks with a ``sigma``."""
    m = S.mid()
    return ticks.select("ticker_id", "ts_ms", "event_id", m.alias("mid"), S.snap(m * F.greatest(F.col("sigma") * k, F.lit(min_pct)), m).alias("brick"))


def bricks(path: DataFrame) -> DataFrame:
    """(ticker_id, seq, ts_ms, open, close): the bricks of each ticker in order; a brick opens where the last one closed."""
    parts = int(path.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, state, seq = None, State(), 0
        for pdf in batches:
            out = []
            for t, ts, m, b in zip(pdf["ticker_id"], pdf["ts_ms"], pdf["mid"], pdf["brick"]):
                if t != now:
                    now, state, seq = t, State(), 0
                first, n = state.step(m, b)
                way = 1 if n > 0 else -1
                for i in range(abs(n)):
                    seq += 1
                    out.append((t, seq, ts, first + way * i * b, first + way * (i + 1) * b))
            yield pd.DataFrame(out, columns=["ticker_id", "seq", "ts_ms", "open", "close"])

    ordered = path.repartition(parts, "ticker_id").sortWithinPartitions("ticker_id", "ts_ms", "event_id")
    return ordered.mapInPandas(run, "ticker_id bigint, seq bigint, ts_ms bigint, open double, close double")


def per_day(b: DataFrame) -> DataFrame:
    return b.groupBy("ticker_id", S.utc_date(F.col("ts_ms")).alias("date")).agg(F.count("*").alias("n"))


def quarantine(days: DataFrame) -> DataFrame:
    """Per ticker: the median of non-zero days, and whether too few are left to trust it."""
    clean, n = F.count(F.when(F.col("n") > 0, 1)), F.count("*")
    floor = F.least(F.greatest(F.lit(3), F.floor(n / 2)), n)
    return days.groupBy("ticker_id").agg(clean.alias("clean"), n.alias("days"), F.median(F.when(F.col("n") > 0, F.col("n"))).alias("median"), (clean < floor).alias("dead"))


def clamp_fraction(ticks: DataFrame, k: float, min_pct: float) -> DataFrame:
    """Share of each ticker's ticks at which the floor, not volatility, sets the brick."""
    return ticks.groupBy("ticker_id").agg(F.avg(F.when(F.col("sigma") * k <= min_pct, 1.0).otherwise(0.0)).alias("fraction"))


def snapped(raw: np.ndarray, price: np.ndarray) -> np.ndarray:
    step = 2.5 * 10.0 ** (np.floor(np.log10(price)) - 4)
    return np.maximum(step, np.floor(raw / step + 0.5) * step)


def counts(ts: np.ndarray, mid: np.ndarray, sigma: np.ndarray, k: float, min_pct: float) -> np.ndarray:
    """Bricks of each UTC day from the first to the last."""
    size = snapped(mid * np.maximum(k * sigma, min_pct), mid)
    day = (ts // c.DAY_MS).astype(np.int64)
    out = np.zeros(int(day[-1] - day[0]) + 1, np.int64)
    state = State()
    for d, m, b in zip((day - day[0]).tolist(), mid.tolist(), size.tolist()):
        out[d] += abs(state.step(m, b)[1])
    return out


def median_count(n: np.ndarray) -> tuple[float, int]:
    """(median of non-zero days, clean days); 0 clean days if the window is dead."""
    clean = n[n > 0]
    if len(clean) < min(max(3, len(n) // 2), len(n)) or not len(clean):
        return 0.0, 0
    return float(np.median(clean)), len(clean)


def fit(ts: np.ndarray, mid: np.ndarray, sigma: np.ndarray, s: c.Calibration, prior: float | None = None) -> float:
    """The k whose median bricks a day meets the target; 0 if there is none.

    First two proportional steps from the prior, then a bracket in log k that widens upwards and is halved, then a
    look at the rungs next to the best.
    """
    if len(ts) < 2 or ts[-1] <= ts[0] or s.target <= 0:
        return 0.0
    seen: dict[float, tuple[float, int]] = {}

    def rate(k: float) -> float:
        if k not in seen:
            seen[k] = median_count(counts(ts, mid, sigma, k, s.min_pct))
        return seen[k][0]

    def bound(k: float) -> float:
        return min(max(k, s.low), s.high)

    def error(k: float) -> float:
        return abs(rate(k) / s.target - 1)

    k = bound(prior or 0.5)
    tried, done = [k], False
    if rate(k) >= 1:
        for _ in range(2):
            k = bound(k * rate(k) / s.target)
            tried.append(k)
            if error(k) <= s.tolerance:
                done = True
                break
            if rate(k) < 1:
                break
    if not done:
        low, high = math.log(s.low), math.log(min(s.high, max(*tried, 2 * s.low)))
        if rate(s.low) <= s.target:
            return 0.0
        while rate(math.exp(high)) >= s.target:
            if math.exp(high) >= s.high * (1 - 1e-12):
                return 0.0
            high = min(math.log(s.high), high + math.log(2))
        for _ in range(12):
            if high - low < c.LOG_RUNG:
                break
            m = (low + high) / 2
            low, high = (m, high) if rate(math.exp(m)) > s.target else (low, m)
        k = min((math.exp(low), math.exp(high)), key=lambda x: (error(x), x))
    for near in (k * math.exp(-c.LOG_RUNG), k * math.exp(c.LOG_RUNG)):
        if s.low <= near <= s.high and error(near) < error(k):
            k = near
    if not seen[k][1] or k <= s.low * 1.01 or np.mean(k * sigma <= s.min_pct) > s.clamp_limit:
        return 0.0
    return k


def calibrate(path: DataFrame, s: c.Calibration = c.Calibration()) -> DataFrame:
    """(ticker_id, k, median_bpd): one solver run per ticker, tickers in parallel. ``path``: ticker_id, ts_ms, event_id, mid, sigma."""

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["ts_ms", "event_id"])
        ts, m, v = (pdf[x].to_numpy() for x in ("ts_ms", "mid", "sigma"))
        k = fit(ts, m, v, s)
        rate = median_count(counts(ts, m, v, k, s.min_pct))[0] if k else 0.0
        return pd.DataFrame({"ticker_id": [pdf["ticker_id"].iloc[0]], "k": [k], "median_bpd": [rate]})

    return path.groupBy("ticker_id").applyInPandas(one, "ticker_id bigint, k double, median_bpd double")


def walk_forward(path: DataFrame, s: c.Calibration = c.Calibration(), warm_days: int = 3) -> DataFrame:
    """(ticker_id, date, k, bricks): each day's k is fitted on the days before it alone, from the day before's k."""

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["ts_ms", "event_id"])
        ts, m, v = (pdf[x].to_numpy() for x in ("ts_ms", "mid", "sigma"))
        day, out, k, state = ts // c.DAY_MS, [], 0.0, State()
        for d in range(int(day[0]) + warm_days, int(day[-1]) + 1):
            a, b = np.searchsorted(day, [d, d + 1])
            since = np.searchsorted(ts, d * c.DAY_MS - s.window_days * c.DAY_MS)
            k = fit(ts[since:a], m[since:a], v[since:a], s, k or None) or k
            if state.last is None and a:
                state.last = float(m[a - 1])
            size = snapped(m[a:b] * np.maximum((k or 0.5) * v[a:b], s.min_pct), m[a:b])
            n = sum(abs(state.step(x, y)[1]) for x, y in zip(m[a:b].tolist(), size.tolist()))
            out.append((pdf["ticker_id"].iloc[0], d, min(max(k, 0.001), 4.0) if k else 0.0, n))
        return pd.DataFrame(out, columns=["ticker_id", "day", "k", "bricks"])

    out = path.groupBy("ticker_id").applyInPandas(one, "ticker_id bigint, day int, k double, bricks bigint")
    return out.select("ticker_id", F.date_add(F.lit("1970-01-01").cast("date"), F.col("day")).alias("date"), "k", "bricks")


def window_sweep(path: DataFrame, windows=(90, 180, 365, 730), anchors: int = 6, forward: int = 90, s: c.Calibration = c.Calibration()) -> DataFrame:
    """Per window length: folds, failed fits, mean and largest error of the forward median. Every (ticker, window) is a task of its own."""

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["ts_ms", "event_id"])
        ts, m, v = (pdf[x].to_numpy() for x in ("ts_ms", "mid", "sigma"))
        w, out = int(pdf["window_days"].iloc[0]), []
        for i in range(anchors):
            at = ts[-1] - (i + 1) * forward * c.DAY_MS
            a, b, e = np.searchsorted(ts, [at - w * c.DAY_MS, at, at + forward * c.DAY_MS])
            if at - w * c.DAY_MS < ts[0] or b - a < 2 or e - b < 2:
                continue
            k = fit(ts[a:b], m[a:b], v[a:b], s)
            rate = median_count(counts(ts[b:e], m[b:e], v[b:e], k, s.min_pct))[0] if k else 0.0
            out.append((w, i, k, abs(rate / s.target - 1) if rate else None))
        return pd.DataFrame(out, columns=["window_days", "anchor", "k", "err"])

    lengths = F.explode(F.array(*map(F.lit, windows))).alias("window_days")
    folds = path.select("*", lengths).groupBy("ticker_id", "window_days").applyInPandas(one, "window_days int, anchor int, k double, err double")
    return folds.groupBy("window_days").agg(F.count("*").alias("folds"), F.count(F.when(F.col("err").isNull(), 1)).alias("failed"), F.avg("err").alias("mean_err"), F.max("err").alias("max_err"))


def drift(first: DataFrame, last: DataFrame, limit: float = 0.05) -> DataFrame:
    """Compares k of two calibrations."""
    j = first.select("ticker_id", F.col("k").alias("k_first")).join(last.select("ticker_id", F.col("k").alias("k_last")), "ticker_id")
    d = F.abs(F.col("k_last") - F.col("k_first")) / F.col("k_first")
    return j.withColumn("drift", d).withColumn("warn", F.coalesce(d > limit, F.lit(False)))


def k_distribution(k: DataFrame) -> DataFrame:
    good = k.where("k > 0")
    return good.agg(F.count("*").alias("n"), F.min("k").alias("least"), F.median("k").alias("median"), F.max("k").alias("most"), (F.max("k") - F.min("k")).alias("spread"))


def continuity(b: DataFrame, rel: float = 1e-9, floor: float = 1e-15) -> DataFrame:
    """Breaks between a day's last brick and the next day's first; within days by ``breaks``."""
    d = S.utc_date(F.col("ts_ms"))
    days = b.groupBy("ticker_id", d.alias("date")).agg(F.min_by("open", "seq").alias("first_open"), F.max_by("close", "seq").alias("last_close"))
    w = Window.partitionBy("ticker_id").orderBy("date")
    j = days.withColumn("before", F.lag("last_close").over(w)).where("before is not null")
    gap = F.abs(F.col("first_open") - F.col("before"))
    return j.select("ticker_id", "date", gap.alias("gap"), (gap > F.greatest(F.abs("before") * rel, F.lit(floor))).alias("broken"))
