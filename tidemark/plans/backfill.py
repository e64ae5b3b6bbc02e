"""The whole pipeline as stages of DataFrames, resumable by stage, and the calibration run over a roster."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import config as c
from tidemark.functions import scalar as S
from tidemark.operators import bars as B
from tidemark.operators import filters as D
from tidemark.operators import merge as M
from tidemark.operators import quality as Q
from tidemark.operators import renko as R
from tidemark.operators import storage as W
from tidemark.operators import volatility as V

STAGES = ("index", "merge", "bars", "vol", "renko", "validate")


@dataclass(frozen=True)
class Settings:
    cycle_ms: int = 200
    bar_ms: int = c.S10_MS
    z_limit: float = 6.0
    stale_secs: int = c.STALE_SECS
    weights: dict[int, float] = field(default_factory=dict)
    k: float = 0.5
    min_pct: float = 0.0005


def index(ticks: DataFrame, s: Settings) -> DataFrame:
    """Each provider's index records: broken quotes and outliers out, a record a cycle."""
    keep = D.zscore_gate(D.valid_quotes(ticks), s.z_limit).where(~F.col("rejected_z"))
    out = B.cycles(keep, s.cycle_ms).withColumnRenamed("boundary_ms", "ts_ms")
    return out.withColumns({"event_id": F.col("provider_id").cast("bigint"), "flags": F.lit(c.BACKFILL), "accepted": F.lit(1), "rejected": F.lit(0), "confidence": F.lit(1), "ci_ubp": F.lit(0.0)})


def merge(idx: DataFrame, s: Settings) -> DataFrame:
    """The composite of all providers."""
    out = M.tdwap(M.provider_state(idx, s.cycle_ms), s.weights, s.stale_secs).withColumnRenamed("boundary_ms", "ts_ms")
    return out.withColumns({"event_id": F.lit(0).cast("bigint"), "provider_id": F.lit(0), "rejected": F.lit(0), "confidence": F.col("accepted"), "ci_ubp": F.lit(0.0), "tick_count": F.lit(1)})


def bars(composite: DataFrame, s: Settings) -> DataFrame:
    return B.gap_fill(B.ohlc(D.skip_sentinels(D.finite_mid(composite)), s.bar_ms), s.bar_ms)


def vol(bars_: DataFrame, s: Settings) -> DataFrame:
    return V.ema(V.bins(bars_)).select("ticker_id", "bin_ts_ms", F.col("ema").alias("sigma_pct"))


def renko(composite: DataFrame, vol_: DataFrame, s: Settings, params: DataFrame | None = None) -> DataFrame:
    """Bricks with each ticker's own k where there is one."""
    t = M.sigma_lookup(D.skip_sentinels(D.finite_mid(composite)), vol_)
    if params is not None:
        t = t.join(params.select("ticker_id", F.col("k").alias("_k")), "ticker_id", "left").withColumn("sigma", F.col("sigma") * F.coalesce("_k", F.lit(s.k)) / s.k)
    return R.bricks(R.sized(t, s.k, s.min_pct))


def validate(composite: DataFrame) -> DataFrame:
    return Q.verdict(Q.record_findings(composite), composite.groupBy("ticker_id").agg(F.count("*").alias("rows")))


def run(spark: SparkSession, ticks: DataFrame, root: str, s: Settings = Settings(), steps: Sequence[str] = STAGES, resume: bool = False, params: DataFrame | None = None) -> DataFrame:
    """Writes every stage below ``root`` and returns the verdicts.

    With ``resume``, a stage is taken as done if its manifest still equals what its rows say.
    """

    def done(name: str) -> bool:
        if not resume:
            return False
        try:
            rows, noted = spark.read.parquet(f"{root}/{name}"), spark.read.parquet(f"{root}/manifests/{name}")
        except Exception as e:  # not written yet
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return False
        return W.same_shards(W.manifest(rows.drop("date"), noted.first()["ts_name"]), noted.drop("ts_name")).limit(1).count() == 0

    def stage(name: str, make: Callable[[], DataFrame], ts: str) -> DataFrame:
        if name in steps and not done(name):
            W.write_shards(make(), f"{root}/{name}", ts)
            W.manifest(spark.read.parquet(f"{root}/{name}").drop("date"), ts).withColumn("ts_name", F.lit(ts)).write.mode("overwrite").parquet(f"{root}/manifests/{name}")
        return spark.read.parquet(f"{root}/{name}").drop("date")

    idx = stage("index", lambda: index(ticks, s), "ts_ms")
    composite = stage("merge", lambda: merge(idx, s), "ts_ms")
    b = stage("bars", lambda: bars(composite, s), "open_ts_ms")
    v = stage("vol", lambda: vol(b, s), "bin_ts_ms")
    stage("renko", lambda: renko(composite, v, s, params), "ts_ms")
    out = validate(composite)
    if "validate" in steps:
        out.write.mode("overwrite").json(f"{root}/report")
    return out


def calibration_run(spark: SparkSession, path: DataFrame, roster: DataFrame, store: str, run_id: str, s: c.Calibration = c.Calibration(), forced: dict[int, float] | None = None) -> DataFrame:
    """Fits k of the roster's tickers that this run lacks, stages them under ``run_id``, and returns the whole set.

    Forced values replace fitted ones. The caller promotes the set by publishing the run's partition.
    """
    try:
        todo = W.pending(roster, spark, store, run_id)
    except Exception as e:  # the first run
        if "PATH_NOT_FOUND" not in str(e):
            raise
        todo = roster
    fitted = R.calibrate(path.join(todo.select("ticker_id"), "ticker_id", "left_semi"), s)
    if forced:
        known = F.create_map(*(F.lit(x) for kv in forced.items() for x in kv))
        fitted = fitted.withColumn("k", F.coalesce(known[F.col("ticker_id")], "k"))
    fitted.withColumn("run_id", F.lit(run_id)).write.mode("append").partitionBy("run_id").parquet(store)
    return spark.read.parquet(store).where(F.col("run_id") == run_id)


def drift_gate(path: DataFrame, days: int = 90, s: c.Calibration = c.Calibration(), limit: float = 0.05) -> DataFrame:
    """k of the first and the last ``days`` of each ticker with at least twice as many, and how far it moved."""
    span = path.groupBy("ticker_id").agg(F.min("ts_ms").alias("a"), F.max("ts_ms").alias("b")).where(F.col("b") - F.col("a") >= 2 * days * c.DAY_MS)
    t = path.join(span, "ticker_id")
    first = R.calibrate(t.where(F.col("ts_ms") < F.col("a") + days * c.DAY_MS).drop("a", "b"), s)
    last = R.calibrate(t.where(F.col("ts_ms") >= F.col("b") - days * c.DAY_MS).drop("a", "b"), s)
    return R.drift(first, last, limit)


def with_mid(t: DataFrame) -> DataFrame:
    return t.select("ticker_id", "ts_ms", "event_id", S.mid().alias("mid"), "sigma")
