"""Command line: one subcommand for each operation, reading and writing Parquet trees.

python -m tidemark.cli COMMAND --input PATH [--output PATH] [options]. Checks end with 0 (fine), 1 (warnings) or 2 (errors).
"""

from __future__ import annotations

import argparse
import json
import sys
import urllib.request
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import config as c
from tidemark.functions import scalar as S
from tidemark.operators import audit as A
from tidemark.operators import bars as B
from tidemark.operators import filters as D
from tidemark.operators import merge as M
from tidemark.operators import quality as Q
from tidemark.operators import renko as R
from tidemark.operators import storage as W
from tidemark.plans import backfill as P
from tidemark.sources import trades

COMMANDS: dict = {}


def command(*options, checks: bool = False):
    """Registers a subcommand; an option is (name, default)."""

    def put(f):
        COMMANDS[f.__name__.replace("_", "-")] = (f, options, checks)
        return f

    return put


def shards(spark: SparkSession, a) -> DataFrame:
    start, end = (date.fromisoformat(x) if x else None for x in (a.from_date, a.to_date))
    return W.read_shards(spark, a.input, start, end)


def save(df: DataFrame, a, ts: str = "ts_ms") -> DataFrame:
    if a.output:
        W.write_shards(df.drop("date"), a.output, ts)
    return df


@command(("exchange", "binance"), ("pair", "BTC-USDT"), ("base-url", ""), ("ticker-id", 1), ("provider-id", 1), ("probe", False))
def fetch_crypto_history(spark, a):
    """Plans monthly and daily archives, downloads them to --input, and reads them as ticks; --probe tells what there is."""
    if a.probe:

        def there(url: str) -> bool:
            try:
                with urllib.request.urlopen(urllib.request.Request(url, method="HEAD"), timeout=15):
                    return True
            except OSError:
                return False

        found = trades.probe(a.exchange, a.pair, date.fromisoformat(a.from_date), date.fromisoformat(a.to_date), there)
        return spark.createDataFrame([found], "has_data boolean, first_month date, last_month date")

    def fetch(url: str) -> int:
        return trades.download(url, f"{a.input}/{url.rsplit('/', 1)[1]}")

    every = trades.months(spark, a.from_date, a.to_date)
    offered = F.lit(1 if a.base_url or trades.ARCHIVES[a.exchange][0] else 0)
    plan = trades.plan_archives(every, every.select("month_start", offered.alias("ticks")))
    if a.exchange == "bitget" and not a.base_url:
        trades.sequence_scan([r["date"] for r in plan.select("date").orderBy("date").collect()], a.pair, fetch)
    else:
        for r in plan.select(trades.archive_url(F.col("kind"), a.exchange, a.pair, F.col("date"), a.base_url).alias("url")).collect():
            fetch(r["url"])
    return save(trades.parse(trades.zip_lines(spark, a.input), a.exchange, a.ticker_id, a.provider_id), a)


@command(("url", ""), ("ticker-id", 1), ("provider-id", 9))
def fetch_pyth_history(spark, a):
    if a.url:
        trades.download(a.url, a.input)
    return save(trades.pyth_history(spark, a.input, a.ticker_id, a.provider_id), a)


@command(("cycle-ms", 200), ("z", 6.0))
def ticks_to_idx(spark, a):
    t = shards(spark, a)
    t = t if "event_id" in t.columns else t.withColumn("event_id", F.xxhash64("ts_ms", "bid", "ask", "vbid", "vask"))
    return save(P.index(t, P.Settings(cycle_ms=a.cycle_ms, z_limit=a.z)), a)


@command(("cycle-ms", 200), ("stale-secs", c.STALE_SECS), ("weight", ""))
def merge_idx(spark, a):
    """--weight 1=0.3,2=0.15"""
    weights = {int(k): float(v) for k, v in (x.split("=") for x in a.weight.split(",") if x)}
    return save(P.merge(shards(spark, a), P.Settings(cycle_ms=a.cycle_ms, stale_secs=a.stale_secs, weights=weights)), a)


@command(("bucket-ms", c.S10_MS))
def s10_from_idx(spark, a):
    return save(P.bars(shards(spark, a), P.Settings(bar_ms=a.bucket_ms)), a, "open_ts_ms")


@command()
def vol_from_s10(spark, a):
    return save(P.vol(shards(spark, a), P.Settings()), a, "bin_ts_ms")


@command(("vol", ""), ("k", 0.5), ("params", ""))
def renko_from_idx(spark, a):
    params = spark.read.parquet(a.params) if a.params else None
    return save(P.renko(shards(spark, a), spark.read.parquet(a.vol), P.Settings(k=a.k), params), a)


def _path(spark, a) -> DataFrame:
    return P.with_mid(M.sigma_lookup(D.skip_sentinels(D.finite_mid(shards(spark, a))), spark.read.parquet(a.vol)))


@command(("vol", ""), ("target", 300.0), ("warm-days", 27))
def renko_trailing_from_idx(spark, a):
    return R.walk_forward(_path(spark, a), c.Calibration(target=a.target), a.warm_days)


@command(("base", 1), ("quote", 2), ("synth", 3), ("ttl-ms", c.TTL_MS), ("bucket-ms", c.S10_MS))
def synth_backfill_from_idx(spark, a):
    t = D.skip_sentinels(D.finite_mid(shards(spark, a)))
    q = M.cross(t.where(F.col("ticker_id") == a.base), t.where(F.col("ticker_id") == a.quote), a.ttl_ms).where("fresh")
    zero = F.lit(0).cast("bigint")
    q = q.select(F.lit(a.synth).cast("bigint").alias("ticker_id"), "ts_ms", (F.col("event_id") * 2 + F.col("leg")).alias("event_id"), "bid", "ask", zero.alias("vbid"), zero.alias("vask"))
    return save(B.gap_fill(B.ohlc(q, a.bucket_ms), a.bucket_ms), a, "open_ts_ms")


@command(("vol", ""), ("target", 300.0), ("window-days", 730), ("run-id", "run"))
def calibrate(spark, a):
    p = _path(spark, a)
    s = c.Calibration(target=a.target, window_days=a.window_days)
    return P.calibration_run(spark, D.trailing(p, a.window_days), p.select("ticker_id").distinct(), a.output, a.run_id, s)


@command(("vol", ""), ("windows", "90,180,365,730"), ("anchors", 6), ("forward-days", 90))
def window_sweep(spark, a):
    return R.window_sweep(_path(spark, a), tuple(map(int, a.windows.split(","))), a.anchors, a.forward_days)


@command(("kind", "idx"), ("strict", False), ("bucket-ms", c.S10_MS), ("min-pct", 0.0), checks=True)
def integrity_check(spark, a):
    t = shards(spark, a)
    if a.kind == "vol":
        return Q.vol_findings(t).withColumn("severity", F.when(F.col("code") == "GAP", "W").otherwise("E"))
    if a.kind in ("s10", "bars"):
        return A.bar_series_findings(t, a.bucket_ms, a.min_pct)
    if a.kind == "renko":
        return R.continuity(t).where("broken").withColumn("severity", F.lit("E"))
    records = A.capped_samples(Q.record_findings(t, strict=a.strict)).select("ticker_id", F.col("event_id").cast("string").alias("at"), "code", "severity", "total")
    whole = Q.shard_findings(t, strict=a.strict).select("ticker_id", F.col("date").cast("string").alias("at"), "code", "severity", F.lit(1).cast("bigint").alias("total"))
    return records.union(whole)


@command(checks=True)
def glue_check(spark, a):
    t = shards(spark, a)
    out = Q.glue_status(Q.gaps(t, 0), M.missing_days(t), t.select("ticker_id").distinct())
    return out.withColumn("severity", F.when(F.col("status") == "ERROR", "E").when(F.col("status") == "WARN", "W"))


@command(("window-days", 365), ("s10", ""), ("renko", ""), ("params", ""), ("roster", ""), ("bucket-ms", c.S10_MS), checks=True)
def data_quality_audit(spark, a):
    """All families of checks for every ticker of the roster (a tree with ticker_id; without one, of the input)."""
    t = D.trailing(shards(spark, a).drop("date"), a.window_days)
    read = lambda path: spark.read.parquet(path) if path else None
    bars = read(a.s10)
    bars = B.gap_fill(B.ohlc(D.skip_sentinels(D.valid_quotes(t)), a.bucket_ms), a.bucket_ms) if bars is None else bars
    out = A.audit(t if not a.roster else read(a.roster), t, bars, a.bucket_ms, bricks=read(a.renko), params=read(a.params))
    return out.withColumn("severity", F.when(F.col("verdict") == "FAIL", "E").when(F.col("verdict") == "NO_DATA", "W"))


@command(checks=True)
def renko_continuity_check(spark, a):
    return Q.worst(R.continuity(shards(spark, a)), "gap", 5, "date").withColumn("severity", F.when(F.col("broken"), "E"))


@command(("s10", ""), ("renko", ""), ("now-ms", 0), checks=True)
def live_latency_audit(spark, a):
    now = F.lit(a.now_ms) if a.now_ms else F.unix_millis(F.current_timestamp())

    def tip(df, ts, name):
        return df.groupBy("ticker_id").agg((now - F.max(ts)).alias(name))

    t = tip(shards(spark, a), "ts_ms", "idx_ms").join(tip(spark.read.parquet(a.s10), "close_ts_ms", "s10_ms"), "ticker_id", "left").join(tip(spark.read.parquet(a.renko), "ts_ms", "renko_ms"), "ticker_id", "left")
    return Q.latency(t).withColumn("severity", F.when(F.col("level") == 2, "E").when(F.col("level") == 1, "W"))


@command(("target-ms", 200), ("commit", False), ("csv", ""), checks=True)
def resample_idx(spark, a):
    t = shards(spark, a).drop("date")
    out = B.resample_last(t, a.target_ms)
    if a.commit:
        save(out, a)
    if a.csv:
        A.resample_report(t.withColumn("shard_ticker_id", F.col("ticker_id")), out, c.DAY_MS).write.mode("overwrite").csv(a.csv, header=True)
    return Q.resample_invariants(t, out, a.target_ms).withColumn("severity", F.when(F.col("violations") > 0, "E"))


@command(("target-ms", 200))
def heal_idx(spark, a):
    return save(B.heal(shards(spark, a).drop("date"), a.target_ms), a)


@command(("existing", ""), ("cutoff-ms", 0))
def migrate_to_sharded(spark, a):
    t = D.delta_gate(shards(spark, a).drop("date"))
    return save(D.retained(t, spark.read.parquet(a.existing), a.cutoff_ms) if a.existing else t, a)


@command(("map", ""))
def migrate_phantom_ids(spark, a):
    """--map: JSON of old to new ids."""
    ids = spark.createDataFrame([(int(k), int(v)) for k, v in json.loads(a.map).items()], "old_id bigint, new_id bigint")
    return save(W.rekey(shards(spark, a).drop("date"), ids), a)


@command()
def migrate_quote_basis(spark, a):
    return save(shards(spark, a).drop("date").withColumn("ticker_id", S.rebase_quote(F.col("ticker_id"))), a)


@command(("steps", ",".join(P.STAGES)), ("resume", False), ("cycle-ms", 200), ("bucket-ms", c.S10_MS), checks=True)
def backfill_all(spark, a):
    t = shards(spark, a).drop("date")
    out = P.run(spark, t, a.output, P.Settings(cycle_ms=a.cycle_ms, bar_ms=a.bucket_ms), a.steps.split(","), a.resume)
    return out.withColumn("severity", F.when(F.col("errors") > 0, "E").when(F.col("warnings") > 0, "W"))


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tidemark")
    sub = parser.add_subparsers(dest="command", required=True)
    for name, (f, options, _) in COMMANDS.items():
        p = sub.add_parser(name, help=f.__doc__)
        for x in ("input", "output", "from-date", "to-date", "report"):
            p.add_argument(f"--{x}", default="")
        for x, default in options:
            p.add_argument(f"--{x}", **({"action": "store_true"} if default is False else {"default": default, "type": type(default)}))
    a = parser.parse_args(argv)
    f, _, checks = COMMANDS[a.command]
    spark = SparkSession.builder.appName("tidemark").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    out = f(spark, a)
    if a.report:
        out.write.mode("overwrite").json(a.report)
    elif not checks:
        out.show(20, truncate=False)
    if not checks:
        return 0
    level = out.agg(F.max(F.when(F.col("severity") == "E", 2).when(F.col("severity") == "W", 1).otherwise(0))).first()[0] or 0
    print(json.dumps({"command": a.command, "exit": level}))
    return level


if __name__ == "__main__":
    sys.exit(main())
