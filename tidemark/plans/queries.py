"""One query for each operator, over whole tables of the driver.

Cycles of a minute, bars of 30 minutes and roll-ups of 4 hours suit the events' density. Sums of floats are rounded, as
their order differs between engines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import config as c
from tidemark.adapters import records, table, ticks, trades
from tidemark.functions import scalar as S
from tidemark.operators import audit as A
from tidemark.operators import bars as B
from tidemark.operators import filters as D
from tidemark.operators import merge as M
from tidemark.operators import quality as Q
from tidemark.operators import renko as R
from tidemark.operators import storage as W
from tidemark.operators import volatility as V
from tidemark.sources import synthetic, trades as archives

CYCLE, BAR, ROLL = 60_000, 1_800_000, 14_400_000
QUERIES: dict = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*((F.round(n, digits) + 0.0).alias(n) if t == "double" else F.col(n) for n, t in df.dtypes))


def recs(spark, sf):
    return records(table(spark, sf, "events"))


#: The instant at which the checks of records are made.
NOW = 1_706_000_000_000


def faulty(spark, sf):
    """The records with faults of every kind planted by event number."""
    e = F.col("event_id")
    t = recs(spark, sf)
    conf = F.when(e % 26 == 0, 130).when(e % 34 == 0, 200).otherwise(F.col("confidence"))
    flags = F.col("flags").bitwiseOR(F.when(e % 13 == 0, c.CONF_ACTIVE).when(e % 17 == 0, c.CONF_FRESHNESS).otherwise(0))
    t = t.withColumns({"spread_bps": S.spread_bps() + F.when(e % 103 == 0, 2.0).otherwise(0.0), "ts_ms": F.when(e % 211 == 0, F.col("ts_ms") - 7_200_000).otherwise(F.col("ts_ms"))})
    return t.withColumns({"confidence": conf.cast("int"), "flags": flags.cast("int"), "accepted": F.when(e % 131 == 0, 70).otherwise(F.col("accepted")), "bid": F.when(e % 137 == 0, 0.0).otherwise(F.col("bid"))})


def roster(spark):
    """The tickers there are, and one without data."""
    return spark.range(1, 7).select(F.col("id").alias("ticker_id"))


def clean(spark, sf):
    return D.skip_sentinels(D.valid_quotes(recs(spark, sf)))


def bars(spark, sf):
    return B.ohlc(clean(spark, sf), BAR)


def filled(spark, sf):
    return B.gap_fill(bars(spark, sf), BAR)


def vol(spark, sf):
    return V.bins(filled(spark, sf))


def days(spark, sf):
    """Each supplier's shipments as day shards."""
    return table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("ticker_id"), F.col("l_shipdate").cast("date").alias("date"))


def path(spark, sf):
    return M.sigma_lookup(clean(spark, sf), vol(spark, sf))


@query
def honest_ticks(spark, sf):
    return rounded(ticks(table(spark, sf, "events")))


@query
def normalised_timestamps(spark, sf):
    t = trades(table(spark, sf, "events"))
    raw = F.when(F.col("event_id") % 2 == 0, F.col("ts_ms") * 1000).otherwise(F.col("ts_ms"))
    ts = S.normalise_ts(raw)
    return t.select("event_id", ts.alias("ts_ms"), S.mts(ts).alias("mts"), S.bucket(ts, c.S10_MS).alias("s10_open"), (S.bucket(ts, c.S10_MS) + c.S10_MS - 1).alias("s10_close"), S.utc_date(ts).cast("string").alias("day"))


@query
def record_scalars(spark, sf):
    return rounded(recs(spark, sf).select("event_id", S.mid().alias("mid"), S.spread_bps().alias("spread_bps"), S.confidence_ratio().alias("confidence_ratio"), S.to_u32(F.col("bid") * 1e8).alias("saturated")))


@query
def valid_quote_filter(spark, sf):
    return rounded(D.finite_mid(D.valid_quotes(recs(spark, sf))).select("event_id", "bid", "ask"))


@query
def sentinel_skip(spark, sf):
    return D.skip_sentinels(recs(spark, sf)).select("event_id", "flags")


@query
def zscore_gate(spark, sf):
    return D.zscore_gate(clean(spark, sf), 1.7).select("event_id", "rejected_z")


@query
def late_drop(spark, sf):
    """Arrival in the order of a fixed permutation of the events."""
    t = clean(spark, sf).withColumn("arrival", F.col("event_id") * 7919 % 100_003)
    return D.late(t, c.DAY_MS, ("arrival", "event_id")).groupBy("ticker_id").agg(F.count("*").alias("n"), F.sum(F.col("is_late").cast("bigint")).alias("late"))


@query
def window_filters(spark, sf):
    """Bootstrap discard, trailing window and retention together."""
    t = clean(spark, sf)
    kept = D.trailing(D.bootstrap_discard(t, 5), 20)
    existing = t.where(F.col("provider_id") == 0).groupBy("ticker_id").agg(F.min("ts_ms").alias("ts_ms"))
    return D.plausible_dates(D.retained(kept, existing, 1_704_067_200_000), 2024).select("event_id", "ticker_id", "ts_ms")


@query
def provider_denylist(spark, sf):
    t = clean(spark, sf)
    return D.without_providers(t, spark.createDataFrame([(2,)], "provider_id int")).groupBy("ticker_id", "provider_id").agg(F.count("*").alias("n"))


@query
def delta_gate(spark, sf):
    t = clean(spark, sf).withColumns({x: F.round(F.col(x) / 10) for x in ("bid", "ask")}).withColumns({"vbid": (F.col("vbid") / 200).cast("bigint"), "vask": (F.col("vask") / 200).cast("bigint")})
    return D.delta_gate(t, ("bid", "ask", "vbid", "vask")).select("event_id", "ticker_id", "bid")


@query
def cycle_agg(spark, sf):
    return rounded(B.cycles(clean(spark, sf), 3_600_000), 9)


@query
def provider_merge(spark, sf):
    return M.total_order(clean(spark, sf)).select("event_id", "ticker_id", "seq")


@query
def provider_merge_locf(spark, sf):
    return rounded(M.provider_state(clean(spark, sf), 3_600_000))


@query
def tdwap_composite(spark, sf):
    state = M.provider_state(clean(spark, sf), 3_600_000)
    return rounded(M.tdwap(state, {0: 0.3, 1: 0.15, 2: 0.1, 3: 0.1}, 3600))


@query
def ohlc_bars(spark, sf):
    return rounded(bars(spark, sf))


@query
def bar_microstructure(spark, sf):
    return rounded(B.microstructure(clean(spark, sf), ROLL), 9)


@query
def gapfill_bars(spark, sf):
    return rounded(filled(spark, sf))


@query
def ohlc_rollup(spark, sf):
    return rounded(B.rollup(filled(spark, sf), ROLL))


@query
def heal_bin_merge(spark, sf):
    return rounded(B.heal(recs(spark, sf), BAR), 9)


@query
def resample_last(spark, sf):
    return rounded(B.resample_last(recs(spark, sf), BAR))


@query
def resample_invariants(spark, sf):
    """A resampled series with rows lost, moved, doubled and unmarked."""
    t, e = recs(spark, sf), F.col("event_id")
    made = B.resample_last(t, BAR).where(e % 31 != 0)
    made = made.withColumns({"ts_ms": F.when(e % 37 == 0, F.col("ts_ms") + 7).otherwise(F.col("ts_ms")), "flags": F.when(e % 41 == 0, F.col("flags") - c.HEALED).otherwise(F.col("flags"))})
    return Q.resample_invariants(t, made.union(made.where(e % 43 == 0)), BAR)


@query
def rs_sigma(spark, sf):
    return rounded(vol(spark, sf), 9)


@query
def ema_sigma(spark, sf):
    return rounded(V.ema(vol(spark, sf)), 9)


@query
def sigma_blend(spark, sf):
    return rounded(V.blend(vol(spark, sf), (3, 7, 14)), 9)


@query
def sigma_lookup(spark, sf):
    sparse = V.bins(bars(spark, sf))
    return rounded(M.sigma_lookup(clean(spark, sf), sparse).select("event_id", "sigma"), 9)


@query
def synth_cross_ttl(spark, sf):
    t = clean(spark, sf)
    return rounded(M.cross(t.where("ticker_id = 1"), t.where("ticker_id = 2"), 600_000), 9)


@query
def parkinson_vol(spark, sf):
    return rounded(V.parkinson(bars(spark, sf)))


@query
def mad_outliers(spark, sf):
    return rounded(V.mad_outliers(V.returns(bars(spark, sf)), 2.0))


@query
def cusum(spark, sf):
    return V.cusum(V.returns(B.rollup(bars(spark, sf), ROLL)), 0.25, 2.0)


@query
def flat_runs(spark, sf):
    return rounded(Q.flat_runs(clean(spark, sf), F.floor(S.mid() / 25), ("ts_ms", "event_id"), 2).select("ticker_id", "run", "n", "start_ms"))


@query
def zero_tick_runs(spark, sf):
    t = Q.flat_runs(filled(spark, sf), F.col("tick_count") == 0, ("open_ts_ms",), 5)
    return t.where("v").select("ticker_id", "run", "n", "start_ms")


@query
def gap_classify(spark, sf):
    """Sentinels excuse gaps of the tickers that have them at one end only; tickers below 3 have none."""
    t = D.valid_quotes(recs(spark, sf)).where("ticker_id > 2 or flags % 2 = 0")
    return Q.classify_gaps(Q.session_overlap(Q.gaps(t, 5_400_000), t), t, 6_000_000, 9_000_000)


@query
def worst_gaps_topk(spark, sf):
    return Q.worst(Q.gaps(clean(spark, sf), 0), "gap_ms", 10, "to_ms")


@query
def missing_days(spark, sf):
    return M.missing_days(days(spark, sf)).select("ticker_id", F.col("date").cast("string").alias("date"))


@query
def leg_days(spark, sf):
    """Days on which a supplier and the one after it both ship."""
    t = days(spark, sf)
    return M.common_days(t, t.withColumn("ticker_id", F.col("ticker_id") - 1), ("ticker_id",)).select("ticker_id", F.col("date").cast("string").alias("date"))


@query
def grid_alignment(spark, sf):
    t = filled(spark, sf)
    odd = t.withColumn("open_ts_ms", F.when((F.col("tick_count") > 0) & (F.col("vbid") % 11 == 3), F.col("open_ts_ms") + 7).otherwise(F.col("open_ts_ms")))
    return Q.bar_findings(odd, BAR)


@query
def seam_s10(spark, sf):
    return Q.seam(bars(spark, sf), BAR).select("ticker_id", F.col("date").cast("string").alias("date"), "residual_ms", "broken")


@query
def coverage_k3(spark, sf):
    return rounded(Q.coverage(bars(spark, sf), BAR))


@query
def rollup_parity(spark, sf):
    """Coarse bars, some of which are wrong or missing."""
    fine, at = filled(spark, sf), F.col("open_ts_ms") / ROLL
    coarse = B.rollup(B.rollup(fine, 3_600_000), ROLL).where(at % 7 != 3).withColumn("close", F.when(at % 5 == 0, F.col("close") + 1).otherwise(F.col("close")))
    return Q.parity(fine, coarse, ROLL).groupBy("equal").agg(F.count("*").alias("n"))


@query
def integrity_findings(spark, sf):
    return Q.record_findings(faulty(spark, sf), now_ms=NOW)


@query
def stuck_shards(spark, sf):
    """Mids of a coarse grid, with bounds that these short days can reach."""
    e = F.col("event_id")
    t = recs(spark, sf).withColumns({"bid": F.round(F.col("bid") / 4) * 4, "ask": F.round(F.col("bid") / 4) * 4 + F.when(e % 397 == 0, 12.0).otherwise(0.02)})
    out = Q.shard_findings(t, strict=True, run=3, sample=8, distinct=0.3)
    return out.select("ticker_id", F.col("date").cast("string").alias("date"), "code", "severity")


@query
def bar_series(spark, sf):
    """Bars and bricks with faults planted by their volume."""
    v = F.col("vbid") % 23
    t = bars(spark, sf).withColumns({"kind": F.when(v == 1, 9).otherwise(0), "high": F.when(v == 2, F.col("low") - 1).when(v == 3, F.lit(float("nan"))).otherwise(F.col("high")), "low": F.when(v == 4, F.col("high") + 1).otherwise(F.col("low"))})
    t = t.withColumns({"open_ts_ms": F.when(v == 5, F.col("open_ts_ms") + 7).when(v == 6, F.col("close_ts_ms") + 1).otherwise(F.col("open_ts_ms")), "close_ts_ms": F.when(v == 7, F.col("close_ts_ms") + 3).otherwise(F.col("close_ts_ms"))})
    more = t.withColumns({"realized_var": F.when(v == 8, -1.0).otherwise(0.5), "vol_imbalance": F.when(v == 9, 1.5).otherwise(0.5), "avg_spread_bps": F.when(v == 10, -2.0).otherwise(1.0), "max_abs_return": F.when(v == 11, -0.1).otherwise(0.1), "drift": F.when(v == 12, 3.0).otherwise(0.0)})
    return A.bar_series_findings(more, BAR)


@query
def brick_series(spark, sf):
    """Roll-ups taken for bricks: continuity and least size."""
    t = B.rollup(bars(spark, sf), ROLL).withColumns({"kind": F.lit(A.RENKO), "open": F.when(F.col("vbid") % 3 > 0, F.col("open")).otherwise(F.col("close"))})
    return A.bar_series_findings(t, ROLL, 0.02)


@query
def shard_directory(spark, sf):
    """Orders as shard files of their customers' days."""
    o = table(spark, sf, "orders")
    day = F.unix_date(F.col("o_orderdate").cast("date")).cast("bigint") * c.DAY_MS
    t = o.select((F.col("o_custkey") % 40).alias("ticker_id"), F.col("o_orderdate").cast("date").alias("date"), F.concat(F.lit("f"), F.col("o_orderkey").cast("string")).alias("name"),
                 F.when(F.col("o_orderkey") % 11 == 0, 0).when(F.col("o_orderkey") % 7 == 0, 100).otherwise(112).cast("bigint").alias("bytes"), F.lit(56).cast("bigint").alias("record_bytes"), (F.col("o_custkey") % 40 != 5).alias("known"),
                 day.alias("first_ms"), (day + F.when(F.col("o_orderkey") % 5 == 0, c.DAY_MS).otherwise(5)).alias("last_ms"))
    return A.directory_findings(t).select("ticker_id", F.col("date").cast("string").alias("date"), "name", "code", "severity")


@query
def capped_findings(spark, sf):
    return A.capped_samples(Q.record_findings(faulty(spark, sf), now_ms=NOW), 3)


@query
def last_bars(spark, sf):
    return rounded(A.last_bars(bars(spark, sf), 20))


@query
def vol_index(spark, sf):
    """Volatility bins and records of which each lacks some."""
    t = clean(spark, sf)
    v = V.bins(bars(spark, sf))
    return A.vol_index(v.where(F.col("bin_ts_ms") / BAR % 9 != 4), t.where(F.col("ts_ms") % 86_400_000 > 7_200_000), BAR)


@query
def audit_families(spark, sf):
    """One verdict for each ticker of the roster from all families of checks, each of which some ticker fails."""
    t, x = faulty(spark, sf), F.col("ticker_id")
    t = t.where((x != 2) | (F.col("ts_ms") % (5 * c.DAY_MS) > c.DAY_MS)).where((x != 4) | (F.col("ts_ms") % c.DAY_MS < 40_000_000))
    flat = (x == 3) & (F.floor(F.col("ts_ms") / c.DAY_MS) % 7 == 0) & (F.col("bid") > 0)
    t = t.withColumns({"bid": F.when(flat, 150.0).otherwise(F.col("bid")), "ask": F.when(flat, 150.25).otherwise(F.col("ask"))})
    b = filled(spark, sf).where((x != 3) | (F.col("open_ts_ms") % c.DAY_MS < 4 * BAR) | (F.col("open_ts_ms") % c.DAY_MS > 44 * BAR))
    b = b.withColumns({"high": F.when((x == 1) & (F.col("vbid") % 23 == 2), F.col("low") - 1).otherwise(F.col("high")), "open_ts_ms": F.when((x == 5) & (F.col("vbid") % 29 == 5), F.col("open_ts_ms") + 7).otherwise(F.col("open_ts_ms"))})
    coarse = B.rollup(filled(spark, sf), ROLL)
    return A.audit(roster(spark), t, b, BAR, coarse, ROLL, max_gap_ms=5_400_000, quiet_ms=6_000_000, zero_run=4, now_ms=NOW, stuck={"run": 4, "sample": 5, "distinct": 0.5})


@query
def vol_findings(spark, sf):
    v = V.bins(bars(spark, sf)).withColumn("sigma_pct", F.when(F.col("bin_ts_ms") / BAR % 13 == 0, F.lit(float("nan"))).otherwise(F.col("sigma_pct") * 2))
    return Q.vol_findings(v)


@query
def file_stats(spark, sf):
    t = D.valid_quotes(recs(spark, sf))
    return rounded(Q.file_stats(t.withColumn("ask", F.when(F.col("event_id") % 89 == 0, F.col("ask") * 1.2).otherwise(F.col("ask")))))


@query
def distinct_mids(spark, sf):
    return rounded(Q.distinct_mids(clean(spark, sf)))


@query
def glue_status(spark, sf):
    t = clean(spark, sf)
    return Q.glue_status(Q.gaps(t, 0), M.missing_days(days(spark, sf)), t.select("ticker_id").distinct(), 7_200_000)


@query
def audit_verdict(spark, sf):
    t = faulty(spark, sf).where("ticker_id <> 4 or (event_id % 13 > 0 and event_id % 17 > 0 and event_id % 101 > 0 and event_id % 103 > 0 and event_id % 131 > 0 and event_id % 137 > 0 and event_id % 211 > 0)")
    rows = roster(spark).join(t.groupBy("ticker_id").agg(F.count("*").alias("rows")), "ticker_id", "left").na.fill(0, ["rows"])
    return Q.verdict(Q.record_findings(t.where("vbid + vask > 0"), now_ms=NOW + 10**11), rows)


@query
def audit_exit(spark, sf):
    return Q.exit_code(audit_verdict(spark, sf))


@query
def shard_manifest(spark, sf):
    t = clean(spark, sf).select("ticker_id", "ts_ms", "event_id")
    return W.manifest(t).select("ticker_id", F.col("date").cast("string").alias("date"), "first_ts", "last_ts", "n_records")


@query
def rekeyed_shards(spark, sf):
    """Shards that differ after ids are renamed, one of them not back, and some rows are lost on the way."""
    t = clean(spark, sf).select("ticker_id", "ts_ms", "event_id")
    there = spark.createDataFrame([(1, 101), (2, 102)], "old_id bigint, new_id bigint")
    back = there.where("old_id = 1").select(F.col("new_id").alias("old_id"), F.col("old_id").alias("new_id"))
    both = W.same_shards(W.manifest(t), W.manifest(W.rekey(W.rekey(t, there), back).where("event_id % 307 <> 0")))
    return both.select("side", "ticker_id", F.col("date").cast("string").alias("date"), "first_ts", "last_ts", "n_records")


@query
def median_spacing(spark, sf):
    return Q.median_spacing(clean(spark, sf), 86_400_000)


@query
def rank_percentiles(spark, sf):
    d = clean(spark, sf).groupBy("ticker_id", S.utc_date(F.col("ts_ms")).alias("d")).agg(F.count("*").alias("n"))
    return Q.rank_percentiles(d, "n")


@query
def month_windows(spark, sf):
    r = table(spark, sf, "orders").agg(F.min("o_orderdate").cast("date").cast("string").alias("a"), F.max("o_orderdate").cast("date").cast("string").alias("b")).first()
    return archives.months(spark, r["a"], r["b"]).select(F.col("month_start").cast("string").alias("month_start"), F.col("month_end").cast("string").alias("month_end"), "whole")


@query
def archive_plan(spark, sf):
    m = archives.months(spark, "1996-01-10", "1998-12-05")
    have = table(spark, sf, "orders").where("o_orderstatus = 'P'").groupBy(F.trunc("o_orderdate", "MM").alias("month_start")).agg((F.count("*") % 3).alias("ticks"))
    p = archives.plan_archives(m, have)
    return p.select("kind", F.col("date").cast("string").alias("date"), archives.archive_url(F.col("kind"), "okx", "BTC-USDT", F.col("date"), "https://archive.example").alias("url"))


def pairs(spark, sf):
    """Customers' segments and nations as market pairs."""
    names = ["BTC", "ETH", "USDT", "DOGE", "EUR", "GBP", "usdc", "USD"]
    pick = F.array(*map(F.lit, names))
    return table(spark, sf, "customer").select("c_custkey", F.concat_ws("/", F.get(pick, F.col("c_nationkey") % 8), F.get(pick, F.length("c_mktsegment") % 8)).alias("pair"))


@query
def asset_class_bucket(spark, sf):
    base, quote = S.pair_parts(F.col("pair"))
    return pairs(spark, sf).select("c_custkey", base.alias("base"), quote.alias("quote"), S.asset_class(base, quote).alias("class"), S.inferred_usdc(F.col("pair")).alias("usdc_base"))


@query
def target_bpd_resolve(spark, sf):
    base, quote = S.pair_parts(F.col("pair"))
    return pairs(spark, sf).select("c_custkey", S.target_bpd(F.col("pair"), S.asset_class(base, quote), {"BTC/EUR": 400, "DOGE/USD": 120}).alias("target"))


@query
def ticker_bits(spark, sf):
    o = table(spark, sf, "orders")
    packed = F.expr("shiftleft(cast(1 + o_orderkey % 7 as bigint), 60) | shiftleft(cast(2 as bigint), 56) | shiftleft(o_custkey % 65536, 40) | shiftleft(cast(5 as bigint), 36) | shiftleft(o_orderkey % 65536, 20) | (o_orderkey * 13 % 1048576)")
    t = o.select("o_orderkey", packed.alias("id"))
    return t.select("o_orderkey", *S.ticker_bits(F.col("id")), S.rebase_quote(F.col("id")).alias("rebased"))


@query
def renko_bricks(spark, sf):
    return rounded(R.bricks(R.sized(path(spark, sf), 5.0, 0.02)))


@query
def bricks_per_day(spark, sf):
    d = R.per_day(R.bricks(R.sized(path(spark, sf), 5.0, 0.02)))
    return d.select("ticker_id", F.col("date").cast("string").alias("date"), "n")


@query
def brick_quarantine(spark, sf):
    return R.quarantine(R.per_day(R.bricks(R.sized(path(spark, sf), 5.0, 0.02))))


@query
def seam_renko(spark, sf):
    t = R.continuity(R.bricks(R.sized(path(spark, sf), 5.0, 0.02)))
    return t.groupBy("ticker_id").agg(F.count("*").alias("seams"), F.sum(F.col("broken").cast("bigint")).alias("broken"))


@query
def minpct_clamp_fraction(spark, sf):
    return rounded(R.clamp_fraction(path(spark, sf), 5.0, 0.02))


@query
def synth_cross_bars(spark, sf):
    """Gapless bars of a synthetic cross."""
    t = clean(spark, sf)
    q = M.cross(t.where("ticker_id = 1"), t.where("ticker_id = 2"), 3_600_000).where("fresh")
    q = q.select(F.lit(12).cast("bigint").alias("ticker_id"), "ts_ms", (F.col("event_id") * 2 + F.col("leg")).alias("event_id"), "bid", "ask", F.lit(0).cast("bigint").alias("vbid"), F.lit(0).cast("bigint").alias("vask"))
    return rounded(B.gap_fill(B.ohlc(q, BAR), BAR), 9)


@query
def monthly_sigma_sidecar(spark, sf):
    """By ticker and month: deviation of bar returns and of daily returns, their ratio, and the clamped k."""
    b = bars(spark, sf)
    month = F.date_format(S.utc_date(F.col("open_ts_ms")), "yyyy-MM")
    fine = V.returns(b).groupBy("ticker_id", month.alias("month")).agg(F.stddev_samp("r").alias("sigma_bar"))
    daily = V.returns(B.rollup(b, c.DAY_MS)).groupBy("ticker_id", month.alias("month")).agg(F.stddev_samp("r").alias("sigma_day"))
    k = F.least(F.greatest(F.lit(0.002) / F.col("sigma_bar"), F.lit(c.K_FLOOR)), F.lit(c.K_CEILING))
    return rounded(fine.join(daily, ["ticker_id", "month"]).select("*", (F.col("sigma_bar") / F.col("sigma_day")).alias("ratio"), k.alias("k")))


@query
def roster_set_ops(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("id"))
    cust = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), "c_nationkey")
    return M.roster(cust.where("c_nationkey < 12"), o, cust.where("id % 10 = 3").select("id"), o)


@query
def backfill_glue(spark, sf):
    t = clean(spark, sf).select("ticker_id", "event_id", "ts_ms", "provider_id")
    live = t.where("provider_id < 2").where(F.col("ts_ms") > 1_704_067_200_000 + F.col("ticker_id") * 259_200_000)
    return M.glue(t.where("provider_id >= 2"), live)


@query
def latency_levels(spark, sf):
    now = 1_706_659_200_000
    t = clean(spark, sf).groupBy("ticker_id").agg(F.max("ts_ms").alias("tip"))
    age = F.lit(now) - F.col("tip")
    return Q.latency(t.select("ticker_id", (age / 100_000).cast("bigint").alias("idx_ms"), (age / 10_000).cast("bigint").alias("s10_ms"), (age / 1000).cast("bigint").alias("renko_ms")))


@query
def truncated_downloads(spark, sf):
    """Extended prices as bytes received of a stated length."""
    t = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.floor("l_extendedprice").alias("got"), F.when(F.col("l_linenumber") < 6, F.floor(F.col("l_quantity") * 1000)).alias("want"))
    return t.select("l_orderkey", "l_linenumber", S.is_truncated(F.col("got"), F.col("want")).alias("truncated"))


@query
def csv_trades(spark, sf):
    """The events as lines of an exchange's archive, read back."""
    t = trades(table(spark, sf, "events"))
    side = F.when(F.col("is_buyer"), "Buy").otherwise("Sell")
    line = F.when(F.col("event_id") % 53 == 0, F.lit("timestamp,symbol")).otherwise(F.concat_ws(",", F.lit("x"), F.col("ts_ms").cast("string"), F.col("price").cast("string"), F.lit("2.5"), side))
    return rounded(archives.parse(t.select(line.alias("value")), "bybit", 7, 1))


@query
def scale_to_target_k(spark, sf):
    p = path(spark, sf).select("ticker_id", "ts_ms", "event_id", S.mid().alias("mid"), "sigma")
    return R.calibrate(p, c.Calibration(target=20.0, min_pct=0.0001, clamp_limit=0.9))


@query
def walkforward_k(spark, sf):
    p = path(spark, sf).select("ticker_id", "ts_ms", "event_id", S.mid().alias("mid"), "sigma")
    return R.walk_forward(p, c.Calibration(target=20.0, min_pct=0.0001, clamp_limit=0.9), 20)


@query
def window_sweep(spark, sf):
    p = path(spark, sf).select("ticker_id", "ts_ms", "event_id", S.mid().alias("mid"), "sigma")
    return R.window_sweep(p, (7, 14), 2, 5, c.Calibration(target=20.0, min_pct=0.0001, clamp_limit=0.9))


@query
def k_distribution(spark, sf):
    return R.k_distribution(scale_to_target_k(spark, sf))


@query
def synthetic_gbm(spark, sf):
    return synthetic.quotes(synthetic.gbm(spark, 5, 2000))


@query
def archive_urls(spark, sf):
    """Addresses of every exchange's archives for the months of the orders."""
    t = table(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("date")).distinct()
    out = None
    for exchange in sorted(archives.ARCHIVES):
        url = [archives.archive_url(F.lit(k), exchange, "btc/usdt", F.col("date")).alias(k) for k in ("monthly", "daily")]
        one = t.select(F.lit(exchange).alias("exchange"), F.col("date").cast("string").alias("date"), *url)
        out = one if out is None else out.union(one)
    return out


def misrouted(spark, sf):
    e = F.col("event_id")
    return recs(spark, sf).withColumn("shard_ticker_id", F.when(e % 23 == 0, F.col("ticker_id") % 5 + 1).otherwise(F.col("ticker_id")))


@query
def own_ticker_filter(spark, sf):
    return D.own_ticker(misrouted(spark, sf)).select("event_id", "ticker_id")


@query
def resample_report(spark, sf):
    t = misrouted(spark, sf)
    return A.resample_report(t, B.resample_last(D.own_ticker(t).drop("shard_ticker_id"), BAR), c.DAY_MS)
