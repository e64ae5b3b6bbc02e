"""Validation: findings per row, gaps, runs, coverage, continuity and verdicts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import config as c
from tidemark.functions import scalar as S

# Bounds of the checks.
LEAST_PRICE = 1e-9
EPOCH_2000_MS, FUTURE_SLACK_MS = 946_684_800_000, 300_000
MAX_GAP_MS, MAX_ACCEPTED, MAX_JUMP, MAX_CI, MAX_SPREAD_DIFFERENCE = 60_000, 64, 0.10, 0.01, 0.5
LEAST_FRESHNESS, LEAST_ACTIVE = 0.05, 2
STUCK_RUN, STUCK_SAMPLE, STUCK_DISTINCT = 300, 2000, 0.002
WIDE_BPS, STRICT_CI, STRICT_WIDE = 500.0, 0.001, 0.005


def _bad(x: str) -> Column:
    return F.isnan(x) | (F.col(x) < LEAST_PRICE) | (F.abs(F.col(x)) == float("inf"))


def _flag(f: int) -> Column:
    return F.col("flags").bitwiseAND(F.lit(f)) != 0


def _stale() -> Column:
    """Too few ticking providers or too little fresh weight, by the encoding that the flags select; plain counts say nothing."""
    conf = F.col("confidence")
    active = (conf.bitwiseAND(F.lit(127)) < LEAST_ACTIVE) | (conf.bitwiseAND(F.lit(128)) == 0)
    return F.when(_flag(c.CONF_ACTIVE), active).when(_flag(c.CONF_FRESHNESS), conf / 255.0 < LEAST_FRESHNESS).otherwise(F.lit(False))


def record_findings(df: DataFrame, order=("event_id",), now_ms: int | None = None, strict: bool = False) -> DataFrame:
    """(ticker_id, event_id, code, severity): every check of an index record in one pass over one window.

    A shard is a ticker's UTC day, and ``order`` that of the rows in it, as they arrived; what comes before is looked for in the
    shard alone, so no window is longer than a day. A record's jump is from the last fine quote that was no sentinel. A column
    ``spread_bps`` is compared with bid and ask.
    """
    w = Window.partitionBy("ticker_id", F.floor(F.col("ts_ms") / c.DAY_MS)).orderBy(*order)
    sentinel, bookless = _flag(c.SENTINEL), _flag(c.NO_BOOK)
    fine = ~(F.isnan("bid") | F.isnan("ask"))
    quote = ~sentinel & ~_bad("bid") & ~_bad("ask") & (F.col("ask") >= F.col("bid"))
    t = df.withColumns({"m": S.mid(), "pts": F.lag("ts_ms").over(w)})
    t = t.withColumn("pm", F.last(F.when(quote, F.col("m")), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)))
    zero = (F.col("vbid") == 0).cast("int") + (F.col("vask") == 0).cast("int")
    gap = F.col("ts_ms") - F.col("pts")
    warn = "E" if strict else "W"
    now = F.unix_millis(F.current_timestamp()) if now_ms is None else F.lit(now_ms)
    spread = S.spread_bps()
    wrong = (spread < 0) | (F.abs(spread - F.col("spread_bps")) > MAX_SPREAD_DIFFERENCE) if "spread_bps" in df.columns else spread < 0
    checks = [
        ("G6", (F.col("ts_ms") < EPOCH_2000_MS) | (F.col("ts_ms") > now + FUTURE_SLACK_MS), "E"),
        ("MO", gap < 0, "E"),
        ("GAP", gap > MAX_GAP_MS, "W"),
        ("G1", _bad("bid") | _bad("ask"), "E"),
        ("XQ", fine & (F.col("ask") < F.col("bid")), "E"),
        ("G8", F.col("accepted") > MAX_ACCEPTED, "E"),
        ("G10E", (zero == 2) & ~sentinel & ~bookless, "E"),
        ("G10W", (zero == 1) & ~sentinel & ~bookless, "W"),
        ("G11", ~sentinel & (F.col("rejected") > F.col("accepted")), "W"),
        ("G7", fine & wrong, "E"),
        ("G3", F.col("ci_ubp") > MAX_CI * F.col("m"), warn),
        ("G5", quote & (F.coalesce(gap, F.lit(0)) <= MAX_GAP_MS) & (F.abs(F.col("m") - F.col("pm")) > MAX_JUMP * F.col("pm")), warn),
        ("G4", _stale(), warn),
    ]
    found = F.filter(F.array(*(F.when(bad, F.struct(F.lit(code).alias("code"), F.lit(s).alias("severity"))) for code, bad, s in checks)), lambda x: x.isNotNull())
    return t.select("ticker_id", "event_id", F.explode(found).alias("x")).select("ticker_id", "event_id", "x.code", "x.severity")


def shard_findings(df: DataFrame, order=("event_id",), strict: bool = False, run: int = STUCK_RUN, sample: int = STUCK_SAMPLE, distinct: float = STUCK_DISTINCT) -> DataFrame:
    """(ticker_id, date, code, severity) of whole shards: a run of equal mids (G9), few different mids (G9D), and, if
    ``strict``, wide intervals (STC) and wide spreads (STS). Sentinels and broken quotes count for nothing."""
    day = F.floor(F.col("ts_ms") / c.DAY_MS)
    t = df.where(~_flag(c.SENTINEL) & ~_bad("bid") & ~_bad("ask") & (F.col("ask") >= F.col("bid"))).withColumns({"day": day, "m": S.mid()})
    w = Window.partitionBy("ticker_id", "day").orderBy(*order)
    t = t.withColumn("new", F.coalesce(F.col("m") != F.lag("m").over(w), F.lit(True)).cast("int"))
    t = t.withColumn("run", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    runs = t.groupBy("ticker_id", "day", "run").agg(F.count("*").alias("n"), F.first("m").alias("m"), F.sum(F.col("ci_ubp") / F.col("m")).alias("ci"), F.sum((S.spread_bps() > WIDE_BPS).cast("int")).alias("wide"))
    n = F.sum("n")
    shards = runs.groupBy("ticker_id", "day").agg(n.alias("n"), F.max("n").alias("longest"), (F.count_distinct("m") / n).alias("distinct"), (F.sum("ci") / n).alias("ci"), (F.sum("wide") / n).alias("wide"))
    warn = "E" if strict else "W"
    checks = [("G9", F.col("longest") >= run), ("G9D", (F.col("n") >= sample) & (F.col("distinct") < distinct))]
    checks += [("STC", F.col("ci") >= STRICT_CI), ("STS", F.col("wide") >= STRICT_WIDE)] if strict else []
    found = F.filter(F.array(*(F.when(bad, F.lit(code)) for code, bad in checks)), lambda x: x.isNotNull())
    out = shards.select("ticker_id", F.date_from_unix_date(F.col("day").cast("int")).alias("date"), F.explode(found).alias("code"))
    return out.withColumn("severity", F.lit(warn))


def with_before(df: DataFrame, ms: str, order: tuple[str, ...], values: list[str]) -> DataFrame:
    """Adds ``p_`` columns: the values of the ticker's row before. Windows hold a day; its first row takes the last of the day before that has rows."""
    last = df.groupBy("ticker_id", F.floor(F.col(ms) / c.DAY_MS).alias("day")).agg(F.max_by(F.struct(*values), F.struct(*order)).alias("last"))
    carried = last.select("ticker_id", "day", F.lag("last").over(Window.partitionBy("ticker_id").orderBy("day")).alias("carried"))
    w = Window.partitionBy("ticker_id", "day").orderBy(*order)
    t = df.withColumn("day", F.floor(F.col(ms) / c.DAY_MS)).withColumn("before", F.lag(F.struct(*values)).over(w))
    t = t.join(carried, ["ticker_id", "day"]).withColumn("before", F.coalesce("before", "carried"))
    return t.select(*df.columns, *(F.col(f"before.{v}").alias(f"p_{v}") for v in values))


def bar_findings(bars: DataFrame, ms: int) -> DataFrame:
    """(ticker_id, open_ts_ms, code): grid, order and price checks of bars."""
    w = Window.partitionBy("ticker_id").orderBy("open_ts_ms")
    step = F.col("open_ts_ms") - F.lag("open_ts_ms").over(w)
    checks = [
        ("GRID", F.pmod("open_ts_ms", F.lit(ms)) != 0),
        ("CLOSE", F.col("close_ts_ms") != F.col("open_ts_ms") + ms - 1),
        ("STEP", F.pmod(step, F.lit(ms)) != 0),
        ("GAP", step > ms),
        ("HIGH", F.col("high") < F.greatest("open", "close", "low")),
        ("LOW", F.col("low") > F.least("open", "close", "high")),
        ("JUMP", F.abs(F.log(F.col("close") / F.col("open"))) > 0.1),
    ]
    found = F.filter(F.array(*(F.when(bad, F.lit(code)) for code, bad in checks)), lambda x: x.isNotNull())
    return bars.select("ticker_id", "open_ts_ms", found.alias("codes")).select("ticker_id", "open_ts_ms", F.explode("codes").alias("code"))


def vol_findings(vol: DataFrame) -> DataFrame:
    s = F.col("sigma_pct")
    w = Window.partitionBy("ticker_id").orderBy("bin_ts_ms")
    step = F.col("bin_ts_ms") - F.lag("bin_ts_ms").over(w)
    checks = [("NONFINITE", F.isnan(s) | s.isNull()), ("RANGE", (s < 0) | (s >= 5)), ("HIGH", s > 0.5), ("ORDER", step <= 0), ("GAP", step > c.VOL_BIN_MS)]
    found = F.filter(F.array(*(F.when(bad, F.lit(code)) for code, bad in checks)), lambda x: x.isNotNull())
    return vol.select("ticker_id", "bin_ts_ms", found.alias("codes")).select("ticker_id", "bin_ts_ms", F.explode("codes").alias("code"))


def gaps(df: DataFrame, least_ms: int, order=("ts_ms", "event_id")) -> DataFrame:
    """(ticker_id, from_ms, to_ms, gap_ms, severity) of steps of more than ``least_ms``."""
    t = with_before(df.select("ticker_id", *order), "ts_ms", tuple(order), ["ts_ms"]).select("ticker_id", F.col("p_ts_ms").alias("from_ms"), F.col("ts_ms").alias("to_ms"))
    gap = F.col("to_ms") - F.col("from_ms")
    return t.where(gap > least_ms).select("*", gap.alias("gap_ms"), S.gap_severity(gap).alias("severity"))


def worst(df: DataFrame, by: str, k: int, ties: str) -> DataFrame:
    """The ``k`` largest per ticker."""
    w = Window.partitionBy("ticker_id").orderBy(F.desc(by), ties)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def session_overlap(gaps_: DataFrame, rows: DataFrame) -> DataFrame:
    """Adds to each gap the time that it takes from its days' sessions (the ticker's own first to last row of the day)."""
    days = rows.groupBy("ticker_id", F.floor(F.col("ts_ms") / c.DAY_MS).alias("day")).agg(F.min("ts_ms").alias("s"), F.max("ts_ms").alias("e"))
    spread = gaps_.withColumn("day", F.explode(F.sequence(F.floor(F.col("from_ms") / c.DAY_MS), F.floor(F.col("to_ms") / c.DAY_MS))))
    over = F.greatest(F.lit(0), F.least("to_ms", "e") - F.greatest("from_ms", "s"))
    return spread.join(days, ["ticker_id", "day"]).groupBy("ticker_id", "from_ms", "to_ms", "gap_ms").agg(F.sum(over).cast("bigint").alias("active_ms"))


def classify_gaps(overlapped: DataFrame, rows: DataFrame, max_gap_ms: int = 120_000, quiet_ms: int = 60_000) -> DataFrame:
    """Adds ``kind``: closed within ``max_gap_ms`` of session time; quiet up to ``quiet_ms`` where a sentinel stands at an end, or
    the ticker of ``rows`` has none anywhere; else OUTAGE."""
    at = rows.where(_flag(c.SENTINEL)).select("ticker_id", "ts_ms").distinct()
    any_ = at.select(F.col("ticker_id").alias("t0")).distinct()
    start, end = (at.select(F.col("ticker_id").alias(t), F.col("ts_ms").alias(x)) for t, x in (("t1", "x1"), ("t2", "x2")))
    j = overlapped.join(any_, F.col("ticker_id") == F.col("t0"), "left")
    j = j.join(start, (F.col("ticker_id") == F.col("t1")) & (F.col("from_ms") == F.col("x1")), "left")
    j = j.join(end, (F.col("ticker_id") == F.col("t2")) & (F.col("to_ms") == F.col("x2")), "left")
    excused = F.col("t0").isNull() | F.col("t1").isNotNull() | F.col("t2").isNotNull()
    kind = F.when(F.col("active_ms") <= max_gap_ms, "closed").when(excused & (F.col("gap_ms") <= quiet_ms), "quiet").otherwise("OUTAGE")
    return j.select(*overlapped.columns, kind.alias("kind"))


def flat_runs(df: DataFrame, value: Column, order: tuple[str, ...], least: int = 1) -> DataFrame:
    """(ticker_id, run, n, start_ms) of runs of equal values."""
    w = Window.partitionBy("ticker_id").orderBy(*order)
    t = df.withColumn("v", value)
    t = t.withColumn("new", F.when(F.col("v").eqNullSafe(F.lag("v").over(w)) & F.lag(F.lit(1)).over(w).isNotNull(), 0).otherwise(1))
    t = t.withColumn("run", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return t.groupBy("ticker_id", "run").agg(F.count("*").alias("n"), F.min(order[0]).alias("start_ms"), F.first("v").alias("v")).where(F.col("n") >= least)


def distinct_mids(df: DataFrame) -> DataFrame:
    n = F.count_distinct(S.mid())
    return df.groupBy("ticker_id").agg(n.alias("distinct_mids"), (n / F.count("*")).alias("fraction"))


def file_stats(df: DataFrame) -> DataFrame:
    s = S.spread_bps()
    return df.groupBy("ticker_id").agg(
        F.avg(F.col("ci_ubp") / S.mid()).alias("ci_ratio"), F.avg(s).alias("mean_spread"), F.max(s).alias("max_spread"), F.avg(F.when(s > WIDE_BPS, 1.0).otherwise(0.0)).alias("wide"),
        ((F.max("ts_ms") - F.min("ts_ms")) / 3_600_000).alias("hours"), (F.sum("rejected") / (F.sum("accepted") + F.sum("rejected"))).alias("reject_rate"),
    )


def coverage(bars: DataFrame, ms: int) -> DataFrame:
    """Share of each day's own session that bars cover, first and last day left out; below 0.5 fails, below 0.8 warns."""
    day = F.floor(F.col("open_ts_ms") / c.DAY_MS)
    d = bars.groupBy("ticker_id", day.alias("day")).agg(F.count("*").alias("n"), ((F.max("open_ts_ms") - F.min("open_ts_ms")) / ms + 1).alias("slots"))
    ends = d.groupBy("ticker_id").agg(F.min("day").alias("a"), F.max("day").alias("b"))
    share = F.col("n") / F.col("slots")
    level = F.when(share < 0.5, "FAIL").when(share < 0.8, "WARN").otherwise("OK")
    return d.join(ends, "ticker_id").where("day > a and day < b").select("ticker_id", "day", share.alias("share"), level.alias("level"))


def parity(fine: DataFrame, coarse: DataFrame, ms: int) -> DataFrame:
    """Coarse bars that differ from the roll-up of the fine ones."""
    from tidemark.operators.bars import rollup

    keys = ["ticker_id", "open_ts_ms"]
    names = ["open", "high", "low", "close", "vbid", "vask", "tick_count"]
    a = rollup(fine, ms).select(*keys, F.struct(*names).alias("a"))
    j = a.join(coarse.select(*keys, F.struct(*names).alias("b")), keys, "full")
    return j.select(*keys, F.col("a").eqNullSafe(F.col("b")).alias("equal"))


def seam(bars: DataFrame, ms: int) -> DataFrame:
    """Between days: the next bar's open less the last one's close, over the expected millisecond."""
    d = S.utc_date(F.col("open_ts_ms"))
    days = bars.groupBy("ticker_id", d.alias("date")).agg(F.min("open_ts_ms").alias("first"), F.max("close_ts_ms").alias("last"))
    w = Window.partitionBy("ticker_id").orderBy("date")
    j = days.withColumn("before", F.lag("last").over(w)).where("before is not null")
    rest = F.col("first") - F.col("before") - 1
    return j.select("ticker_id", "date", rest.alias("residual_ms"), (F.abs(rest) > 1).alias("broken"))


def glue_status(gaps_: DataFrame, missing: DataFrame, tickers: DataFrame, limit_ms: int = 90_000) -> DataFrame:
    """Per ticker: monotone-gap and missing-shard counts as OK, WARN or ERROR."""
    g = gaps_.groupBy("ticker_id").agg(F.count(F.when(F.col("gap_ms") > limit_ms, 1)).alias("gaps"))
    m = missing.groupBy("ticker_id").agg(F.count("*").alias("missing"))
    j = tickers.join(g, "ticker_id", "left").join(m, "ticker_id", "left").na.fill(0, ["gaps", "missing"])
    return j.withColumn("status", F.when(F.col("missing") > 0, "ERROR").when(F.col("gaps") > 0, "WARN").otherwise("OK"))


def verdict(findings: DataFrame, tickers: DataFrame) -> DataFrame:
    """PASS, FAIL or NO_DATA of each ticker from its findings and row count, with the failing codes in order."""
    f = findings.groupBy("ticker_id").agg(F.sum(F.when(F.col("severity") == "E", 1).otherwise(0)).alias("errors"), F.sum(F.when(F.col("severity") == "W", 1).otherwise(0)).alias("warnings"), F.concat_ws(",", F.sort_array(F.collect_set(F.when(F.col("severity") == "E", F.col("code"))))).alias("reasons"))
    j = tickers.join(f, "ticker_id", "left").na.fill(0, ["errors", "warnings"]).na.fill("", ["reasons"])
    return j.withColumn("verdict", F.when(F.col("rows") == 0, "NO_DATA").when(F.col("errors") > 0, "FAIL").otherwise("PASS"))


def exit_code(verdicts: DataFrame) -> DataFrame:
    """0 fine, 1 warnings, 2 errors over everything; and the histogram."""
    return verdicts.agg(
        F.max(F.when(F.col("errors") > 0, 2).when(F.col("warnings") > 0, 1).otherwise(0)).alias("code"),
        *(F.count(F.when(F.col("verdict") == v, 1)).alias(v.lower()) for v in ("PASS", "FAIL", "NO_DATA")),
    )


def latency(tips: DataFrame) -> DataFrame:
    """Levels of the tips' ages (idx 2/10 s, s10 15/30 s, renko 300/600 s); the worst per ticker."""
    levels = [S.latency_level(F.col(x) / 1000.0, *sla).alias(f"{x}_level") for x, sla in (("idx_ms", (2, 10)), ("s10_ms", (15, 30)), ("renko_ms", (300, 600)))]
    t = tips.select("ticker_id", *levels)
    return t.withColumn("level", F.greatest("idx_ms_level", "s10_ms_level", "renko_ms_level"))


def median_spacing(df: DataFrame, most_ms: int, order=("ts_ms", "event_id")) -> DataFrame:
    t = with_before(df.select("ticker_id", *order), "ts_ms", tuple(order), ["ts_ms"])
    t = t.select("ticker_id", (F.col("ts_ms") - F.col("p_ts_ms")).alias("d")).where((F.col("d") > 0) & (F.col("d") < most_ms))
    return t.groupBy("ticker_id").agg(F.round(F.median("d")).cast("bigint").alias("spacing_ms"))


def rank_percentiles(df: DataFrame, value: str, points=(10, 50, 90)) -> DataFrame:
    """Percentiles by rounded rank, without interpolation."""
    v = F.sort_array(F.collect_list(value))
    t = df.groupBy("ticker_id").agg(v.alias("v"))
    return t.select("ticker_id", *(F.get("v", F.round((F.size("v") - 1) * (p / 100)).cast("int")).alias(f"p{p}") for p in points))


def resample_invariants(source: DataFrame, target: DataFrame, ms: int) -> DataFrame:
    """What must hold of a resampled series: (invariant, violations)."""
    b = S.bucket(F.col("ts_ms"), ms)
    bins = source.select("ticker_id", b.alias("ts_ms")).distinct()
    keys = ["ticker_id", "ts_ms"]
    checks = {
        "grid": target.where(F.pmod("ts_ms", F.lit(ms)) != 0),
        "unique": target.groupBy(*keys).count().where("count > 1"),
        "healed": target.where(F.col("flags").bitwiseAND(F.lit(c.HEALED)) == 0),
        "lost": bins.join(target, keys, "left_anti"),
        "invented": target.join(bins, keys, "left_anti"),
    }
    out = None
    for name, bad in checks.items():
        row = bad.agg(F.lit(name).alias("invariant"), F.count("*").alias("violations"))
        out = row if out is None else out.union(row)
    return out
