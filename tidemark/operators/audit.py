"""Checks of bars and bricks, and the audit that puts all families of checks behind one verdict for each ticker."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import config as c
from tidemark.functions import scalar as S
from tidemark.operators import quality as Q
from tidemark.operators.renko import continuity

# Kinds of bars, and bounds of the checks.
KLINE, RENKO, LAST_KIND = 0, 1, 3
ZERO_RUN, K_STALE, LEAST_COVERAGE, DAY_LOW, DAY_HIGH = 30, 0.05, 0.5, 0.5, 2.0
SAMPLES, REPORT_GAPS = 10, 10


def _day(ms: str) -> Column:
    return F.floor(F.col(ms) / c.DAY_MS)


def _coded(df: DataFrame, keys: list[str], checks: list[tuple[str, Column, str]]) -> DataFrame:
    found = F.filter(F.array(*(F.when(bad, F.struct(F.lit(code).alias("code"), F.lit(s).alias("severity"))) for code, bad, s in checks)), lambda x: x.isNotNull())
    return df.select(*keys, F.explode(found).alias("x")).select(*keys, "x.code", "x.severity")


def bar_series_findings(bars: DataFrame, ms: int, min_pct: float = 0.0) -> DataFrame:
    """(ticker_id, open_ts_ms, code, severity) of bars of any kind, against the ticker's bar before.

    KIND: none that there is; TIME: it closes before it opens; OHLC: not finite; HIGH, LOW; VAR: a negative variance; GRID and
    SPACE: off the grid of ``ms``, or a whole number of bars too far (SGAP, a warning); IMB, SPRD, RET: microstructure out of
    range; DRIFT a warning; KGAP: a bar does not open where the one before closed; BRICK: nor a brick at its price; FLOOR: a
    brick below ``min_pct``. Columns that the bars lack are not checked.
    """
    t = bars if "kind" in bars.columns else bars.withColumn("kind", F.lit(KLINE))
    t = Q.with_before(t, "open_ts_ms", ("open_ts_ms", "close_ts_ms"), ["close_ts_ms", "close", "kind"])
    prices = ["open", "high", "low", "close"]
    odd = [F.isnan(x) | (F.abs(F.col(x)) == float("inf")) | F.col(x).isNull() for x in prices]
    broken = odd[0] | odd[1] | odd[2] | odd[3]
    kline, brick = F.col("kind") == KLINE, F.col("kind") == RENKO
    step = F.col("close_ts_ms") - F.col("p_close_ts_ms")
    follows = kline & (F.col("p_kind") == KLINE)
    has = set(bars.columns)
    near = F.abs("p_close") * 1e-12 + 1e-12
    checks = [
        ("KIND", ~F.col("kind").between(0, LAST_KIND), "E"),
        ("TIME", F.col("open_ts_ms") > F.col("close_ts_ms"), "E"),
        ("OHLC", broken, "E"),
        ("HIGH", ~broken & (F.col("high") < F.greatest("open", "close", "low")), "E"),
        ("LOW", ~broken & (F.col("low") > F.least("open", "close", "high")), "E"),
        ("VAR", F.col("realized_var") < 0 if "realized_var" in has else F.lit(False), "E"),
        ("GRID", kline & (F.pmod("open_ts_ms", F.lit(ms)) != 0), "E"),
        ("SPACE", follows & (F.pmod(step, F.lit(ms)) != 0), "E"),
        ("SGAP", follows & (step > ms) & (F.pmod(step, F.lit(ms)) == 0), "W"),
        ("IMB", F.abs("vol_imbalance") > 1.001 if "vol_imbalance" in has else F.lit(False), "E"),
        ("SPRD", F.col("avg_spread_bps") < 0 if "avg_spread_bps" in has else F.lit(False), "E"),
        ("RET", F.col("max_abs_return") < 0 if "max_abs_return" in has else F.lit(False), "E"),
        ("DRIFT", F.abs("drift") > 1.0 if "drift" in has else F.lit(False), "W"),
        ("KGAP", follows & (F.col("open_ts_ms") != F.col("p_close_ts_ms") + 1), "W"),
        ("BRICK", brick & (F.col("p_kind") == RENKO) & (F.abs(F.col("p_close") - F.col("open")) > near), "E"),
        ("FLOOR", brick & ~broken & (F.col("open") > 0) & (F.abs(F.col("close") - F.col("open")) < F.col("open") * min_pct), "E"),
    ]
    return _coded(t, ["ticker_id", "open_ts_ms"], checks)


def directory_findings(listing: DataFrame) -> DataFrame:
    """(ticker_id, date, name, code, severity) of shard files (ticker_id, date, name, bytes, record_bytes, known, first_ms, last_ms).

    EMPTY: no bytes (a warning); TORN: a last record that is cut; DIR: an id that no list knows; OUT: a first or last record of
    another UTC day than the file's; TWIN: two files of a ticker and day.
    """
    day = F.unix_date("date")
    twin = F.count("*").over(Window.partitionBy("ticker_id", "date")) > 1
    checks = [
        ("EMPTY", F.col("bytes") == 0, "W"),
        ("TORN", F.pmod("bytes", "record_bytes") != 0, "E"),
        ("DIR", ~F.col("known"), "E"),
        ("OUT", (_day("first_ms") != day) | (_day("last_ms") != day), "E"),
        ("TWIN", F.col("twin"), "E"),
    ]
    return _coded(listing.withColumn("twin", twin), ["ticker_id", "date", "name"], checks)


def capped_samples(findings: DataFrame, most: int = SAMPLES, order: str = "event_id") -> DataFrame:
    """The first ``most`` findings of each ticker and code, and how many there are."""
    w = Window.partitionBy("ticker_id", "code")
    t = findings.withColumns({"nth": F.row_number().over(w.orderBy(order)), "total": F.count("*").over(w)})
    return t.where(F.col("nth") <= most)


def last_bars(bars: DataFrame, most: int) -> DataFrame:
    """Each ticker's last ``most`` bars."""
    w = Window.partitionBy("ticker_id").orderBy(F.desc("open_ts_ms"))
    return bars.withColumn("nth", F.row_number().over(w)).where(F.col("nth") <= most).drop("nth")


def vol_index(vol: DataFrame, records: DataFrame, ms: int = c.VOL_BIN_MS) -> DataFrame:
    """(ticker_id, bin_ts_ms, kind): bins that have a volatility and no record (vol), or records and no volatility (idx)."""
    a = vol.select("ticker_id", "bin_ts_ms").distinct().withColumn("v", F.lit(1))
    b = records.select("ticker_id", S.bucket(F.col("ts_ms"), ms).alias("bin_ts_ms")).distinct().withColumn("r", F.lit(1))
    j = a.join(b, ["ticker_id", "bin_ts_ms"], "full").where("v is null or r is null")
    return j.select("ticker_id", "bin_ts_ms", F.when(F.col("r").isNull(), "vol").otherwise("idx").alias("kind"))


def resample_report(source: DataFrame, target: DataFrame, most_ms: int, shard_ticker: str = "shard_ticker_id") -> DataFrame:
    """A row for each shard: rows before and after, median spacings, and records of other tickers that it held."""

    def side(df: DataFrame, name: str) -> DataFrame:
        t = Q.with_before(df.select("ticker_id", "ts_ms", "event_id"), "ts_ms", ("ts_ms", "event_id"), ["ts_ms"]).withColumn("day", _day("ts_ms"))
        d = F.col("ts_ms") - F.col("p_ts_ms")
        return t.groupBy("ticker_id", "day").agg(F.count("*").alias(f"count_{name}"), F.round(F.median(F.when((d > 0) & (d < most_ms), d))).cast("bigint").alias(f"spacing_{name}_ms"))

    other = source.where(F.col("ticker_id") != F.col(shard_ticker)).groupBy(F.col(shard_ticker).alias("ticker_id"), _day("ts_ms").alias("day")).agg(F.count("*").alias("misrouted"))
    j = side(source.where(F.col("ticker_id") == F.col(shard_ticker)), "old").join(side(target, "new"), ["ticker_id", "day"], "full").join(other, ["ticker_id", "day"], "left")
    return j.na.fill(0, ["count_old", "count_new", "misrouted"]).withColumn("date", F.date_from_unix_date(F.col("day").cast("int")).cast("string")).drop("day")


def _count(df: DataFrame, name: str, amount: Column | None = None) -> DataFrame:
    return df.groupBy("ticker_id").agg((F.count("*") if amount is None else amount).cast("bigint").alias(name))


#: Counts that fail a ticker where they are above 0, in the order in which they are told.
FAILING = ("outages", "missing_days", "invariants", "bar_faults", "off_grid", "low_coverage", "zero_runs", "parity", "stuck", "brick_breaks", "small_bricks", "odd_days", "uncalibrated", "stale_k", "torn_files")


def audit(
    roster: DataFrame,
    records: DataFrame,
    bars: DataFrame,
    ms: int,
    coarse: DataFrame | None = None,
    coarse_ms: int = 0,
    bricks: DataFrame | None = None,
    params: DataFrame | None = None,
    files: DataFrame | None = None,
    max_gap_ms: int = 120_000,
    quiet_ms: int = 60_000,
    zero_run: int = ZERO_RUN,
    min_pct: float = 0.0,
    now_ms: int | None = None,
    stuck: dict | None = None,
) -> DataFrame:
    """(ticker_id, rows, one count for each family of checks, verdict, reasons) of every ticker of ``roster``.

    Gaps are judged by session and sentinels; days without records between the first and the last are missing; invariants are
    the errors of records, depth apart; bars are checked one by one, for their grid, their coverage of each day, and runs
    without ticks; ``coarse`` against their roll-up; ``bricks`` for continuity, size, and days far from the median; ``params``
    (ticker_id, k, k_used) for bricks without a k, or of another; ``files`` as in ``directory_findings``. NO_DATA is a ticker of
    the roster without a record.
    """
    order = ("ts_ms", "event_id")
    moved = Q.with_before(records, "ts_ms", order, ["ts_ms"])
    gap = F.col("ts_ms") - F.col("p_ts_ms")
    gaps = moved.where(gap > max_gap_ms).select("ticker_id", F.col("p_ts_ms").alias("from_ms"), F.col("ts_ms").alias("to_ms"), gap.alias("gap_ms"))
    kinds = Q.classify_gaps(Q.session_overlap(gaps, records), records, max_gap_ms, quiet_ms)
    days = records.select("ticker_id", _day("ts_ms").alias("day")).distinct().groupBy("ticker_id").agg((F.max("day") - F.min("day") + 1 - F.count("*")).alias("missing_days"))
    found = Q.record_findings(records, now_ms=now_ms)
    series = bar_series_findings(bars, ms, min_pct)
    quiet = Q.flat_runs(bars, F.col("tick_count") == 0, ("open_ts_ms",), zero_run).where("v")
    parts = [
        _count(records, "rows"),
        _count(kinds.where("kind = 'OUTAGE'"), "outages"),
        days.select("ticker_id", F.col("missing_days").cast("bigint")),
        _count(found.where("severity = 'E' and code not like 'G10%'"), "invariants"),
        _count(series.where("severity = 'E' and code not in ('GRID', 'SPACE')"), "bar_faults"),
        _count(series.where("code in ('GRID', 'SPACE')"), "off_grid"),
        _count(Q.coverage(bars, ms).where(F.col("share") < LEAST_COVERAGE), "low_coverage"),
        _count(quiet, "zero_runs"),
        _count(Q.shard_findings(records, **(stuck or {})), "stuck"),
    ]
    if coarse is not None:
        parts.append(_count(Q.parity(bars, coarse, coarse_ms).where("not equal"), "parity"))
    if bricks is not None:
        # Bricks of one tick share its time, so their number orders them.
        w = Window.partitionBy("ticker_id", _day("ts_ms")).orderBy("seq")
        inner = bricks.withColumn("p", F.lag("close").over(w)).where(F.abs(F.col("p") - F.col("open")) > F.abs("p") * 1e-9 + 1e-12)
        breaks = inner.select("ticker_id").union(continuity(bricks).where("broken").select("ticker_id"))
        small = bricks.where(F.abs(F.col("close") - F.col("open")) < F.col("open") * min_pct)
        per_day = bricks.groupBy("ticker_id", _day("ts_ms").alias("day")).agg(F.count("*").alias("n"))
        middle = per_day.groupBy("ticker_id").agg(F.median("n").alias("middle"))
        odd = per_day.join(middle, "ticker_id").where((F.col("n") < DAY_LOW * F.col("middle")) | (F.col("n") > DAY_HIGH * F.col("middle")))
        parts += [_count(breaks, "brick_breaks"), _count(small, "small_bricks"), _count(odd, "odd_days")]
        if params is not None:
            have = bricks.select("ticker_id").distinct().join(params, "ticker_id", "left")
            parts += [_count(have.where("k is null"), "uncalibrated"), _count(have.where(F.abs(F.col("k_used") - F.col("k")) > K_STALE * F.col("k")), "stale_k")]
    if files is not None:
        parts.append(_count(directory_findings(files).where("severity = 'E'"), "torn_files"))
    out = roster.select("ticker_id").distinct()
    for p in parts:
        out = out.join(p, "ticker_id", "left")
    names = [x for x in FAILING if x in out.columns]
    out = out.na.fill(0, ["rows", *names])
    reasons = F.concat_ws(",", *(F.when(F.col(x) > 0, F.concat(F.lit(f"{x}="), F.col(x).cast("string"))) for x in names))
    verdict = F.when(F.col("rows") == 0, "NO_DATA").when(F.length("reasons") > 0, "FAIL").otherwise("PASS")
    return out.withColumn("reasons", F.when(F.col("rows") > 0, reasons).otherwise("")).withColumn("verdict", verdict)
