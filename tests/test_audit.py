"""The audit's verdict for each planted fault."""

import pytest
from pyspark.sql import functions as F

from tidemark import config as c
from tidemark.operators import audit as A
from tidemark.operators import bars as B
from tidemark.operators import filters as D

T0 = 1_704_067_200_000
NOW = T0 + 10 * c.DAY_MS
BAR = 600_000


@pytest.fixture(scope="module")
def fine(spark):
    """Three days of a quote a minute, nothing wrong with it."""
    i = F.col("id")
    t = spark.range(3 * 1440).select(i.alias("event_id"), F.lit(1).cast("bigint").alias("ticker_id"), (F.lit(T0) + i * 60_000).alias("ts_ms"), (100 + F.sin(i / 50.0)).alias("bid"))
    t = t.withColumns({"ask": F.col("bid") + 0.02, "vbid": F.lit(5).cast("bigint"), "vask": F.lit(5).cast("bigint"), "ci_ubp": F.lit(0.001), "confidence": F.lit(1)})
    return t.withColumns({"accepted": F.lit(3), "rejected": F.lit(0), "flags": F.lit(0), "tick_count": F.lit(1)})


@pytest.fixture(scope="module")
def bricks(spark):
    rows = [(1, T0 + n * 3_600_000, n, 100.0 + n, 101.0 + n) for n in range(72)]
    return spark.createDataFrame(rows, "ticker_id bigint, ts_ms bigint, seq bigint, open double, close double")


def judged(spark, t, b=None, roster=(1,), **more):
    bars = b if b is not None else B.gap_fill(B.ohlc(D.skip_sentinels(D.valid_quotes(t)), BAR), BAR)
    out = A.audit(spark.createDataFrame([(x,) for x in roster], "ticker_id bigint"), t, bars, BAR, now_ms=NOW, zero_run=5, min_pct=0.005, **more)
    return {r["ticker_id"]: (r["verdict"], {x.split("=")[0] for x in r["reasons"].split(",") if x}) for r in out.collect()}


def test_nothing_wrong(spark, fine, bricks):
    params = spark.createDataFrame([(1, 0.5, 0.5)], "ticker_id bigint, k double, k_used double")
    coarse = B.rollup(B.ohlc(fine, BAR), 6 * BAR)
    got = judged(spark, fine, roster=(1, 2), bricks=bricks, params=params, coarse=coarse, coarse_ms=6 * BAR)
    assert got == {1: ("PASS", set()), 2: ("NO_DATA", set())}


FAULTS = {
    "missing_days": lambda t: t.where(f"ts_ms < {T0 + c.DAY_MS} or ts_ms >= {T0 + 2 * c.DAY_MS}"),
    "outages": lambda t: t.where(f"ts_ms % {c.DAY_MS} < 40000000 or ts_ms % {c.DAY_MS} > 50000000"),
    "invariants": lambda t: t.withColumn("ask", F.when(F.col("event_id") == 77, F.col("bid") - 1).otherwise(F.col("ask"))),
    "zero_runs": lambda t: t.where(f"ts_ms % {c.DAY_MS} < 40000000 or ts_ms % {c.DAY_MS} > 50000000"),
    "stuck": lambda t: t.withColumns({x: F.when(F.col("event_id").between(200, 600), F.lit(p)).otherwise(F.col(x)) for x, p in (("bid", 100.0), ("ask", 100.02))}),
}


@pytest.mark.parametrize("name", sorted(FAULTS))
def test_record_faults(spark, fine, name):
    verdict, reasons = judged(spark, FAULTS[name](fine))[1]
    assert verdict == "FAIL" and name in reasons


def test_sentinels_excuse_short_gaps(spark, fine):
    t = fine.where("event_id not between 101 and 104")
    assert judged(spark, t, quiet_ms=400_000)[1] == ("PASS", set())
    far = t.withColumn("flags", F.when(F.col("event_id") == 3000, c.SENTINEL).otherwise(0))
    assert judged(spark, far, quiet_ms=400_000)[1] == ("FAIL", {"outages"})
    near = t.withColumn("flags", F.when(F.col("event_id") == 105, c.SENTINEL).otherwise(0))
    assert judged(spark, near, quiet_ms=400_000)[1] == ("PASS", set())


def test_bar_faults(spark, fine):
    bars = B.ohlc(fine, BAR)
    x = F.col("open_ts_ms")
    third = (x / BAR) % 3 == 0
    for name, b in {
        "bar_faults": bars.withColumn("high", F.when(third, F.col("low") - 1).otherwise(F.col("high"))),
        "off_grid": bars.withColumn("open_ts_ms", F.when(third, x + 7).otherwise(x)),
        "low_coverage": bars.where((x % c.DAY_MS < BAR) | (x % c.DAY_MS >= c.DAY_MS - BAR) | (x < T0 + c.DAY_MS) | (x >= T0 + 2 * c.DAY_MS)),
    }.items():
        verdict, reasons = judged(spark, fine, b)[1]
        assert verdict == "FAIL" and name in reasons, name
    coarse = B.rollup(bars, 6 * BAR).withColumn("tick_count", F.col("tick_count") + 1)
    assert judged(spark, fine, coarse=coarse, coarse_ms=6 * BAR)[1] == ("FAIL", {"parity"})


def test_brick_faults(spark, fine, bricks):
    n = F.col("seq")
    params = "ticker_id bigint, k double, k_used double"
    for name, b, p in (
        ("brick_breaks", bricks.withColumn("open", F.when(n == 5, F.col("open") + 0.3).otherwise(F.col("open"))), [(1, 0.5, 0.5)]),
        ("brick_breaks", bricks.withColumn("open", F.when(n == 24, F.col("open") + 0.3).otherwise(F.col("open"))), [(1, 0.5, 0.5)]),
        ("small_bricks", bricks.withColumns({"close": F.when(n == 71, F.col("open") + 0.01).otherwise(F.col("close"))}), [(1, 0.5, 0.5)]),
        ("odd_days", bricks.where((n < 24) | (n >= 40)).withColumn("open", F.when(n == 40, 124.0).otherwise(F.col("open"))), [(1, 0.5, 0.5)]),
        ("uncalibrated", bricks, [(2, 0.5, 0.5)]),
        ("stale_k", bricks, [(1, 0.5, 0.6)]),
    ):
        assert judged(spark, fine, bricks=b, params=spark.createDataFrame(p, params))[1] == ("FAIL", {name}), name


def test_directory(spark, fine):
    day = T0 // c.DAY_MS
    rows = [(1, day, "a", 112, 56, True, T0, T0 + 5), (1, day + 1, "b", 0, 56, True, None, None), (1, day + 2, "c", 100, 56, True, T0 + 2 * c.DAY_MS, T0 + 2 * c.DAY_MS), (1, day + 3, "d", 56, 56, False, T0, T0), (1, day, "e", 56, 56, True, T0, T0)]
    files = spark.createDataFrame(rows, "ticker_id bigint, d int, name string, bytes bigint, record_bytes bigint, known boolean, first_ms bigint, last_ms bigint").withColumn("date", F.date_from_unix_date("d"))
    got = sorted((r["name"], r["code"]) for r in A.directory_findings(files).collect())
    assert got == [("a", "TWIN"), ("b", "EMPTY"), ("c", "TORN"), ("d", "DIR"), ("d", "OUT"), ("e", "TWIN")]
    assert judged(spark, fine, files=files)[1] == ("FAIL", {"torn_files"})


def test_empty(spark, fine, bricks):
    none = fine.limit(0)
    assert judged(spark, none) == {1: ("NO_DATA", set())}
