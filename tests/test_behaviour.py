"""Behaviour of operators on small hand-made inputs."""

import gzip
import math
import struct
import zipfile
from datetime import date

import numpy as np
import pytest
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
from tidemark.sources import binary, synthetic, trades
from tidemark.streaming import live

T0 = 1_700_000_000_000
RECORD = "event_id bigint, ticker_id bigint, provider_id int, ts_ms bigint, bid double, ask double, vbid bigint, vask bigint, ci_ubp double, tick_count int, confidence int, accepted int, rejected int, flags int"


def rows(spark, items):
    return spark.createDataFrame([(i, 1, 0, ts, float(b), float(a), vb, va, 1.0, 1, 1, 1, 0, f) for i, (ts, b, a, vb, va, f) in enumerate(items)], RECORD)


def codes(df):
    return sorted({r["code"] for r in df.collect()})


def test_ten_second_stream(spark):
    a = T0 - T0 % 10_000
    items = [(a, 7.5, 7.7, 3, 0), (a + 9_999, 7.1, 7.3, 4, 9), (a + 50_000, 8.0, 8.2, 1, 1), (a + 60_001, 8.4, 8.6, 2, 2), (a + 69_000, 8.3, 8.5, 6, 5)]
    bars = sorted(B.gap_fill(B.ohlc(rows(spark, [(*x, 0) for x in items]), 10_000), 10_000).collect(), key=lambda r: r["open_ts_ms"])
    assert [r["open_ts_ms"] - a for r in bars] == [10_000 * i for i in range(7)]
    assert [r["tick_count"] for r in bars] == [2, 0, 0, 0, 0, 1, 2]
    assert all(r["open"] == r["high"] == r["close"] == pytest.approx(7.2) and r["vask"] == 0 for r in bars[1:5]) and bars[6]["vbid"] == 8


def test_sentinels_change_nothing(spark):
    real = [(T0 + 100 * i, 100 + 0.01 * i, 100.02 + 0.01 * i, 1, 1, 0) for i in range(300)]
    junk = [(T0 + 100 * i + 50, 9999, 9999.5, 5, 5, c.SENTINEL) for i in range(-1, 301)]
    a, b = (B.ohlc(D.skip_sentinels(rows(spark, x)), 10_000).drop("event_id") for x in (real, sorted(real + junk)))
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    assert sorted(map(str, B.ohlc(rows(spark, real + junk), 10_000).collect())) != sorted(map(str, a.collect()))


def test_findings(spark):
    good = [(T0 + 100 * i, 100.0, 100.1, 1000, 1000, 0) for i in range(32)]
    assert codes(Q.record_findings(rows(spark, good))) == []
    assert codes(Q.record_findings(rows(spark, [(T0, 100, 100.1, 1, 1, 0), (T0 + 100, 100, 100.1, 1, 1, 0), (T0 + 50, 100, 100.1, 1, 1, 0)]), ("event_id",))) == ["MO"]
    assert codes(Q.record_findings(rows(spark, [(T0, 100.5, 100.0, 1, 1, 0)]))) == ["G7", "XQ"]
    assert codes(Q.record_findings(rows(spark, [(T0, 100, 100.1, 0, 0, 0), (T0 + 9, 100, 100.1, 0, 0, c.NO_BOOK)]))) == ["G10E"]
    assert codes(Q.record_findings(rows(spark, [(T0, 100, 100.1, 1, 1, 0), (T0 + 99, 130, 130.1, 1, 1, 0), (T0 + 999_999, 200, 200.1, 1, 1, 0)]))) == ["G5", "GAP"]
    assert codes(Q.record_findings(rows(spark, [(T0, float("nan"), 100.1, 1, 1, 0)]))) == ["G1"]
    vol = spark.createDataFrame([(1, 0, 0.01), (1, 1_800_000, float("nan")), (1, 5_400_000, 7.0)], "ticker_id bigint, bin_ts_ms bigint, sigma_pct double")
    assert codes(Q.vol_findings(vol)) == ["GAP", "HIGH", "NONFINITE", "RANGE"]


def test_resample_keeps_the_last(spark):
    t = rows(spark, [(T0 + 100 * i, 100, 100.1, 1, 1, 0) for i in range(10)]).withColumn("confidence", (F.col("event_id") + 1).cast("int"))
    out = sorted(B.resample_last(t, 200).collect(), key=lambda r: r["ts_ms"])
    assert [r["confidence"] for r in out] == [2, 4, 6, 8, 10] and all(r["flags"] & c.HEALED for r in out)
    assert sum(r["violations"] for r in Q.resample_invariants(t, B.resample_last(t, 200), 200).collect()) == 0


def test_heal_is_verbatim_for_single_records(spark):
    out = sorted(B.heal(rows(spark, [(T0, 100, 101, 3, 5, 2), (T0 + 1000, 10, 20, 1, 0, 0), (T0 + 1001, 40, 60, 3, 0, 2)]), 200).collect(), key=lambda r: r["ts_ms"])
    assert (out[0]["bid"], out[0]["flags"]) == (100, 2) and (out[1]["bid"], out[1]["ask"], out[1]["flags"]) == (32.5, 40, 18)


def test_saturation(spark):
    t = rows(spark, [(T0, 1, 2, c.U32, 1, 0), (T0 + 1, 1, 2, c.U32, 1, 0)])
    assert B.heal(t, 200).first()["vbid"] == c.U32
    values = [-1.0, 0.9, 1e300, float("nan"), None, 4294967295.5]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "x double").select(S.to_u32(F.col("x"))).collect()]
    assert got == [0, 0, c.U32, 0, 0, c.U32]


def test_cross_quotes(spark):
    base = rows(spark, [(T0, 3000, 3001, 1, 1, 0), (T0 + 20_000, 3000, 3001, 1, 1, 0)])
    quote = rows(spark, [(T0, 60000, 60010, 1, 1, 0)])
    out = sorted(M.cross(base, quote).collect(), key=lambda r: r["ts_ms"])
    assert out[0]["bid"] == 3000 / 60010 and out[0]["ask"] == 3001 / 60000
    assert [(r["leg"], r["fresh"]) for r in out] == [(1, True), (0, False)]


def test_cross_keeps_state_over_midnight(spark):
    d = T0 - T0 % c.DAY_MS
    base, quote = rows(spark, [(d + 1, 10, 11, 1, 1, 0)]), rows(spark, [(d + 3 * c.DAY_MS, 5, 6, 1, 1, 0)])
    assert [(r["bid"], r["fresh"]) for r in M.cross(base, quote).collect()] == [(10 / 6, False)]


def test_quarantine(spark):
    def of(n):
        return R.quarantine(spark.createDataFrame([(1, x) for x in n], "ticker_id bigint, n bigint")).first()

    week = of([41, 0, 43, 44, 40, 0, 900, 42])
    assert (week["clean"], week["median"], week["dead"]) == (6, 42.5, False)
    assert of([0, 12, 0, 0, 0, 11, 0])["dead"]


def test_clamp_fraction(spark):
    t = spark.createDataFrame([(1, 0.0003), (1, 0.004), (1, 0.0031), (1, 0.05)], "ticker_id bigint, sigma double")
    assert R.clamp_fraction(t, 0.25, 0.0008).first()["fraction"] == pytest.approx(0.5)


def path(days=12, per_day=1500, sigma=0.006, seed=7):
    rng = np.random.default_rng(seed)
    n = days * per_day
    mid = 100 * np.exp(np.cumsum(sigma * (rng.random(n) - 0.5)))
    return T0 - T0 % c.DAY_MS + np.arange(n) * (c.DAY_MS // per_day), mid, np.full(n, 0.01)


def test_solver():
    ts, mid, sigma = path()
    s = c.Calibration(min_pct=1e-6)
    k = R.fit(ts, mid, sigma, s)
    assert k and abs(R.median_count(R.counts(ts, mid, sigma, k, s.min_pct))[0] / 300 - 1) <= 0.05
    coarse = R.median_count(R.counts(ts[::20], mid[::20], sigma[::20], k, s.min_pct))[0]
    assert coarse < 300
    assert R.fit(ts, np.full(len(ts), 100.0), sigma, s) == 0.0
    assert R.fit(ts, mid, sigma, c.Calibration(min_pct=1.0)) == 0.0
    assert R.fit(ts[:1], mid[:1], sigma[:1], s) == 0.0


def test_walk_forward_does_not_look_ahead(spark):
    ts, mid, sigma = path(8, 400)
    s = c.Calibration(target=100, min_pct=1e-6)

    def run(m):
        df = spark.createDataFrame([(1, int(t), i, float(x), float(v)) for i, (t, x, v) in enumerate(zip(ts, m, sigma))], "ticker_id bigint, ts_ms bigint, event_id bigint, mid double, sigma double")
        return {r["date"]: r["k"] for r in R.walk_forward(df, s, 3).collect()}

    changed = mid.copy()
    changed[6 * 400 :] *= np.linspace(1, 1.05, len(changed) - 6 * 400)
    a, b = run(mid), run(changed)
    first = min(a)
    assert all(a[d] == b[d] for d in a if (d - first).days <= 3)


def test_renko_guard():
    s = R.State()
    assert [s.step(m, 1.0)[1] for m in (100.0, 102.5, 100.4, 150.0)] == [0, 2, -1, 0]
    for _ in range(9):
        s.step(150.0, 1.0)
    assert s.last == 150.0


def test_ema_equals_recursion(spark):
    rng = np.random.default_rng(1)
    x = rng.random(700)
    df = spark.createDataFrame([(1, i * 1_800_000, float(v)) for i, v in enumerate(x)], "ticker_id bigint, bin_ts_ms bigint, sigma_pct double")
    got = [r["ema"] for r in V.ema(df).orderBy("bin_ts_ms").collect()]
    want = []
    for i, v in enumerate(x):
        want.append(x[: i + 1].mean() if i < 28 else want[-1] * (1 - 2 / 29) + v * 2 / 29)
    assert np.allclose(got, want, atol=1e-12, rtol=0)


def test_rollup_is_associative(spark):
    t = rows(spark, [(T0 + 7_000 * i, 100 + math.sin(i), 100.1 + math.sin(i), i % 5, i % 3, 0) for i in range(400)])
    fine = B.ohlc(t, 10_000)
    a, b = B.rollup(fine, 600_000), B.rollup(B.rollup(fine, 60_000), 600_000)
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_shards_and_params(spark, tmp_path):
    d = T0 - T0 % c.DAY_MS
    t = rows(spark, [(d - 100, 1, 2, 1, 1, 0), (d + 100, 1, 2, 1, 1, 0)]).drop("event_id")
    p = str(tmp_path / "idx")
    W.write_shards(t, p)
    W.write_shards(t.where(F.col("ts_ms") > d), p)
    assert spark.read.parquet(p).count() == 2 and len(list((tmp_path / "idx").glob("*/date=*"))) == 2
    W.write_shards(t, p + "2", today=date(2023, 11, 14))
    assert W.read_shards(spark, p + "2").count() == 1
    W.heal_tree(spark, p, p + "3")
    assert W.read_shards(spark, p + "3", date(2023, 11, 14)).count() == 1
    k = spark.createDataFrame([(1, 0.5)], "ticker_id bigint, k double")
    W.save_params(k, p + "k", "a")
    W.save_params(k.withColumn("k", F.lit(0.7)), p + "k", "b")
    W.save_params(k.withColumn("k", F.lit(0.6)), p + "k", "a")
    assert sorted((r["run_id"], r["k"]) for r in spark.read.parquet(p + "k").collect()) == [("a", 0.6), ("b", 0.7)]
    assert W.pending(spark.createDataFrame([(1,), (2,)], "ticker_id bigint"), spark, p + "k", "a").collect()[0]["ticker_id"] == 2


def test_csv_layouts(spark, tmp_path):
    lines = {
        "binance": ["1,100.123456,2,5,6,1700000000000,true,x", "2,100.1,3,5,6,1700000000000000,false,x"],
        "bybit": ["timestamp,symbol,side", "x,1700000000000,100.5,2,Buy", "x,oops"],
        "okx": ["a,b,sell,100.5,2,1700000000000", "junk"],
        "bitget": ["x,1700000000000,100.5,sell,bad", "x,1700000000000,100.5,buy,7.9"],
    }
    got = {}
    for name, text in lines.items():
        (tmp_path / f"{name}.csv.gz").write_bytes(gzip.compress("\n".join(text).encode()))
        with zipfile.ZipFile(tmp_path / f"{name}.zip", "w") as z:
            z.writestr("a.csv", "\n".join(text))
            z.writestr("notes.txt", "no")
        a, b = (sorted(map(tuple, trades.create_source(spark, name, str(tmp_path / f"{name}.{x}"), 3, 1).collect())) for x in ("csv.gz", "zip"))
        assert a == b
        got[name] = a
    assert [r[2:] for r in got["binance"]] == [(T0, 100.1, 100.1, 0, 300), (T0, 100.123, 100.123, 200, 0)]
    assert got["bybit"] == [(3, 1, T0, 100.5, 100.5, 0, 201)] and got["okx"] == [(3, 1, T0, 100.5, 100.5, 201, 0)]
    assert [r[5:] for r in got["bitget"]] == [(0, 0), (0, 7)]
    with pytest.raises(ValueError):
        trades.parse(spark.createDataFrame([("x",)], "value string"), "nowhere", 1, 1)
    with pytest.raises(Exception, match="malformed"):
        trades.parse(spark.createDataFrame([("x,y",)], "value string"), "binance", 1, 1).collect()


def test_other_sources(spark, tmp_path):
    (tmp_path / "h.json").write_text('{"s": "ok", "t": [1700000000, 1700000060], "c": [100.1234567, -1], "v": [9, 9]}')
    assert [tuple(r) for r in trades.pyth_history(spark, str(tmp_path / "h.json"), 1, 2).collect()] == [(1, 2, T0, 100.123, 100.123, 4, 4)]
    mts = (T0 - c.MTS_EPOCH_MS) * 1000 // 16
    tick = struct.pack("<HH6s6sQddII", 1, 4, mts.to_bytes(6, "little"), b"\0" * 6, 77, 1.5, 1.5, 3, 0)
    (tmp_path / "a.ticks").write_bytes(tick * 3)
    (tmp_path / "a.vol").write_bytes(struct.pack("<6sd", mts.to_bytes(6, "little"), 0.25))
    got = binary.ticks(spark, str(tmp_path)).collect()
    assert len(got) == 3 and tuple(got[0]) == (77, 4, T0, 1.5, 1.5, 3, 0)
    assert [tuple(r) for r in binary.vol(spark, str(tmp_path)).collect()] == [(T0, 0.25)]
    (tmp_path / "b.ticks").write_bytes(tick[:-1])
    with pytest.raises(Exception, match="whole records"):
        binary.ticks(spark, str(tmp_path)).collect()


def test_download(tmp_path):
    (tmp_path / "x").write_bytes(b"abc")
    assert trades.download(f"file://{tmp_path}/x", str(tmp_path / "y")) == 3 and (tmp_path / "y").read_bytes() == b"abc"


@pytest.mark.parametrize("model", sorted(synthetic.MODELS))
def test_synthetic(spark, model):
    run = lambda seed: sorted(map(tuple, synthetic.MODELS[model](spark, 2, 400, seed=seed).collect()))
    a = run(1)
    assert len(a) == 800 and a == run(1) and a != run(2) and all(p > 0 and math.isfinite(p) for *_, p in a)
    q = synthetic.quotes(synthetic.MODELS[model](spark, 1, 50)).collect()
    assert all(r["ask"] > r["bid"] and (r["vbid"] == 0) != (r["vask"] == 0) or r["vbid"] == r["vask"] == 0 for r in q)


def stream(spark, df, tmp_path, name, batches=3):
    """``df`` as a file stream of several batches."""
    path = str(tmp_path / name)
    for i, part in enumerate(df.randomSplit([1.0] * batches, seed=3) if name == "any" else [df.where(F.pmod(F.floor(F.col("event_id") / 100), F.lit(batches)) == i) for i in range(batches)]):
        part.coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_streamed_bars_equal_batch(spark, tmp_path):
    df = rows(spark, [(T0 + 700 * i, 100 + i % 7, 100.1 + i % 7, 1, 1, 0) for i in range(300)] + [(T0 + 10_000_000, 1, 2, 1, 1, 0)])
    q = live.ohlc(stream(spark, df, tmp_path, "s", 1)).writeStream.format("memory").queryName("bars_out").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    got = sorted(map(tuple, spark.sql("select ticker_id, open_ts_ms, open, high, low, close from bars_out").collect()))
    want = sorted(map(tuple, B.ohlc(df.where(F.col("event_id") < 300), 10_000).select("ticker_id", "open_ts_ms", "open", "high", "low", "close").collect()))
    assert got == want


def test_streamed_bricks_equal_batch(spark, tmp_path):
    ts, mid, _ = path(1, 300)
    df = spark.createDataFrame([(1, int(t), i, float(m), 0.25) for i, (t, m) in enumerate(zip(ts, mid))], "ticker_id bigint, ts_ms bigint, event_id bigint, mid double, brick double")
    want = sorted(map(tuple, R.bricks(df).collect()))
    p = str(tmp_path / "r")
    for a in (0, 100, 200):
        df.where(F.col("event_id").between(a, a + 99)).coalesce(1).write.mode("append").parquet(p)
        if a == 0:
            q = live.renko(spark.readStream.schema(df.schema).parquet(p)).writeStream.format("memory").queryName("bricks_out").outputMode("append").start()
        q.processAllAvailable()
    q.stop()
    assert want and sorted(map(tuple, spark.sql("select * from bricks_out").collect())) == want
