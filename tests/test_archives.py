"""Archive addresses, scans and probes without a network, and volatility files."""

from datetime import date

import pytest

from tidemark.sources import binary, trades


def test_sequence_scan():
    there = {"20240101_001", "20240101_002", "20240103_001"}

    def fetch(url):
        name = url.rsplit("/", 1)[1].removesuffix(".zip")
        if name == "20240102_001":
            return 0
        if name not in there:
            raise OSError(name)
        return 5

    got = trades.sequence_scan([date(2024, 1, d) for d in (1, 2, 3, 4)], "BTC-USDT", fetch)
    assert [u.rsplit("/", 1)[1].removesuffix(".zip") for u in got] == sorted(there) and all("/BTCUSDT/" in u for u in got)


def test_probe():
    asked = []

    def there(url):
        asked.append(url)
        return "2020-05" <= url[-11:-4] <= "2023-02"

    assert trades.probe("binance", "ETH/USDT", date(2019, 1, 9), date(2024, 6, 1), there) == (True, date(2020, 5, 1), date(2023, 2, 1))
    assert trades.probe("binance", "ETH/USDT", date(2000, 1, 1), date(2010, 1, 1), there) == (False, None, None) and len(asked) <= 17 + 17 + 72
    assert trades.probe("okx", "ETH/USDT", date(2019, 1, 1), date(2024, 6, 1), there) == (True, None, None)


def test_volatility_files(spark, tmp_path):
    rows = [(1, 1_700_000_000_000 + 1_800_000 * i, 0.001 * i) for i in (2, 0, 1)] + [(2, 1_700_001_800_000, 0.5)]
    files = binary.vol_files(spark.createDataFrame(rows, "ticker_id bigint, bin_ts_ms bigint, sigma_pct double")).collect()
    for r in files:
        (tmp_path / str(r["ticker_id"])).mkdir()
        (tmp_path / str(r["ticker_id"]) / "a.vol").write_bytes(r["content"])
        got = [tuple(x) for x in binary.vol(spark, str(tmp_path / str(r["ticker_id"]))).collect()]
        assert got == sorted((ts, pytest.approx(s)) for t, ts, s in rows if t == r["ticker_id"])
