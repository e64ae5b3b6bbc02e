"""Exchange trade archives as ticks: one CSV layout for each exchange, archives, downloads planned by month and day."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from datetime import date
from itertools import count

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import scalar as S


@dataclass(frozen=True)
class Layout:
    """Columns (from 0) of price, quantity, time and side, and what marks a buyer; ``notional``: volume is price times quantity."""

    price: int
    quantity: int
    time: int
    side: int
    buyer: Callable
    notional: bool = True
    strict: bool = False
    micros: bool = True


def _not(word: str):
    return lambda s: s != word


def _is(word: str):
    return lambda s: F.lower(s) == word


# The layouts of the public archives.
LAYOUTS = {
    "binance": Layout(1, 2, 5, 6, _not("true"), strict=True),
    "bybit": Layout(2, 3, 1, 4, _is("buy")),
    "okx": Layout(3, 4, 5, 2, _is("buy")),
    "bitget": Layout(2, 4, 1, 3, _is("buy"), notional=False, micros=False),
}
URLS = {
    "monthly": "{base}/{exchange}/monthly/{pair}-{month}.zip",
    "daily": "{base}/{exchange}/daily/{pair}-{day}.zip",
}
# Addresses of the public archives, by month and by day; an empty one is not offered.
ARCHIVES = {
    "binance": (
        "https://data.binance.vision/data/spot/monthly/aggTrades/{sym}/{sym}-aggTrades-{y}-{m}.zip",
        "https://data.binance.vision/data/spot/daily/aggTrades/{sym}/{sym}-aggTrades-{y}-{m}-{d}.zip",
    ),
    "bybit": ("https://public.bybit.com/spot/{sym}/{sym}-{y}-{m}.csv.gz", "https://public.bybit.com/spot/{sym}/{sym}_{y}-{m}-{d}.csv.gz"),
    "bitget": ("", "https://img.bitgetimg.com/online/trades/SPBL/{sym}/{y}{m}{d}_{seq}.zip"),
    "okx": (
        "https://static.okx.com/cdn/okex/traderecords/trades/monthly/{y}{m}/{sym}-trades-{y}-{m}.zip",
        "https://static.okx.com/cdn/okex/traderecords/trades/daily/{y}{m}{d}/{sym}-trades-{y}-{m}-{d}.zip",
    ),
}
PROBED = ("binance", "bybit")
MOST_PROBED_MONTHS = 72


def parse(lines: DataFrame, exchange: str, ticker_id: int, provider_id: int) -> DataFrame:
    """``lines`` (value): CSV lines. Rows that don't parse are left out; a strict layout makes them an error."""
    if exchange not in LAYOUTS:
        raise ValueError(f"no such exchange: {exchange}")
    x = LAYOUTS[exchange]
    part = F.split(F.trim("value"), ",")

    def number(i: int):
        return F.try_element_at(part, F.lit(i + 1)).try_cast("double")

    t = lines.select(number(x.price).alias("price"), number(x.quantity).alias("quantity"), number(x.time).alias("time"), F.try_element_at(part, F.lit(x.side + 1)).alias("side"))
    fine = F.col("price").isNotNull() & F.col("time").isNotNull() & F.col("side").isNotNull()
    fine = fine & F.col("quantity").isNotNull() if x.notional else fine
    if x.strict:
        t = t.withColumn("price", F.when(fine, F.col("price")).otherwise(F.raise_error(F.lit("malformed trade line"))))
    else:
        t = t.where(fine)
    quantity = F.coalesce("quantity", F.lit(0.0))
    ts = F.col("time").cast("bigint")
    trades = t.select(
        F.lit(ticker_id).cast("bigint").alias("ticker_id"), F.lit(provider_id).alias("provider_id"), (S.normalise_ts(ts) if x.micros else ts).alias("ts_ms"), "price",
        S.to_u32(F.col("price") * quantity if x.notional else quantity).alias("volume"), x.buyer(F.col("side")).alias("is_buyer"),
    )
    return S.honest_ticks(trades)


def zip_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of all .csv members of zip archives; an archive is read by one task, member by member."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0):
                with zipfile.ZipFile(io.BytesIO(data.as_buffer())) as z:
                    for name in z.namelist():
                        if name.endswith(".csv"):
                            with z.open(name) as f, io.TextIOWrapper(f, "utf-8", errors="replace") as text:
                                while lines := text.readlines(1 << 20):
                                    yield pa.RecordBatch.from_arrays([pa.array([x.rstrip("\r\n") for x in lines])], names=["value"])

    return spark.read.format("binaryFile").option("pathGlobFilter", "[!.]*.zip").load(path).select("content").mapInArrow(run, "value string")


def lines(spark: SparkSession, path: str) -> DataFrame:
    """Plain and gzipped CSV lines."""
    return spark.read.text(path)


def create_source(spark: SparkSession, exchange: str, path: str, ticker_id: int, provider_id: int) -> DataFrame:
    read = zip_lines if path.endswith(".zip") else lines
    return parse(read(spark, path), exchange, ticker_id, provider_id)


def pyth_history(spark: SparkSession, path: str, ticker_id: int, provider_id: int) -> DataFrame:
    """OHLC history (arrays t, c, v) as ticks at closes; half the volume on each side, closes that aren't positive left out."""
    raw = spark.read.schema("s string, t array<bigint>, c array<double>, v array<double>").option("multiLine", "true").json(path)
    x = raw.select(F.explode(F.arrays_zip("t", "c", "v")).alias("x")).select("x.*").where("c > 0 and c < double('infinity')")
    p, half = S.round_sig(F.col("c")), S.to_u32(F.coalesce("v", F.lit(0.0)) / 2)
    return x.select(F.lit(ticker_id).cast("bigint").alias("ticker_id"), F.lit(provider_id).alias("provider_id"), (F.col("t") * 1000).alias("ts_ms"), p.alias("bid"), p.alias("ask"), half.alias("vbid"), half.alias("vask"))


def months(spark: SparkSession, start: str, end: str) -> DataFrame:
    """(month_start, month_end, whole): contiguous cover of [start, end]."""
    t = spark.sql(f"select date'{start}' as a, date'{end}' as b")
    t = t.select("a", "b", F.explode(F.expr("sequence(trunc(a, 'MM'), b, interval 1 month)")).alias("m"))
    s, e = F.greatest("a", "m"), F.least("b", F.last_day("m"))
    return t.select(s.alias("month_start"), e.alias("month_end"), ((s == F.col("m")) & (e == F.last_day("m"))).alias("whole"))


def plan_archives(months_: DataFrame, available: DataFrame) -> DataFrame:
    """Monthly archives where a whole month has one with ticks, else one for each day. ``available``: month_start, ticks."""
    j = months_.join(available, "month_start", "left")
    monthly = F.col("whole") & (F.coalesce("ticks", F.lit(0)) > 0)
    days = F.when(monthly, F.array("month_start")).otherwise(F.sequence("month_start", "month_end"))
    return j.select(F.when(monthly, "monthly").otherwise("daily").alias("kind"), F.explode(days).alias("date"))


def symbol(exchange: str, pair: str) -> str:
    base, quote = pair.upper().replace("/", "-").split("-")
    return f"{base}-{quote}" if exchange == "okx" else base + quote


def archive_url(kind, exchange: str, pair: str, day, base: str = "", seq: int = 1):
    """The archive's address by kind, as a column; null where the exchange has none. ``base``: a mirror in this module's own layout."""

    def filled(text: str):
        out = F.lit(text.replace("{base}", base).replace("{exchange}", exchange).replace("{pair}", pair).replace("{sym}", symbol(exchange, pair)).replace("{seq}", f"{seq:03}"))
        for field, pattern in (("{month}", "yyyy-MM"), ("{day}", "yyyy-MM-dd"), ("{y}", "yyyy"), ("{m}", "MM"), ("{d}", "dd")):
            out = F.replace(out, F.lit(field), F.date_format(day, pattern)) if field in text else out
        return out if text else F.lit(None).cast("string")

    monthly, daily = (URLS["monthly"], URLS["daily"]) if base else ARCHIVES[exchange]
    return F.when(kind == "monthly", filled(monthly)).otherwise(filled(daily))


def sequence_scan(days: list[date], pair: str, fetch: Callable[[str], int]) -> list[str]:
    """Addresses of a day's numbered files, from 1 on until ``fetch`` raises OSError or gives no ticks."""
    found = []
    for day in days:
        for seq in count(1):
            url = ARCHIVES["bitget"][1].format(sym=symbol("bitget", pair), y=f"{day:%Y}", m=f"{day:%m}", d=f"{day:%d}", seq=f"{seq:03}")
            try:
                ticks = fetch(url)
            except OSError:
                break
            if not ticks:
                break
            found.append(url)
    return found


def probe(exchange: str, pair: str, start: date, end: date, there: Callable[[str], bool]) -> tuple[bool, date | None, date | None]:
    """(has data, first month, last month) of the monthly archives, ``MOST_PROBED_MONTHS`` at most looked at from either end.

    Exchanges whose archives can't be asked for are taken to have data.
    """
    if exchange not in PROBED:
        return True, None, None
    a, b = start.year * 12 + start.month - 1, end.year * 12 + end.month - 1

    def has(n: int) -> bool:
        return there(ARCHIVES[exchange][0].format(sym=symbol(exchange, pair), y=f"{n // 12:04}", m=f"{n % 12 + 1:02}"))

    first = next((n for n in range(a, min(b, a + MOST_PROBED_MONTHS - 1) + 1) if has(n)), None)
    if first is None:
        return False, None, None
    last = next((n for n in range(b, max(first, b - MOST_PROBED_MONTHS + 1) - 1, -1) if has(n)), None)
    return True, *(None if n is None else date(n // 12, n % 12 + 1, 1) for n in (first, last))


def download(url: str, target: str, retries: int = 3) -> int:
    """Fetches to a temporary name and renames; a length short of the stated one is a failure that is tried again."""
    import os
    import urllib.request

    for attempt in range(retries):
        part = f"{target}.part"
        with urllib.request.urlopen(url) as r, open(part, "wb") as f:
            want = r.headers.get("Content-Length")
            while block := r.read(8 << 20):
                f.write(block)
        got = os.path.getsize(part)
        if want is None or got >= int(want):
            os.replace(part, target)
            return got
        if attempt == retries - 1:
            os.remove(part)
    raise OSError(f"{url}: truncated {retries} times")
