"""Scalar computations as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import config as c


def mid(bid="bid", ask="ask") -> Column:
    return (F.col(bid) + F.col(ask)) * 0.5


def spread_bps(bid="bid", ask="ask") -> Column:
    return (F.col(ask) - F.col(bid)) / mid(bid, ask) * 10_000


def round_sig(x: Column, digits: int = 6) -> Column:
    """To significant digits, halves away from zero; 0 stays 0."""
    scale = F.pow(F.lit(10.0), (digits - 1) - F.floor(F.log10(F.abs(x))))
    return F.when(x == 0, F.lit(0.0)).otherwise(F.round(x * scale) / scale)


def to_u32(x: Column) -> Column:
    """Truncated towards zero into 0 to 2**32 - 1; null and NaN become 0."""
    x = x.cast("double")
    return F.when(x.isNull() | F.isnan(x) | (x < 0), F.lit(0)).when(x >= c.U32, F.lit(c.U32)).otherwise(x.cast("bigint")).cast("bigint")


def normalise_ts(ts: Column) -> Column:
    """Microseconds (above 10**13) to milliseconds."""
    return F.when(ts > 10**13, F.floor(ts / 1000)).otherwise(ts).cast("bigint")


def bucket(ts: Column, ms: int) -> Column:
    return ts - F.pmod(ts, F.lit(ms))


def mts(ts_ms: Column) -> Column:
    """16-microsecond ticks since 2010, 0 before."""
    return F.greatest(F.lit(0), F.floor((ts_ms - c.MTS_EPOCH_MS) * 1000 / 16)).cast("bigint")


def utc_date(ts_ms: Column) -> Column:
    return F.date_add(F.lit("1970-01-01").cast("date"), F.floor(ts_ms / c.DAY_MS).cast("int"))


def rs_sigma(o="open", h="high", l="low", cl="close") -> Column:  # noqa: E741
    """Rogers-Satchell volatility of a bar."""
    o, h, l, cl = map(F.col, (o, h, l, cl))  # noqa: E741
    return F.sqrt(F.greatest(F.lit(0.0), F.log(h / o) * F.log(h / cl) + F.log(l / o) * F.log(l / cl)))


def honest_ticks(trades: DataFrame, *keep: str) -> DataFrame:
    """Trades as quotes: both sides at the price of 6 digits; the aggressor's side carries the volume."""
    p = round_sig(F.col("price"))
    return trades.select(
        *keep, "ticker_id", "provider_id", "ts_ms", p.alias("bid"), p.alias("ask"),
        F.when(F.col("is_buyer"), F.lit(0)).otherwise(F.col("volume")).cast("bigint").alias("vbid"),
        F.when(F.col("is_buyer"), F.col("volume")).otherwise(F.lit(0)).cast("bigint").alias("vask"),
    )


def confidence_ratio(conf="confidence", flags="flags", accepted="accepted") -> Column:
    """By flag: ticking legs over accepted, freshness over 255, or the provider count over accepted."""
    legs = F.col(conf).bitwiseAND(F.lit(127))
    active, fresh = (F.col(flags).bitwiseAND(F.lit(f)) != 0 for f in (c.CONF_ACTIVE, c.CONF_FRESHNESS))
    return F.when(active, legs / F.col(accepted)).when(fresh, F.col(conf) / 255).otherwise(F.col(conf) / F.col(accepted))


def ticker_bits(id_: Column) -> list[Column]:
    """The fields of a packed 64-bit ticker id."""
    fields = {"itype": (60, 15), "base_class": (56, 15), "base_id": (40, 65535), "quote_class": (36, 15), "quote_id": (20, 65535), "sub_type": (0, 1048575)}
    return [F.shiftrightunsigned(id_, shift).bitwiseAND(F.lit(mask).cast("bigint")).alias(name) for name, (shift, mask) in fields.items()]


def rebase_quote(id_: Column, quote_class: int = 3, quote_id: int = 5001) -> Column:
    keep = ~((0xF << 36) | (0xFFFF << 20))
    return id_.bitwiseAND(F.lit(keep).cast("bigint")).bitwiseOR(F.lit((quote_class << 36) | (quote_id << 20)).cast("bigint"))


def pair_parts(pair: Column) -> tuple[Column, Column]:
    """Upper-case base and quote of a pair split at / - or _."""
    parts = F.split(F.upper(pair), "[/_-]")
    return F.element_at(parts, 1), F.try_element_at(parts, F.lit(2))


def asset_class(base: Column, quote: Column) -> Column:
    fiat, stable, major = (lambda x, names=names: x.isin(*names) for names in (c.FIAT, c.STABLES, c.MAJORS))
    return (
        F.when(fiat(base) & fiat(quote), F.when((base == "USD") | (quote == "USD"), "fx_major").otherwise("fx_cross"))
        .when(stable(base), "crypto_stable")
        .when(~stable(quote) & ~fiat(quote), "crypto_cross")
        .when(major(base), "crypto_major")
        .otherwise("crypto_alt")
    )


def target_bpd(pair: Column, klass: Column, overrides: dict[str, int], default: int = 300) -> Column:
    """Bricks a day: the pair's own target, else its class's, else the default."""

    def look(table: dict, key: Column) -> Column:
        return F.create_map(*(F.lit(x) for kv in table.items() for x in kv))[key] if table else F.lit(None)

    return F.coalesce(look(overrides, pair), look(c.CLASS_TARGETS, klass), F.lit(default)).cast("int")


def inferred_usdc(pair: Column) -> Column:
    """The base of a USDC pair, any case, unless it is a stablecoin itself."""
    base, quote = pair_parts(pair)
    return F.when((quote == "USDC") & ~base.isin(*c.STABLES), base)


def gap_severity(ms: Column) -> Column:
    return F.when(ms >= 3_600_000, "CRITICAL").when(ms >= 300_000, "MAJOR").when(ms >= 60_000, "MINOR")


def latency_level(value: Column, warn: float, fail: float) -> Column:
    """0 fine, 1 warning, 2 failure."""
    return F.when(value >= fail, 2).when(value >= warn, 1).otherwise(0)


def is_truncated(got: Column, length: Column) -> Column:
    """Whether a download ended before its stated length; without one it counts as whole."""
    return F.coalesce(got < length, F.lit(False))


def snap(raw: Column | float, price: Column | float):
    """A brick size on the lattice 2.5 * 10**(floor(log10 price) - 4), one step at least."""
    step = 2.5 * F.pow(F.lit(10.0), F.floor(F.log10(price)) - 4)
    return F.greatest(step, F.round(raw / step) * step)
