"""Merging of streams: total order, last known state, composites, crosses and as-of lookups.

As-of joins are unions with a ``last`` over one ordered window, linear and with one shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark import config as c
from tidemark.functions import scalar as S


def total_order(df: DataFrame) -> DataFrame:
    """Numbers each ticker's records of all providers by (time, provider, event)."""
    w = Window.partitionBy("ticker_id").orderBy("ts_ms", "provider_id", "event_id")
    return df.withColumn("seq", F.row_number().over(w).cast("bigint"))


def provider_state(df: DataFrame, ms: int, order=("ts_ms", "event_id")) -> DataFrame:
    """Each provider's last record before every boundary at which its ticker had an update.

    Boundaries count from the ticker's first record. A provider that hasn't spoken yet has no row.
    """
    anchor = df.groupBy("ticker_id").agg(F.min("ts_ms").alias("anchor"))
    j = df.join(anchor, "ticker_id")
    end = (F.col("anchor") + (F.floor((F.col("ts_ms") - F.col("anchor")) / ms) + 1) * ms).cast("bigint")
    last = j.groupBy("ticker_id", "provider_id", end.alias("boundary_ms")).agg(F.max_by(F.struct("ts_ms", "bid", "ask", "vbid", "vask"), F.struct(*order)).alias("r"))
    spoken = last.groupBy("ticker_id").agg(F.collect_set("provider_id").alias("providers"))  # a few ids a ticker
    grid = last.select("ticker_id", "boundary_ms").distinct().join(spoken, "ticker_id").select("ticker_id", "boundary_ms", F.explode("providers").alias("provider_id"))
    w = Window.partitionBy("ticker_id", "provider_id").orderBy("boundary_ms").rowsBetween(Window.unboundedPreceding, 0)
    state = grid.join(last, ["ticker_id", "provider_id", "boundary_ms"], "left").withColumn("r", F.last("r", ignorenulls=True).over(w))
    return state.where(F.col("r").isNotNull()).select("ticker_id", "boundary_ms", "provider_id", "r.*")


def tdwap(state: DataFrame, weights: dict[int, float] | None = None, stale_secs: int = c.STALE_SECS) -> DataFrame:
    """Composite of the providers' states: weights halve with every ``stale_secs`` of age."""
    base = F.create_map(*(F.lit(x) for kv in weights.items() for x in kv))[F.col("provider_id")] if weights else F.lit(1.0)
    w = F.coalesce(base, F.lit(1.0)) * F.pow(F.lit(2.0), -(F.col("boundary_ms") - F.col("ts_ms")) / (stale_secs * 1000.0))
    s = state.withColumn("w", w)
    side = [(F.sum(F.col("w") * F.col(x)) / F.sum("w")).alias(x) for x in ("bid", "ask")]
    out = s.groupBy("ticker_id", "boundary_ms").agg(*side, F.sum("vbid").alias("vbid"), F.sum("vask").alias("vask"), F.count("*").cast("int").alias("accepted"))
    return out.withColumn("flags", F.lit(c.BACKFILL) + F.when(F.col("bid") == F.col("ask"), c.NO_BOOK).otherwise(0))


def cross(base: DataFrame, quote: DataFrame, ttl_ms: int = c.TTL_MS) -> DataFrame:
    """Quotes of base/quote at every tick of either leg; ``fresh`` if the other leg is at most ``ttl_ms`` old.

    Ties go to the base leg first. Nothing is given out before both legs are live. Sides are conservative: bid over ask.
    """
    legs = [d.select("ts_ms", "event_id", F.lit(n).alias("leg"), *(F.when(F.lit(n == k), F.col(x)).alias(f"{p}_{x}") for k, p in enumerate("bq") for x in ("bid", "ask", "ts_ms"))) for n, d in enumerate((base, quote))]
    day = S.bucket(F.col("ts_ms"), c.DAY_MS)
    both = legs[0].unionByName(legs[1]).withColumn("day", day)
    # Within a day by window, and from the days before by each day's last values: no window holds the whole history.
    w = Window.partitionBy("day").orderBy("ts_ms", "leg", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    names = [f"{p}_{x}" for p in "bq" for x in ("bid", "ask", "ts_ms")]
    filled = both.select("day", "ts_ms", "event_id", "leg", *(F.last(n, ignorenulls=True).over(w).alias(n) for n in names))
    o = F.struct("ts_ms", "leg", "event_id")
    ends = both.groupBy("day").agg(*(F.max_by(F.col(n), F.when(F.col(n).isNotNull(), o)).alias(n) for n in names))
    wd = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, -1)  # a row a day
    before = ends.select(F.col("day").alias("d2"), *(F.last(n, ignorenulls=True).over(wd).alias(f"{n}_0") for n in names))
    j = filled.join(before, F.col("day") == F.col("d2"))
    j = j.select("ts_ms", "event_id", "leg", *(F.coalesce(n, f"{n}_0").alias(n) for n in names)).where("b_bid is not null and q_bid is not null")
    other = F.when(F.col("leg") == 0, F.col("q_ts_ms")).otherwise(F.col("b_ts_ms"))
    return j.select("ts_ms", "event_id", "leg", (F.col("b_bid") / F.col("q_ask")).alias("bid"), (F.col("b_ask") / F.col("q_bid")).alias("ask"), (F.col("ts_ms") - other <= ttl_ms).alias("fresh"))


def sigma_lookup(ticks: DataFrame, vol: DataFrame, fallback: float = c.SIGMA_FALLBACK) -> DataFrame:
    """Adds ``sigma``: of the last bin that closed before the tick's own; causal."""
    bins = vol.select("ticker_id", (F.col("bin_ts_ms") + c.VOL_BIN_MS).alias("at"), "sigma_pct")
    t = ticks.withColumn("at", S.bucket(F.col("ts_ms"), c.VOL_BIN_MS))
    wanted = t.select("ticker_id", "at").distinct()
    w = Window.partitionBy("ticker_id").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    grid = wanted.join(bins, ["ticker_id", "at"], "full").withColumn("sigma", F.last("sigma_pct", ignorenulls=True).over(w))
    return t.join(grid.select("ticker_id", "at", "sigma"), ["ticker_id", "at"], "left").withColumn("sigma", F.coalesce("sigma", F.lit(fallback))).drop("at")


def missing_days(df: DataFrame, keys=("ticker_id",)) -> DataFrame:
    """Dates between each key's first and last that have no rows."""
    days = df.select(*keys, "date").distinct()
    w = Window.partitionBy(*keys).orderBy("date")
    gap = days.withColumn("following", F.lead("date").over(w)).where(F.date_diff("following", "date") > 1)
    return gap.select(*keys, F.explode(F.sequence(F.date_add("date", 1), F.date_sub("following", 1))).alias("date"))


def common_days(a: DataFrame, b: DataFrame, keys=()) -> DataFrame:
    return a.select(*keys, "date").intersect(b.select(*keys, "date"))


def roster(registered: DataFrame, found: DataFrame, synthetic: DataFrame, existing: DataFrame) -> DataFrame:
    """Ids registered or found, not synthetic, that have data."""
    ids = registered.select("id").union(found.select("id")).distinct()
    return ids.join(synthetic.select("id"), "id", "left_anti").join(existing.select("id"), "id", "left_semi")


def glue(backfill: DataFrame, live: DataFrame) -> DataFrame:
    """Live rows, and backfill from before each ticker's first live row."""
    start = live.groupBy("ticker_id").agg(F.min("ts_ms").alias("start"))
    old = backfill.join(start, "ticker_id", "left").where(F.col("start").isNull() | (F.col("ts_ms") < F.col("start"))).drop("start")
    return old.withColumn("origin", F.lit("backfill")).unionByName(live.withColumn("origin", F.lit("live")))
