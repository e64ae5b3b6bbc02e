"""DuckDB SQL with the same results as the queries of the same names."""

from __future__ import annotations

CYCLE, BAR, ROLL, DAY = 60_000, 1_800_000, 14_400_000, 86_400_000

_TRADES = """
trades as (
  select event_id, list_position(['click', 'error', 'purchase', 'signup', 'view'], event_type)::bigint as ticker_id, (user_id % 4)::int as provider_id,
         epoch_us(ts) // 1000 as ts_ms, 100.0::double + value / 10 as price,
         case when value is null or isnan(value) or value < 0 then 0 else least(trunc(value), 4294967295) end::bigint as volume, event_id % 2 = 0 as is_buyer
  from events),
ticks as (
  select event_id, ticker_id, provider_id, ts_ms, p as bid, p as ask, (case when is_buyer then 0 else volume end)::bigint as vbid, (case when is_buyer then volume else 0 end)::bigint as vask
  from (select *, round(price * pow(10.0, 5 - floor(log10(abs(price))))) / pow(10.0, 5 - floor(log10(abs(price)))) as p from trades))"""

_RECORDS = (
    _TRADES
    + """,
records as (
  select event_id, ticker_id, provider_id, ts_ms, bid,
         case when event_id % 101 = 0 then bid - 0.05::double when event_id % 7 <> 0 then bid + 0.02::double else bid end as ask, vbid, vask,
         (event_id % 50) / 10.0::double as ci_ubp, (1 + event_id % 9)::int as tick_count, (1 + event_id % 4)::int as confidence, (1 + event_id % 5)::int as accepted, (event_id % 3)::int as rejected,
         ((case when event_id % 97 = 0 then 1 else 0 end) + (case when event_id % 7 = 0 then 2 else 0 end))::int as flags
  from ticks),
clean as (select *, (bid + ask) * 0.5::double as m from records where bid > 0 and ask > 0 and ask >= bid and flags & 1 = 0)"""
)


def _ohlc(source: str, ms: int) -> str:
    return f"""
  select ticker_id, ts_ms - ts_ms % {ms} as open_ts_ms, first(m order by ts_ms, event_id) as open, max(m) as high, min(m) as low, last(m order by ts_ms, event_id) as close,
         sum(vbid)::bigint as vbid, sum(vask)::bigint as vask, count(*) as tick_count, ts_ms - ts_ms % {ms} + {ms - 1} as close_ts_ms
  from {source} group by ticker_id, ts_ms - ts_ms % {ms}"""


def _fill(source: str, ms: int) -> str:
    return f"""
  select g.ticker_id, g.at as open_ts_ms, coalesce(b.open, f) as open, coalesce(b.high, f) as high, coalesce(b.low, f) as low, f as close,
         coalesce(b.vbid, 0) as vbid, coalesce(b.vask, 0) as vask, coalesce(b.tick_count, 0) as tick_count, g.at + {ms - 1} as close_ts_ms
  from (
    select g.ticker_id, g.at, last_value(b.close ignore nulls) over (partition by g.ticker_id order by g.at) as f
    from (select ticker_id, unnest(generate_series(min(open_ts_ms), max(open_ts_ms), {ms})) as at from {source} group by ticker_id) g
    left join {source} b on b.ticker_id = g.ticker_id and b.open_ts_ms = g.at) g
  left join {source} b on b.ticker_id = g.ticker_id and b.open_ts_ms = g.at"""


def _roll(source: str, ms: int) -> str:
    return f"""
  select ticker_id, b as open_ts_ms, first(open order by open_ts_ms) as open, max(high) as high, min(low) as low, last(close order by open_ts_ms) as close,
         sum(vbid)::bigint as vbid, sum(vask)::bigint as vask, sum(tick_count)::bigint as tick_count, b + {ms - 1} as close_ts_ms
  from (select *, open_ts_ms - open_ts_ms % {ms} as b from {source}) group by ticker_id, b"""


def _rs(source: str) -> str:
    return f"select ticker_id, open_ts_ms as bin_ts_ms, sqrt(greatest(0, ln(high / open) * ln(high / close) + ln(low / open) * ln(low / close))) as sigma_pct from {source}"


_BARS = _RECORDS + f",\nbars as ({_ohlc('clean', BAR)})"
_FILLED = _BARS + f",\nfilled as ({_fill('bars', BAR)})"
_VOL = _FILLED + f",\nvol as ({_rs('filled')})"
_NAMES = "ticker_id, open_ts_ms, round(open, 6) as open, round(high, 6) as high, round(low, 6) as low, round(close, 6) as close, vbid, vask, tick_count, close_ts_ms"
_RETURNS = "select ticker_id, open_ts_ms, r from (select *, ln(close / lag(close) over (partition by ticker_id order by open_ts_ms)) as r from {source}) where r is not null"
_DAYS = "days as (select l_suppkey as ticker_id, l_shipdate::date as date from lineitem)"
_MISSING = """
  select ticker_id, unnest(generate_series(date + 1, following - 1, interval 1 day))::date as date
  from (select ticker_id, date, lead(date) over (partition by ticker_id order by date) as following from (select distinct ticker_id, date from {source})) where following - date > 1"""


def _lookup(vol: str) -> str:
    """Each record of clean with the last bin of ``vol`` that closed before its own."""
    return f"""
  select c.*, coalesce(v.sigma_pct, 0.01::double) as sigma
  from (select *, ts_ms - ts_ms % {BAR} as at from clean) c
  asof left join (select ticker_id, bin_ts_ms + {BAR} as at, sigma_pct from {vol}) v on c.ticker_id = v.ticker_id and c.at >= v.at"""


_PATH = _VOL + f",\npath as ({_lookup('vol')})"


def _state(ms: int) -> str:
    return f"""
ended as (
  select *, anchor + ((ts_ms - anchor) // {ms} + 1) * {ms} as boundary_ms
  from (select *, min(ts_ms) over (partition by ticker_id) as anchor from clean)),
grid as (select distinct e.ticker_id, e.boundary_ms, p.provider_id from ended e join (select distinct ticker_id, provider_id from clean) p using (ticker_id)),
state as (
  select g.ticker_id, g.boundary_ms, g.provider_id, c.ts_ms, c.bid, c.ask, c.vbid, c.vask
  from grid g asof join clean c on g.ticker_id = c.ticker_id and g.provider_id = c.provider_id and g.boundary_ms > c.ts_ms)"""


def _cross(ttl: int) -> str:
    def leg(n: int, names: str) -> str:
        return f"select ts_ms, event_id, {n} as leg, {names} from clean where ticker_id = {n + 1}"

    return f"""
legs as (
  {leg(0, "bid as b_bid, ask as b_ask, ts_ms as b_ts, null::double as q_bid, null::double as q_ask, null::bigint as q_ts")}
  union all {leg(1, "null, null, null, bid, ask, ts_ms")}),
live as (
  select ts_ms, event_id, leg, {", ".join(f"last_value({x} ignore nulls) over w as {x}" for x in ("b_bid", "b_ask", "b_ts", "q_bid", "q_ask", "q_ts"))}
  from legs window w as (order by ts_ms, leg, event_id rows between unbounded preceding and current row)),
crossed as (
  select ts_ms, event_id, leg, b_bid / q_ask as bid, b_ask / q_bid as ask, ts_ms - (case when leg = 0 then q_ts else b_ts end) <= {ttl} as fresh
  from live where b_bid is not null and q_bid is not null)"""


_GAPS = "select ticker_id, p as from_ms, ts_ms as to_ms, ts_ms - p as gap_ms from (select *, lag(ts_ms) over (partition by ticker_id order by ts_ms, event_id) as p from clean) where ts_ms - p > {least}"
_SEVERITY = "case when gap_ms >= 3600000 then 'CRITICAL' when gap_ms >= 300000 then 'MAJOR' when gap_ms >= 60000 then 'MINOR' end as severity"
_CONF = "(case when flags & 64 <> 0 then (confidence & 127) / accepted::double when flags & 8 <> 0 then confidence / 255.0::double else confidence / accepted::double end)"

_NOW = 1_706_000_000_000
_FAULTY = """
faulty as (
  select event_id, ticker_id, provider_id, case when event_id % 211 = 0 then ts_ms - 7200000 else ts_ms end as ts_ms, case when event_id % 137 = 0 then 0 else bid end as bid, ask, vbid, vask, ci_ubp, tick_count,
         (case when event_id % 26 = 0 then 130 when event_id % 34 = 0 then 200 else confidence end)::int as confidence, case when event_id % 131 = 0 then 70 else accepted end as accepted, rejected,
         flags | (case when event_id % 13 = 0 then 64 when event_id % 17 = 0 then 8 else 0 end)::int as flags,
         (ask - bid) / ((bid + ask) * 0.5::double) * 10000 + case when event_id % 103 = 0 then 2.0::double else 0 end as spread_bps
  from records)"""


def _findings(source: str, now: int) -> str:
    return f"""
valued as (
  select *, (bid + ask) * 0.5::double as m, flags & 1 = 0 and bid >= 1e-9 and ask >= 1e-9 and ask >= bid as quote, (vbid = 0)::int + (vask = 0)::int as zero from {source}),
seen as (
  select *, lag(ts_ms) over w as pts, last_value(case when quote then m end ignore nulls) over (w rows between unbounded preceding and 1 preceding) as pm,
         (ask - bid) / m * 10000 as s
  from valued window w as (partition by ticker_id, ts_ms // {DAY} order by event_id)),
findings as (
  select ticker_id, event_id, unnest(list_filter([
    case when ts_ms < 946684800000 or ts_ms > {now} + 300000 then 'G6 E' end, case when ts_ms < pts then 'MO E' end, case when ts_ms - pts > 60000 then 'GAP W' end,
    case when bid < 1e-9 or ask < 1e-9 then 'G1 E' end, case when ask < bid then 'XQ E' end, case when accepted > 64 then 'G8 E' end,
    case when zero = 2 and flags & 3 = 0 then 'G10E E' end, case when zero = 1 and flags & 3 = 0 then 'G10W W' end, case when flags & 1 = 0 and rejected > accepted then 'G11 W' end,
    case when s < 0 or abs(s - spread_bps) > 0.5::double then 'G7 E' end, case when ci_ubp > 0.01::double * m then 'G3 W' end,
    case when quote and coalesce(ts_ms - pts, 0) <= 60000 and abs(m - pm) > 0.1::double * pm then 'G5 W' end,
    case when flags & 64 <> 0 then (case when confidence & 127 < 2 or confidence & 128 = 0 then 'G4 W' end) when flags & 8 <> 0 and confidence / 255.0::double < 0.05 then 'G4 W' end],
    lambda x: x is not null)) as x
  from seen),
found as (select ticker_id, event_id, split_part(x, ' ', 1) as code, split_part(x, ' ', 2) as severity from findings)"""


_FINDINGS = _FAULTY + "," + _findings("faulty", _NOW)
_KEPT = """,
kept as (
  select * from faulty
  where ticker_id <> 4 or (event_id % 13 > 0 and event_id % 17 > 0 and event_id % 101 > 0 and event_id % 103 > 0 and event_id % 131 > 0 and event_id % 137 > 0 and event_id % 211 > 0)),
deep as (select * from kept where vbid + vask > 0)"""


def _stuck(source: str, run: int, sample: int, distinct: float, strict: bool) -> str:
    """Findings of whole shards: (ticker_id, day, code)."""
    more = ", case when ci >= 0.001 then 'STC' end, case when wide >= 0.005 then 'STS' end" if strict else ""
    return f"""
shard_rows as (
  select *, (bid + ask) * 0.5::double as m, ts_ms // {DAY} as day from {source} where flags & 1 = 0 and bid >= 1e-9 and ask >= 1e-9 and ask >= bid),
shard_runs as (
  select *, sum(new) over (partition by ticker_id, day order by event_id) as run
  from (select *, case when m = lag(m) over (partition by ticker_id, day order by event_id) then 0 else 1 end as new from shard_rows)),
shard_facts as (
  select ticker_id, day, sum(n) as n, max(n) as longest from (select ticker_id, day, run, count(*) as n from shard_runs group by all) group by all),
shard_more as (
  select ticker_id, day, count(distinct m) / count(*)::double as distinct_part, avg(ci_ubp / m) as ci, avg(((ask - bid) / m * 10000 > 500)::int) as wide from shard_rows group by all),
stuck as (
  select ticker_id, day, unnest(list_filter([case when longest >= {run} then 'G9' end, case when n >= {sample} and distinct_part < {distinct} then 'G9D' end{more}], lambda x: x is not null)) as code
  from shard_facts join shard_more using (ticker_id, day))"""


def _series(source: str, ms: int, floor: float = 0.0) -> str:
    """Findings of bars (with kind and microstructure) against the ticker's bar before."""
    odd = " or ".join(f"isnan({x}) or isinf({x})" for x in ("open", "high", "low", "close"))
    return f"""
before as (
  select *, lag(close_ts_ms) over w as p_end, lag(close) over w as p_close, lag(kind) over w as p_kind, ({odd}) as broken
  from {source} window w as (partition by ticker_id order by open_ts_ms // {DAY}, open_ts_ms, close_ts_ms)),
series as (
  select ticker_id, open_ts_ms, unnest(list_filter([
    case when kind not between 0 and 3 then 'KIND E' end, case when open_ts_ms > close_ts_ms then 'TIME E' end, case when broken then 'OHLC E' end,
    case when not broken and high < greatest(open, close, low) then 'HIGH E' end, case when not broken and low > least(open, close, high) then 'LOW E' end,
    case when realized_var < 0 then 'VAR E' end, case when kind = 0 and open_ts_ms % {ms} <> 0 then 'GRID E' end,
    case when kind = 0 and p_kind = 0 and (close_ts_ms - p_end) % {ms} <> 0 then 'SPACE E' end,
    case when kind = 0 and p_kind = 0 and close_ts_ms - p_end > {ms} and (close_ts_ms - p_end) % {ms} = 0 then 'SGAP W' end,
    case when abs(vol_imbalance) > 1.001 then 'IMB E' end, case when avg_spread_bps < 0 then 'SPRD E' end, case when max_abs_return < 0 then 'RET E' end, case when abs(drift) > 1 then 'DRIFT W' end,
    case when kind = 0 and p_kind = 0 and open_ts_ms <> p_end + 1 then 'KGAP W' end,
    case when kind = 1 and p_kind = 1 and abs(p_close - open) > abs(p_close) * 1e-12::double + 1e-12::double then 'BRICK E' end,
    case when kind = 1 and not broken and open > 0 and abs(close - open) < open * {floor}::double then 'FLOOR E' end], lambda x: x is not null)) as x
  from before),
series_found as (select ticker_id, open_ts_ms, split_part(x, ' ', 1) as code, split_part(x, ' ', 2) as severity from series)"""


_PLAIN = "0.5::double as realized_var, 0.5::double as vol_imbalance, 1.0::double as avg_spread_bps, 0.1::double as max_abs_return, 0.0::double as drift"


def _kinds(source: str, least: int, most: int, quiet: int) -> str:
    return f"""
session_gaps as (
  select ticker_id, p as from_ms, ts_ms as to_ms, ts_ms - p as gap_ms from (select *, lag(ts_ms) over (partition by ticker_id order by ts_ms, event_id) as p from {source}) where ts_ms - p > {least}),
sessions as (select ticker_id, ts_ms // {DAY} as day, min(ts_ms) as s, max(ts_ms) as e from {source} group by all),
marks as (select distinct ticker_id, ts_ms from {source} where flags & 1 <> 0),
active as (
  select g.ticker_id, from_ms, to_ms, gap_ms, sum(greatest(0, least(to_ms, e) - greatest(from_ms, s)))::bigint as active_ms
  from session_gaps g join sessions s on g.ticker_id = s.ticker_id and day between from_ms // {DAY} and to_ms // {DAY} group by all),
kinds as (
  select *, case when active_ms <= {most} then 'closed'
                 when gap_ms <= {quiet} and (ticker_id not in (select ticker_id from marks) or (ticker_id, from_ms) in (select (ticker_id, ts_ms) from marks) or (ticker_id, to_ms) in (select (ticker_id, ts_ms) from marks)) then 'quiet'
                 else 'OUTAGE' end as kind
  from active)"""


_VERDICT = """
verdicts as (
  select t.ticker_id, rows, coalesce(errors, 0)::bigint as errors, coalesce(warnings, 0)::bigint as warnings, coalesce(reasons, '') as reasons,
         case when rows = 0 then 'NO_DATA' when coalesce(errors, 0) > 0 then 'FAIL' else 'PASS' end as verdict
  from (select r.ticker_id, count(k.ticker_id) as rows from (select unnest(range(1, 7)) as ticker_id) r left join kept k using (ticker_id) group by all) t
  left join (
    select ticker_id, count(*) filter (where severity = 'E') as errors, count(*) filter (where severity = 'W') as warnings, string_agg(distinct code, ',' order by code) filter (where severity = 'E') as reasons
    from found group by ticker_id) f using (ticker_id))"""

_NAMES8 = "['BTC', 'ETH', 'USDT', 'DOGE', 'EUR', 'GBP', 'USDC', 'USD']"
_PAIRS = f"""
pairs as (select c_custkey, {_NAMES8}[c_nationkey % 8 + 1] as base, {_NAMES8}[length(c_mktsegment) % 8 + 1] as quote from customer),
classed as (
  select *, case when base in ('USD', 'EUR', 'GBP') and quote in ('USD', 'EUR', 'GBP') then (case when base = 'USD' or quote = 'USD' then 'fx_major' else 'fx_cross' end)
                 when base in ('USDT', 'USDC') then 'crypto_stable' when quote not in ('USDT', 'USDC', 'USD', 'EUR', 'GBP') then 'crypto_cross'
                 when base in ('BTC', 'ETH') then 'crypto_major' else 'crypto_alt' end as class
  from pairs)"""

#: The fold as a recursion over each ticker's ticks in order.
_BRICKS = (
    _PATH
    + """,
sized as (
  select ticker_id, ts_ms, row_number() over (partition by ticker_id order by ts_ms, event_id) as rn, m,
         greatest(step, round(m * greatest(sigma * 5.0::double, 0.02::double) / step) * step) as brick
  from (select *, 2.5::double * pow(10.0, floor(log10(m)) - 4) as step from path)),
fold as (
  select ticker_id, rn, ts_ms, m as last, 0 as trips, m as first, 0::bigint as n, brick from sized where rn = 1
  union all
  select ticker_id, rn, ts_ms, case when jump and trips + 1 >= 10 then m when jump then last else last + n * brick end,
         case when jump and trips + 1 < 10 then trips + 1 else 0 end, last, case when jump then 0 else n end, brick
  from (
    select s.ticker_id, s.rn, s.ts_ms, s.m, s.brick, f.last, f.trips, abs(s.m - f.last) / f.last > 0.10::double as jump,
           (sign(s.m - f.last) * least(1000, floor(abs(s.m - f.last) / s.brick + 1e-9::double)))::bigint as n
    from fold f join sized s on s.ticker_id = f.ticker_id and s.rn = f.rn + 1)),
made as (select ticker_id, rn, ts_ms, first, sign(n) as way, brick, unnest(generate_series(0, abs(n) - 1)) as i from fold where n <> 0),
bricks as (
  select ticker_id, row_number() over (partition by ticker_id order by rn, i) as seq, ts_ms, first + way * i * brick as open, first + way * (i + 1) * brick as close from made),
per_day as (select ticker_id, make_timestamp(ts_ms * 1000)::date as date, count(*) as n from bricks group by all)"""
)


def _with(ctes: str, body: str, recursive: bool = False) -> str:
    return f"with {'recursive ' if recursive else ''}{ctes.strip()}\n{body.strip()}"


ORACLE: dict[str, str] = {
    "honest_ticks": _with(_TRADES, "select event_id, ticker_id, provider_id, ts_ms, round(bid, 6) as bid, round(ask, 6) as ask, vbid, vask from ticks"),
    "normalised_timestamps": _with(_TRADES, "select event_id, ts_ms, greatest(0, (ts_ms - 1262304000000) * 1000 // 16) as mts, ts_ms - ts_ms % 10000 as s10_open, ts_ms - ts_ms % 10000 + 9999 as s10_close, strftime(make_timestamp(ts_ms * 1000), '%Y-%m-%d') as day from trades"),
    "record_scalars": _with(_RECORDS, f"select event_id, round((bid + ask) * 0.5::double, 6) as mid, round((ask - bid) / ((bid + ask) * 0.5::double) * 10000, 6) as spread_bps, round({_CONF}, 6) as confidence_ratio, least(trunc(bid * 1e8::double), 4294967295)::bigint as saturated from records"),
    "valid_quote_filter": _with(_RECORDS, "select event_id, round(bid, 6) as bid, round(ask, 6) as ask from records where bid > 0 and ask > 0 and ask >= bid"),
    "sentinel_skip": _with(_RECORDS, "select event_id, flags from records where flags & 1 = 0"),
    "zscore_gate": _with(_RECORDS, "select event_id, coalesce(sd > 0 and abs(m - mean) > 1.7::double * sd, false) as rejected_z from (select *, avg(m) over w as mean, stddev_samp(m) over w as sd from clean window w as (partition by ticker_id, provider_id order by ts_ms, event_id rows between 500 preceding and 1 preceding))"),
    "late_drop": _with(_RECORDS, f"select ticker_id, count(*) as n, count(*) filter (where b < hi) as late from (select *, max(b) over (partition by ticker_id order by arrival, event_id rows between unbounded preceding and 1 preceding) as hi from (select *, ts_ms - ts_ms % {DAY} as b, event_id * 7919 % 100003 as arrival from clean)) group by ticker_id"),
    "window_filters": _with(_RECORDS, f"""select event_id, ticker_id, ts_ms from (select *, max(ts_ms) over (partition by ticker_id) as hi from (select *, min(ts_ms) over (partition by ticker_id) as lo from clean) where ts_ms >= lo + 5 * {DAY}::bigint)
where ts_ms >= hi - 20 * {DAY}::bigint and ts_ms >= 1704067200000 and ts_ms > coalesce((select min(ts_ms) from clean c where provider_id = 0 and c.ticker_id = ticker_id), 0) and year(make_timestamp(ts_ms * 1000)) <= 2024"""),
    "provider_denylist": _with(_RECORDS, "select ticker_id, provider_id, count(*) as n from clean where provider_id <> 2 group by all"),
    "delta_gate": _with(_RECORDS, f"""select event_id, ticker_id, b as bid from (select *, (b, a, vb, va) as x, lag((b, a, vb, va)) over w as y, lag(ts_ms // {DAY}) over w as d from (select *, round(bid / 10) as b, round(ask / 10) as a, vbid // 200 as vb, vask // 200 as va from clean) window w as (partition by ticker_id order by ts_ms, event_id))
where d is null or d <> ts_ms // {DAY} or x <> y"""),
    "cycle_agg": _with(_RECORDS, """select ticker_id, provider_id, anchor + ((ts_ms - anchor) // 3600000 + 1) * 3600000 as boundary_ms, round(coalesce(sum(bid * vbid) / nullif(sum(vbid), 0), avg(bid)), 9) as bid, round(coalesce(sum(ask * vask) / nullif(sum(vask), 0), avg(ask)), 9) as ask,
least(sum(vbid), 4294967295)::bigint as vbid, least(sum(vask), 4294967295)::bigint as vask, least(count(*), 65535) as tick_count
from (select *, min(ts_ms) over (partition by ticker_id, provider_id) as anchor from clean) group by 1, 2, 3"""),
    "provider_merge": _with(_RECORDS, "select event_id, ticker_id, row_number() over (partition by ticker_id order by ts_ms, provider_id, event_id) as seq from clean"),
    "provider_merge_locf": _with(_RECORDS + "," + _state(3_600_000), "select ticker_id, boundary_ms, provider_id, ts_ms, round(bid, 6) as bid, round(ask, 6) as ask, vbid, vask from state"),
    "tdwap_composite": _with(_RECORDS + "," + _state(3_600_000), """select ticker_id, boundary_ms, round(b, 6) as bid, round(a, 6) as ask, vbid, vask, accepted, (32 + case when b = a then 2 else 0 end)::int as flags from (
select ticker_id, boundary_ms, sum(w * bid) / sum(w) as b, sum(w * ask) / sum(w) as a, sum(vbid)::bigint as vbid, sum(vask)::bigint as vask, count(*)::int as accepted
from (select *, [0.3::double, 0.15::double, 0.1::double, 0.1::double][provider_id + 1] * pow(2.0::double, -(boundary_ms - ts_ms) / 3600000.0::double) as w from state) group by ticker_id, boundary_ms)"""),
    "ohlc_bars": _with(_BARS, f"select {_NAMES} from bars"),
    "bar_microstructure": _with(_RECORDS, f"""select ticker_id, b as open_ts_ms, round(coalesce(sum(r * r), 0), 9) + 0.0::double as realized_var, round(coalesce(sum(abs(r) * abs(r1)) * (pi() / 2), 0), 9) + 0.0::double as bipower_var, round(case when count(*) > 1 then regr_slope(lm, (ts_ms - b) / 1000.0::double) end, 9) + 0.0::double as drift,
round(case when sum(vbid) + sum(vask) > 0 then (sum(vask) - sum(vbid)) / (sum(vbid) + sum(vask))::double else 0 end, 9) + 0.0::double as vol_imbalance, round(avg(case when flags & 2 = 0 then (ask - bid) / m * 10000 end), 9) + 0.0::double as avg_spread_bps,
round(coalesce(max(abs(r)), 0), 9) + 0.0::double as max_abs_return, round(sum(rejected) / nullif(sum(accepted) + sum(rejected), 0)::double, 9) + 0.0::double as reject_rate
from (select *, lag(r) over (partition by ticker_id, b order by ts_ms, event_id) as r1 from (select *, lm - lag(lm) over (partition by ticker_id, b order by ts_ms, event_id) as r from (select *, ln(m) as lm, ts_ms - ts_ms % {ROLL} as b from clean))) group by ticker_id, b"""),
    "gapfill_bars": _with(_FILLED, f"select {_NAMES} from filled"),
    "ohlc_rollup": _with(_FILLED + f",\nrolled as ({_roll('filled', ROLL)})", f"select {_NAMES} from rolled"),
    "heal_bin_merge": _with(_RECORDS, f"""select ticker_id, ts_ms - ts_ms % {BAR} as ts_ms, round(coalesce(sum(bid * vbid) / nullif(sum(vbid), 0), avg(bid)), 9) as bid, round(coalesce(sum(ask * vask) / nullif(sum(vask), 0), avg(ask)), 9) as ask,
least(sum(vbid), 4294967295)::bigint as vbid, least(sum(vask), 4294967295)::bigint as vask,
round(coalesce(sqrt(sum(ci_ubp * ci_ubp * (vbid + vask)) / nullif(sum(vbid + vask), 0)), sqrt(sum(ci_ubp * ci_ubp * tick_count) / nullif(sum(tick_count), 0)), max(ci_ubp)), 9) as ci_ubp,
least(sum(tick_count), 65535)::bigint as tick_count, max(confidence) as confidence, max(accepted) as accepted, max(rejected) as rejected, (case when count(*) = 1 then bit_or(flags) else bit_or(flags) | 16 end)::int as flags
from records group by ticker_id, ts_ms - ts_ms % {BAR}"""),
    "resample_last": _with(_RECORDS, f"""select ticker_id, ts_ms - ts_ms % {BAR} as ts_ms, event_id, provider_id, round(bid, 6) as bid, round(ask, 6) as ask, vbid, vask, round(ci_ubp, 6) as ci_ubp, tick_count, confidence, accepted, rejected, flags | 16 as flags
from records qualify row_number() over (partition by ticker_id, ts_ms // {BAR} order by ts_ms desc, event_id desc) = 1"""),
    "resample_invariants": _with(_RECORDS, f"""select name as invariant, n::bigint as violations from (
with last as (select ticker_id, ts_ms - ts_ms % {BAR} as bin, arg_max(event_id, (ts_ms, event_id)) as e, arg_max(flags, (ts_ms, event_id)) | 16 as flags from records group by all),
once as (select ticker_id, case when e % 37 = 0 then bin + 7 else bin end as ts_ms, e, case when e % 41 = 0 then flags - 16 else flags end as flags from last where e % 31 <> 0),
made as (select * from once union all select * from once where e % 43 = 0),
bins as (select distinct ticker_id, ts_ms - ts_ms % {BAR} as ts_ms from records)
select 'grid' as name, count(*) as n from made where ts_ms % {BAR} <> 0
union all select 'unique', count(*) from (select 1 from made group by ticker_id, ts_ms having count(*) > 1)
union all select 'healed', count(*) from made where flags & 16 = 0
union all select 'lost', count(*) from bins where (ticker_id, ts_ms) not in (select (ticker_id, ts_ms) from made)
union all select 'invented', count(*) from made where (ticker_id, ts_ms) not in (select (ticker_id, ts_ms) from bins))"""),
    "rs_sigma": _with(_VOL, "select ticker_id, bin_ts_ms, round(sigma_pct, 9) as sigma_pct from vol"),
    "ema_sigma": _with(_VOL + """,
numbered as (select *, row_number() over w as n, avg(sigma_pct) over w as early from vol window w as (partition by ticker_id order by bin_ts_ms)),
ema as (
  select ticker_id, n, bin_ts_ms, sigma_pct, early as e from numbered where n = 28
  union all
  select x.ticker_id, x.n, x.bin_ts_ms, x.sigma_pct, y.e * (1 - 2.0::double / 29) + x.sigma_pct * (2.0::double / 29) from ema y join numbered x on x.ticker_id = y.ticker_id and x.n = y.n + 1)""",
        "select ticker_id, bin_ts_ms, round(sigma_pct, 9) as sigma_pct, round(early, 9) as ema from numbered where n < 28 union all select ticker_id, bin_ts_ms, round(sigma_pct, 9), round(e, 9) from ema", True),
    "sigma_blend": _with(_VOL + f""",
wins as (select ticker_id, bin_ts_ms, sigma_pct, {", ".join(f"list_sort(list(sigma_pct) over (partition by ticker_id order by bin_ts_ms range between {d * DAY} preceding and 1 preceding)) as v{d}" for d in (3, 7, 14))},
  max(sigma_pct) over (partition by ticker_id order by bin_ts_ms rows between 3 preceding and 1 preceding) as spike from vol),
means as (select *, ({" + ".join(f"(case when len(v{d}) >= 5 then list_avg(list_transform(v{d}, lambda x: least(greatest(x, v{d}[(round((len(v{d}) - 1) * 0.05::double) + 1)::int]), v{d}[(round((len(v{d}) - 1) * 0.95::double) + 1)::int]))) else list_avg(v{d}) end)" for d in (3, 7, 14))}) / 3 as mean from wins)""",
        "select ticker_id, bin_ts_ms, round(sigma_pct, 9) as sigma_pct, round(greatest(mean, least(spike, mean * 8)), 9) as blended from means"),
    "sigma_lookup": _with(_BARS + f",\nsparse as ({_rs('bars')})", f"select event_id, round(sigma, 9) as sigma from ({_lookup('sparse')})"),
    "synth_cross_ttl": _with(_RECORDS + "," + _cross(600_000), "select ts_ms, event_id, leg, round(bid, 9) as bid, round(ask, 9) as ask, fresh from crossed"),
    "parkinson_vol": _with(_BARS, f"select ticker_id, round(sqrt(avg(ln(h / l) * ln(h / l)) / (4 * ln(2))) * sqrt(365), 6) as sigma, count(*) as days from (select ticker_id, open_ts_ms // {DAY} as d, max(high) as h, min(low) as l from bars group by all) group by ticker_id"),
    "mad_outliers": _with(_BARS + f",\nreturns as ({_RETURNS.format(source='bars')}),\ndev as (select ticker_id, r, med, abs(r - med) as dev from returns join (select ticker_id, median(r) as med from returns group by ticker_id) using (ticker_id))",
        "select ticker_id, round(first(med), 6) as med, round(first(mad), 6) as mad, count(*) filter (where dev / (mad * 1.4826::double) > 2) as outliers, round(max(dev / (mad * 1.4826::double)), 6) as worst from dev join (select ticker_id, median(dev) as mad from dev group by ticker_id) using (ticker_id) where mad > 0 group by ticker_id"),
    "cusum": _with(_BARS + f",\nrolled as ({_roll('bars', ROLL)}),\nreturns as ({_RETURNS.format(source='rolled')})" + """,
z as (select ticker_id, open_ts_ms, (r - avg(r) over p) / stddev_samp(r) over p as z, row_number() over (partition by ticker_id order by open_ts_ms) as n from returns window p as (partition by ticker_id)),
run as (
  select ticker_id, n, open_ts_ms, greatest(0, z - 0.25::double) as u, greatest(0, -z - 0.25::double) as d, greatest(0, z - 0.25::double) > 2 or greatest(0, -z - 0.25::double) > 2 as hit from z where n = 1
  union all
  select z.ticker_id, z.n, z.open_ts_ms, greatest(0, (case when hit then 0 else u end) + z.z - 0.25::double), greatest(0, (case when hit then 0 else d end) - z.z - 0.25::double),
         greatest(0, (case when hit then 0 else u end) + z.z - 0.25::double) > 2 or greatest(0, (case when hit then 0 else d end) - z.z - 0.25::double) > 2
  from run join z on z.ticker_id = run.ticker_id and z.n = run.n + 1)""",
        "select ticker_id, open_ts_ms, (case when u > 2 then 1 else -1 end)::int as side from run where hit", True),
    "flat_runs": _with(_RECORDS, """select ticker_id, run, count(*) as n, min(ts_ms) as start_ms from (select *, sum(new) over (partition by ticker_id order by ts_ms, event_id)::bigint as run from (select *, (case when v = lag(v) over (partition by ticker_id order by ts_ms, event_id) then 0 else 1 end) as new from (select *, floor(m / 25) as v from clean))) group by ticker_id, run having count(*) >= 2"""),
    "zero_tick_runs": _with(_FILLED, """select ticker_id, run, count(*) as n, min(open_ts_ms) as start_ms from (select *, sum(new) over (partition by ticker_id order by open_ts_ms)::bigint as run from (select *, (case when v = lag(v) over (partition by ticker_id order by open_ts_ms) then 0 else 1 end) as new from (select *, tick_count = 0 as v from filled))) where v group by ticker_id, run having count(*) >= 5"""),
    "gap_classify": _with(_RECORDS + ",\nalive as (select * from records where bid > 0 and ask > 0 and ask >= bid and (ticker_id > 2 or flags % 2 = 0))," + _kinds("alive", 5_400_000, 6_000_000, 9_000_000), "select * from kinds"),
    "worst_gaps_topk": _with(_RECORDS + f",\ngaps as ({_GAPS.format(least=0)})", f"select ticker_id, from_ms, to_ms, gap_ms, {_SEVERITY}, rank::int as rank from (select *, row_number() over (partition by ticker_id order by gap_ms desc, to_ms) as rank from gaps) where rank <= 10"),
    "missing_days": _with(_DAYS, f"select ticker_id, strftime(date, '%Y-%m-%d') as date from ({_MISSING.format(source='days')})"),
    "leg_days": _with(_DAYS, "select ticker_id, strftime(date, '%Y-%m-%d') as date from (select ticker_id, date from days intersect select ticker_id - 1, date from days)"),
    "grid_alignment": _with(_FILLED + f""",
odd as (select * replace (case when tick_count > 0 and vbid % 11 = 3 then open_ts_ms + 7 else open_ts_ms end as open_ts_ms) from filled),
stepped as (select *, open_ts_ms - lag(open_ts_ms) over (partition by ticker_id order by open_ts_ms) as step from odd)""",
        f"""select ticker_id, open_ts_ms, unnest(list_filter([case when open_ts_ms % {BAR} <> 0 then 'GRID' end, case when close_ts_ms <> open_ts_ms + {BAR - 1} then 'CLOSE' end, case when step % {BAR} <> 0 then 'STEP' end, case when step > {BAR} then 'GAP' end,
case when high < greatest(open, close, low) then 'HIGH' end, case when low > least(open, close, high) then 'LOW' end, case when abs(ln(close / open)) > 0.1 then 'JUMP' end], lambda x: x is not null)) as code from stepped"""),
    "seam_s10": _with(_BARS, f"""select ticker_id, strftime(d, '%Y-%m-%d') as date, first - before - 1 as residual_ms, abs(first - before - 1) > 1 as broken from (
select *, lag(last) over (partition by ticker_id order by d) as before from (select ticker_id, make_timestamp(open_ts_ms * 1000)::date as d, min(open_ts_ms) as first, max(close_ts_ms) as last from bars group by all)) where before is not null"""),
    "coverage_k3": _with(_BARS, f"""select ticker_id, day, round(share, 6) as share, case when share < 0.5 then 'FAIL' when share < 0.8 then 'WARN' else 'OK' end as level from (
select *, n / slots as share, min(day) over (partition by ticker_id) as a, max(day) over (partition by ticker_id) as b from (select ticker_id, open_ts_ms // {DAY} as day, count(*) as n, (max(open_ts_ms) - min(open_ts_ms)) / {BAR}::double + 1 as slots from bars group by all)) where day > a and day < b"""),
    "rollup_parity": _with(_FILLED, f"select b % 7 <> 3 and b % 5 <> 0 as equal, count(*) as n from (select distinct ticker_id, open_ts_ms // {ROLL} as b from filled) group by 1"),
    "integrity_findings": _with(_RECORDS + "," + _FINDINGS, "select * from found"),
    "stuck_shards": _with(_RECORDS + """,
coarse as (select * replace (round(bid / 4) * 4 as bid, round(bid / 4) * 4 + case when event_id % 397 = 0 then 12.0::double else 0.02::double end as ask) from records),""" + _stuck("coarse", 3, 8, 0.3, True),
        f"select ticker_id, strftime(make_timestamp(day * {DAY} * 1000), '%Y-%m-%d') as date, code, 'E' as severity from stuck"),
    "bar_series": _with(_BARS + """,
bent as (
  select ticker_id, case v when 5 then open_ts_ms + 7 when 6 then close_ts_ms + 1 else open_ts_ms end as open_ts_ms, open, case v when 2 then low - 1 when 3 then 'nan'::double else high end as high, case v when 4 then high + 1 else low end as low, close,
         case v when 7 then close_ts_ms + 3 else close_ts_ms end as close_ts_ms, case v when 1 then 9 else 0 end as kind, case v when 8 then -1.0::double else 0.5 end as realized_var, case v when 9 then 1.5::double else 0.5 end as vol_imbalance,
         case v when 10 then -2.0::double else 1 end as avg_spread_bps, case v when 11 then -0.1::double else 0.1 end as max_abs_return, case v when 12 then 3.0::double else 0 end as drift
  from (select *, vbid % 23 as v from bars)),""" + _series("bent", BAR), "select * from series_found"),
    "brick_series": _with(_BARS + f""",
rolled as ({_roll("bars", ROLL)}),
blocks as (select * replace (case when vbid % 3 > 0 then open else close end as open), 1 as kind, {_PLAIN} from rolled),""" + _series("blocks", ROLL, 0.02), "select * from series_found"),
    "shard_directory": f"""select ticker_id, strftime(date, '%Y-%m-%d') as date, name, split_part(x, ' ', 1) as code, split_part(x, ' ', 2) as severity from (
select *, unnest(list_filter([case when bytes = 0 then 'EMPTY W' end, case when bytes % 56 <> 0 then 'TORN E' end, case when ticker_id = 5 then 'DIR E' end, case when o_orderkey % 5 = 0 then 'OUT E' end,
  case when count(*) over (partition by ticker_id, date) > 1 then 'TWIN E' end], lambda x: x is not null)) as x
from (select o_orderkey, o_custkey % 40 as ticker_id, o_orderdate::date as date, 'f' || o_orderkey as name, case when o_orderkey % 11 = 0 then 0 when o_orderkey % 7 = 0 then 100 else 112 end as bytes from orders))""",
    "capped_findings": _with(_RECORDS + "," + _FINDINGS, "select * from (select *, count(*) over (partition by ticker_id, code) as total, row_number() over (partition by ticker_id, code order by event_id)::int as nth from found) where nth <= 3"),
    "last_bars": _with(_BARS, f"select {_NAMES} from (select *, row_number() over (partition by ticker_id order by open_ts_ms desc) as nth from bars) where nth <= 20"),
    "vol_index": _with(_BARS, f"""select ticker_id, bin_ts_ms, case when r is null then 'vol' else 'idx' end as kind
from (select ticker_id, open_ts_ms as bin_ts_ms, 1 as v from bars where open_ts_ms // {BAR} % 9 <> 4) full join (select distinct ticker_id, ts_ms - ts_ms % {BAR} as bin_ts_ms, 1 as r from clean where ts_ms % {DAY} > 7200000) using (ticker_id, bin_ts_ms)
where v is null or r is null"""),
    "audit_families": _with(_FILLED + "," + _FAULTY + f""",
audited as (
  select * replace (case when flat then 150.0::double else bid end as bid, case when flat then 150.25::double else ask end as ask)
  from (select *, ticker_id = 3 and ts_ms // {DAY} % 7 = 0 and bid > 0 as flat from faulty) where (ticker_id <> 2 or ts_ms % (5 * {DAY}) > {DAY}) and (ticker_id <> 4 or ts_ms % {DAY} < 40000000)),
b1 as (
  select * replace (case when ticker_id = 1 and vbid % 23 = 2 then low - 1 else high end as high, case when ticker_id = 5 and vbid % 29 = 5 then open_ts_ms + 7 else open_ts_ms end as open_ts_ms), 0 as kind, {_PLAIN}
  from filled where ticker_id <> 3 or open_ts_ms % {DAY} < {4 * BAR} or open_ts_ms % {DAY} > {44 * BAR}),"""
        + _findings("audited", _NOW) + "," + _stuck("audited", 4, 5, 0.5, False) + "," + _series("b1", BAR) + "," + _kinds("audited", 5_400_000, 5_400_000, 6_000_000)
        + f""",
fine as ({_roll("b1", ROLL)}),
coarse as ({_roll("filled", ROLL)}),
pairs as (
  select ticker_id, (a.open, a.high, a.low, a.close, a.vbid, a.vask, a.tick_count) is not distinct from (b.open, b.high, b.low, b.close, b.vbid, b.vask, b.tick_count) as same from fine a full join coarse b using (ticker_id, open_ts_ms)),
bar_days as (
  select ticker_id, day, n / ((b - a) / {BAR}::double + 1) as share, min(day) over (partition by ticker_id) as d0, max(day) over (partition by ticker_id) as d1
  from (select ticker_id, open_ts_ms // {DAY} as day, count(*) as n, min(open_ts_ms) as a, max(open_ts_ms) as b from b1 group by all)),
runs0 as (
  select ticker_id, run, count(*) as n from (
    select *, sum(new) over (partition by ticker_id order by open_ts_ms) as run from (
      select *, case when v = lag(v) over (partition by ticker_id order by open_ts_ms) then 0 else 1 end as new from (select *, tick_count = 0 as v from b1))) where v group by all),
counts as (
  select r.ticker_id,
    (select count(*) from audited x where x.ticker_id = r.ticker_id) as rows,
    (select count(*) from kinds x where x.ticker_id = r.ticker_id and kind = 'OUTAGE') as outages,
    (select coalesce(max(d) - min(d) + 1 - count(*), 0)::bigint from (select distinct ts_ms // {DAY} as d from audited x where x.ticker_id = r.ticker_id)) as missing_days,
    (select count(*) from found x where x.ticker_id = r.ticker_id and severity = 'E' and code not like 'G10%') as invariants,
    (select count(*) from series_found x where x.ticker_id = r.ticker_id and severity = 'E' and code not in ('GRID', 'SPACE')) as bar_faults,
    (select count(*) from series_found x where x.ticker_id = r.ticker_id and code in ('GRID', 'SPACE')) as off_grid,
    (select count(*) from bar_days x where x.ticker_id = r.ticker_id and share < 0.5 and day > d0 and day < d1) as low_coverage,
    (select count(*) from runs0 x where x.ticker_id = r.ticker_id and n >= 4) as zero_runs,
    (select count(*) from pairs x where x.ticker_id = r.ticker_id and not same) as parity,
    (select count(*) from stuck x where x.ticker_id = r.ticker_id) as stuck
  from (select unnest(range(1, 7)) as ticker_id) r),
told as (
  select *, array_to_string(list_filter([{", ".join(f"case when {x} > 0 then '{x}=' || {x} end" for x in ("outages", "missing_days", "invariants", "bar_faults", "off_grid", "low_coverage", "zero_runs", "parity", "stuck"))}], lambda x: x is not null), ',') as why
  from counts)""",
        "select * exclude (why), case when rows > 0 then why else '' end as reasons, case when rows = 0 then 'NO_DATA' when why <> '' then 'FAIL' else 'PASS' end as verdict from told"),
    "vol_findings": _with(_BARS + f",\nraw as ({_rs('bars')}),\nvol as (select ticker_id, bin_ts_ms, case when bin_ts_ms // {BAR} % 13 = 0 then 'nan'::double else sigma_pct * 2 end as s, bin_ts_ms - lag(bin_ts_ms) over (partition by ticker_id order by bin_ts_ms) as step from raw)",
        f"select ticker_id, bin_ts_ms, unnest(list_filter([case when isnan(s) then 'NONFINITE' end, case when s < 0 or s >= 5 then 'RANGE' end, case when s > 0.5 then 'HIGH' end, case when step <= 0 then 'ORDER' end, case when step > {BAR} then 'GAP' end], lambda x: x is not null)) as code from vol"),
    "file_stats": _with(_RECORDS, """select ticker_id, round(avg(ci_ubp / m), 6) as ci_ratio, round(avg(s), 6) as mean_spread, round(max(s), 6) as max_spread, round(avg(case when s > 500 then 1.0::double else 0 end), 6) as wide, round((max(ts_ms) - min(ts_ms)) / 3600000.0::double, 6) as hours, round(sum(rejected) / (sum(accepted) + sum(rejected))::double, 6) as reject_rate
from (select *, (a - bid) / m * 10000 as s from (select *, (bid + a) * 0.5::double as m from (select *, case when event_id % 89 = 0 then ask * 1.2::double else ask end as a from records where bid > 0 and ask > 0 and ask >= bid))) group by ticker_id"""),
    "distinct_mids": _with(_RECORDS, "select ticker_id, count(distinct m) as distinct_mids, round(count(distinct m) / count(*)::double, 6) as fraction from clean group by ticker_id"),
    "glue_status": _with(_RECORDS + "," + _DAYS + f",\ngaps as ({_GAPS.format(least=0)}),\nlost as ({_MISSING.format(source='days')})",
        """select ticker_id, coalesce(gaps, 0) as gaps, coalesce(missing, 0) as missing, case when coalesce(missing, 0) > 0 then 'ERROR' when coalesce(gaps, 0) > 0 then 'WARN' else 'OK' end as status
from (select distinct ticker_id from clean) left join (select ticker_id, count(*) filter (where gap_ms > 7200000) as gaps from gaps group by ticker_id) using (ticker_id) left join (select ticker_id, count(*) as missing from lost group by ticker_id) using (ticker_id)"""),
    "audit_verdict": _with(_RECORDS + "," + _FAULTY + _KEPT + "," + _findings("deep", _NOW + 10**11) + "," + _VERDICT, "select * from verdicts"),
    "audit_exit": _with(_RECORDS + "," + _FAULTY + _KEPT + "," + _findings("deep", _NOW + 10**11) + "," + _VERDICT, "select max(case when errors > 0 then 2 when warnings > 0 then 1 else 0 end)::int as code, count(*) filter (where verdict = 'PASS') as pass, count(*) filter (where verdict = 'FAIL') as fail, count(*) filter (where verdict = 'NO_DATA') as no_data from verdicts"),
    "shard_manifest": _with(_RECORDS, "select ticker_id, strftime(make_timestamp(ts_ms * 1000), '%Y-%m-%d') as date, min(ts_ms) as first_ts, max(ts_ms) as last_ts, count(*) as n_records from clean group by all"),
    "archive_urls": """select * from (
with d as (select distinct o_orderdate::date as x from orders), p as (select strftime(x, '%Y-%m-%d') as date, strftime(x, '%Y') as y, strftime(x, '%m') as m, strftime(x, '%d') as d from d)
select 'binance' as exchange, date, 'https://data.binance.vision/data/spot/monthly/aggTrades/BTCUSDT/BTCUSDT-aggTrades-' || y || '-' || m || '.zip' as monthly, 'https://data.binance.vision/data/spot/daily/aggTrades/BTCUSDT/BTCUSDT-aggTrades-' || date || '.zip' as daily from p
union all select 'bitget', date, null, 'https://img.bitgetimg.com/online/trades/SPBL/BTCUSDT/' || y || m || d || '_001.zip' from p
union all select 'bybit', date, 'https://public.bybit.com/spot/BTCUSDT/BTCUSDT-' || y || '-' || m || '.csv.gz', 'https://public.bybit.com/spot/BTCUSDT/BTCUSDT_' || date || '.csv.gz' from p
union all select 'okx', date, 'https://static.okx.com/cdn/okex/traderecords/trades/monthly/' || y || m || '/BTC-USDT-trades-' || y || '-' || m || '.zip', 'https://static.okx.com/cdn/okex/traderecords/trades/daily/' || y || m || d || '/BTC-USDT-trades-' || date || '.zip' from p)""",
    "own_ticker_filter": _with(_RECORDS, "select event_id, ticker_id from records where event_id % 23 <> 0"),
    "resample_report": _with(_RECORDS + f""",
mine as (select * from records where event_id % 23 <> 0),
made as (select ticker_id, ts_ms - ts_ms % {BAR} as ts_ms, max((ts_ms, event_id))[2] as event_id from mine group by all),
old as (select ticker_id, ts_ms // {DAY} as day, count(*) as count_old, round(median(case when d > 0 and d < {DAY} then d end))::bigint as spacing_old_ms from (select *, ts_ms - lag(ts_ms) over (partition by ticker_id order by ts_ms, event_id) as d from mine) group by all),
new as (select ticker_id, ts_ms // {DAY} as day, count(*) as count_new, round(median(case when d > 0 and d < {DAY} then d end))::bigint as spacing_new_ms from (select *, ts_ms - lag(ts_ms) over (partition by ticker_id order by ts_ms, event_id) as d from made) group by all),
other as (select ticker_id % 5 + 1 as ticker_id, ts_ms // {DAY} as day, count(*) as misrouted from records where event_id % 23 = 0 group by all)""",
        f"select ticker_id, strftime(make_timestamp(day * {DAY} * 1000), '%Y-%m-%d') as date, coalesce(count_old, 0) as count_old, spacing_old_ms, coalesce(count_new, 0) as count_new, spacing_new_ms, coalesce(misrouted, 0) as misrouted from old full join new using (ticker_id, day) left join other using (ticker_id, day)"),
    "rekeyed_shards": _with(_RECORDS + """,
one as (select ticker_id, event_id, ts_ms from clean),
two as (select case ticker_id when 2 then 102 else ticker_id end as ticker_id, event_id, ts_ms from clean where event_id % 307 <> 0),
a as (select ticker_id, strftime(make_timestamp(ts_ms * 1000), '%Y-%m-%d') as date, min(ts_ms) as first_ts, max(ts_ms) as last_ts, count(*) as n_records from one group by all),
b as (select ticker_id, strftime(make_timestamp(ts_ms * 1000), '%Y-%m-%d') as date, min(ts_ms) as first_ts, max(ts_ms) as last_ts, count(*) as n_records from two group by all)""",
        "select 'a' as side, * from (select * from a except select * from b) union all select 'b', * from (select * from b except select * from a)"),
    "median_spacing": _with(_RECORDS, "select ticker_id, round(median(d))::bigint as spacing_ms from (select ticker_id, ts_ms - lag(ts_ms) over (partition by ticker_id order by ts_ms, event_id) as d from clean) where d > 0 and d < 86400000 group by ticker_id"),
    "rank_percentiles": _with(_RECORDS, f"select ticker_id, {', '.join(f'v[(round((len(v) - 1) * {p / 100}::double) + 1)::int] as p{p}' for p in (10, 50, 90))} from (select ticker_id, list_sort(list(n)) as v from (select ticker_id, ts_ms // {DAY} as d, count(*) as n from clean group by all) group by ticker_id)"),
    "month_windows": """with span as (select min(o_orderdate)::date as a, max(o_orderdate)::date as b from orders), m as (select a, b, unnest(generate_series(date_trunc('month', a), b, interval 1 month))::date as m from span)
select strftime(greatest(a, m), '%Y-%m-%d') as month_start, strftime(least(b, last_day(m)), '%Y-%m-%d') as month_end, a <= m and b >= last_day(m) as whole from m""",
    "archive_plan": """with m as (select greatest(date '1996-01-10', m) as s, least(date '1998-12-05', last_day(m)) as e, date '1996-01-10' <= m and date '1998-12-05' >= last_day(m) as whole from (select unnest(generate_series(date '1996-01-01', date '1998-12-05', interval 1 month))::date as m)),
have as (select date_trunc('month', o_orderdate)::date as s, count(*) % 3 as ticks from orders where o_orderstatus = 'P' group by 1),
p as (select s, e, whole and coalesce(ticks, 0) > 0 as monthly from m left join have using (s)),
d as (select 'monthly' as kind, s as date from p where monthly union all select 'daily', unnest(generate_series(s, e, interval 1 day))::date from p where not monthly)
select kind, strftime(date, '%Y-%m-%d') as date, 'https://archive.example/okx/' || kind || '/BTC-USDT-' || (case when kind = 'monthly' then strftime(date, '%Y-%m') else strftime(date, '%Y-%m-%d') end) || '.zip' as url from d""",
    "asset_class_bucket": _with(_PAIRS, "select c_custkey, base, quote, class, case when quote = 'USDC' and base not in ('USDT', 'USDC') then base end as usdc_base from classed"),
    "target_bpd_resolve": _with(_PAIRS, "select c_custkey, (case when base = 'BTC' and quote = 'EUR' then 400 when base = 'DOGE' and quote = 'USD' then 120 when class = 'crypto_stable' then 50 else 300 end)::int as target from classed"),
    "ticker_bits": """select o_orderkey, (1 + o_orderkey % 7)::bigint as itype, 2::bigint as base_class, (o_custkey % 65536)::bigint as base_id, 5::bigint as quote_class, (o_orderkey % 65536)::bigint as quote_id, (o_orderkey * 13 % 1048576)::bigint as sub_type,
(((1 + o_orderkey % 7)::bigint << 60) | (2::bigint << 56) | ((o_custkey % 65536)::bigint << 40) | (3::bigint << 36) | (5001::bigint << 20) | (o_orderkey * 13 % 1048576))::bigint as rebased from orders""",
    "renko_bricks": _with(_BRICKS, "select ticker_id, seq, ts_ms, round(open, 6) as open, round(close, 6) as close from bricks", True),
    "bricks_per_day": _with(_BRICKS, "select ticker_id, strftime(date, '%Y-%m-%d') as date, n from per_day", True),
    "brick_quarantine": _with(_BRICKS, "select ticker_id, count(*) filter (where n > 0) as clean, count(*) as days, median(n) as median, count(*) filter (where n > 0) < least(greatest(3, count(*) // 2), count(*)) as dead from per_day group by ticker_id", True),
    "seam_renko": _with(_BRICKS + """,
ends as (select ticker_id, make_timestamp(ts_ms * 1000)::date as d, first(open order by seq) as f, last(close order by seq) as l from bricks group by all),
seams as (select ticker_id, f, lag(l) over (partition by ticker_id order by d) as p from ends)""",
        "select ticker_id, count(*) as seams, count(*) filter (where abs(f - p) > greatest(abs(p) * 1e-9::double, 1e-15::double)) as broken from seams where p is not null group by ticker_id", True),
    "minpct_clamp_fraction": _with(_PATH, "select ticker_id, round(avg(case when sigma * 5.0::double <= 0.02::double then 1.0::double else 0 end), 6) as fraction from path group by ticker_id"),
    "synth_cross_bars": _with(_RECORDS + "," + _cross(3_600_000) + f",\nq as (select 12::bigint as ticker_id, ts_ms, event_id * 2 + leg as event_id, bid, ask, (bid + ask) * 0.5::double as m, 0 as vbid, 0 as vask from crossed where fresh),\nqbars as ({_ohlc('q', BAR)}),\nqfilled as ({_fill('qbars', BAR)})", f"select {_NAMES.replace(', 6)', ', 9)')} from qfilled"),
    "monthly_sigma_sidecar": _with(_BARS + f",\ndaily as ({_roll('bars', DAY)}),\nrb as ({_RETURNS.format(source='bars')}),\nrd as ({_RETURNS.format(source='daily')}),\n" + "fine as (select ticker_id, strftime(make_timestamp(open_ts_ms * 1000), '%Y-%m') as month, stddev_samp(r) as sigma_bar from rb group by all),\ncoarse as (select ticker_id, strftime(make_timestamp(open_ts_ms * 1000), '%Y-%m') as month, stddev_samp(r) as sigma_day from rd group by all)",
        "select ticker_id, month, round(sigma_bar, 6) as sigma_bar, round(sigma_day, 6) as sigma_day, round(sigma_bar / sigma_day, 6) as ratio, round(least(greatest(0.002::double / sigma_bar, 0.05::double), 4.0::double), 6) as k from fine join coarse using (ticker_id, month)"),
    "roster_set_ops": "select id from (select c_custkey as id from customer where c_nationkey < 12 union select o_custkey from orders) where id not in (select c_custkey from customer where c_custkey % 10 = 3) and id in (select o_custkey from orders)",
    "backfill_glue": _with(_RECORDS + ", live as (select * from clean where provider_id < 2 and ts_ms > 1704067200000 + ticker_id * 259200000)", "select ticker_id, event_id, ts_ms, provider_id, 'live' as origin from live union all select c.ticker_id, event_id, ts_ms, provider_id, 'backfill' from clean c left join (select ticker_id, min(ts_ms) as s from live group by ticker_id) l using (ticker_id) where provider_id >= 2 and (s is null or ts_ms < s)"),
    "latency_levels": _with(_RECORDS, """select ticker_id, i as idx_ms_level, s as s10_ms_level, r as renko_ms_level, greatest(i, s, r) as level from (
select ticker_id, (case when x >= 10 then 2 when x >= 2 then 1 else 0 end)::int as i, (case when y >= 30 then 2 when y >= 15 then 1 else 0 end)::int as s, (case when z >= 600 then 2 when z >= 300 then 1 else 0 end)::int as r
from (select ticker_id, (age // 100000) / 1000.0::double as x, (age // 10000) / 1000.0::double as y, (age // 1000) / 1000.0::double as z from (select ticker_id, 1706659200000 - max(ts_ms) as age from clean group by ticker_id)))"""),
    "truncated_downloads": "select l_orderkey, l_linenumber, coalesce(floor(l_extendedprice) < (case when l_linenumber < 6 then floor(l_quantity * 1000) end), false) as truncated from lineitem",
    "csv_trades": _with(_TRADES, """select 7::bigint as ticker_id, 1 as provider_id, t.ts_ms, round(k.bid, 6) as bid, round(k.ask, 6) as ask, (case when is_buyer then 0 else trunc(price * 2.5::double) end)::bigint as vbid, (case when is_buyer then trunc(price * 2.5::double) else 0 end)::bigint as vask
from trades t join ticks k using (event_id) where event_id % 53 <> 0"""),
}
