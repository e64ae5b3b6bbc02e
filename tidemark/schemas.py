"""Row schemas of the pipeline's tables."""

TICKS = "ticker_id bigint, provider_id int, ts_ms bigint, bid double, ask double, vbid bigint, vask bigint"
RECORDS = TICKS + ", ci_ubp double, tick_count int, confidence int, accepted int, rejected int, flags int, date date"
BARS = (
    "ticker_id bigint, kind int, open_ts_ms bigint, close_ts_ms bigint, open double, high double, low double, close double, vbid bigint, vask bigint, "
    "tick_count bigint, realized_var double, bipower_var double, drift double, vol_imbalance double, avg_spread_bps double, max_abs_return double, avg_ci_ubp double, reject_rate double, date date"
)
VOL = "ticker_id bigint, bin_ts_ms bigint, sigma_pct double"
