"""Named settings; the values are the pipeline's published defaults, or our own where none is known."""

from __future__ import annotations

from dataclasses import dataclass

# Fixed values.
SENTINEL, NO_BOOK, BACKFILL, HEALED, SYNTHETIC_BRICK, CONF_FRESHNESS, CONF_ACTIVE = 1, 2, 32, 16, 4, 8, 64
VOL_BIN_MS, S10_MS, DAY_MS = 1_800_000, 10_000, 86_400_000
MTS_EPOCH_MS = 1_262_304_000_000
U32, U16 = 4_294_967_295, 65_535
K_FLOOR, K_CEILING = 0.05, 4.0
LOG_RUNG = 0.004988
SIGMA_FALLBACK, MAX_JUMP, RESEED_AFTER, MAX_BRICKS = 0.01, 0.10, 10, 1000
TTL_MS, STALE_SECS = 5_000, 30
STABLES = ("USDT", "USDC", "DAI", "FDUSD", "TUSD")
MAJORS = ("BTC", "ETH", "SOL", "BNB", "XRP")
FIAT = ("USD", "EUR", "GBP", "JPY", "CHF")
CLASS_TARGETS = {"crypto_stable": 50, "crypto_major": 300, "crypto_alt": 300, "crypto_cross": 300, "fx_major": 300, "fx_cross": 300}


@dataclass(frozen=True)
class Calibration:
    """Settings of the Renko multiplier's solver."""

    target: float = 300.0
    tolerance: float = 0.05
    low: float = K_FLOOR
    high: float = K_CEILING
    min_pct: float = 0.0005
    window_days: int = 730
    clamp_limit: float = 0.5
