"""Thresholds of the trade layers, gathered so that jobs and tests share one set."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Settings:
    # Cleaning and enrichment. Both limits are strict.
    price_cap: float = 1_000_000.0
    large_trade: float = 10_000.0

    # Streaming.
    watermark: str = "10 minutes"
    dedup_salts: int = 0

    # Candles and their expected density.
    candle_width: str = "1 minute"
    candles_per_hour: int = 60
    candles_per_day: int = 1440

    # Freshness bands in minutes. Both limits are inclusive.
    fresh_minutes: float = 5.0
    stale_minutes: float = 30.0

    # Currency suffix that pairs end with.
    quote: str = "usdt"


DEFAULTS = Settings()
