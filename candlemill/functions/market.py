"""Trade and candle expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from candlemill.config import DEFAULTS

# Dashboards filter on these labels.
FRESH = "Fresh ✅"
STALE = "Stale ⚠️"
DEAD = "Dead ❌"


def trade_side(maker: str | Column) -> Column:
    """BUY when the buyer took liquidity, SELL otherwise. An unknown flag counts as SELL."""
    maker = F.col(maker) if isinstance(maker, str) else maker
    return F.when(~maker, F.lit("BUY")).otherwise(F.lit("SELL"))


def price_magnitude(price: str | Column) -> Column:
    """Base-10 logarithm, to two decimals. NULL for a price of zero."""
    return F.round(F.ln(price) / F.ln(F.lit(10.0)), 2)


def is_large_trade(value: str | Column, limit: float = DEFAULTS.large_trade) -> Column:
    value = F.col(value) if isinstance(value, str) else value
    return F.coalesce(value > F.lit(limit), F.lit(False))


def price_ticks(price: str | Column) -> Column:
    """Price in units of 1e-8, the precision silver keeps.

    Fits a long for every price below the cleaning cap; prices beyond 9.2e10 count as that.
    """
    price = F.col(price) if isinstance(price, str) else price
    most = F.lit(9.2e18)
    return F.greatest(F.least(F.rint(price * F.lit(1e8)), most), -most).cast("bigint")


def strip_quote(symbol: str | Column, quote: str = DEFAULTS.quote) -> Column:
    """Base currency of a pair, upper-cased: ``btcusdt`` becomes ``BTC``."""
    return F.upper(F.regexp_replace(symbol, f"(?i){re.escape(quote)}$", ""))


def completeness(present: Column, expected: Column) -> Column:
    """Share of the expected candles in percent, to one decimal. NULL when none are expected."""
    return F.round(present * F.lit(100.0) / F.nullif(expected.cast("double"), F.lit(0.0)), 1)


def freshness_status(
    minutes: Column,
    fresh: float = DEFAULTS.fresh_minutes,
    stale: float = DEFAULTS.stale_minutes,
) -> Column:
    return (
        F.when(minutes <= fresh, F.lit(FRESH))
        .when(minutes <= stale, F.lit(STALE))
        .otherwise(F.lit(DEAD))
    )
