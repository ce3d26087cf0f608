"""Column expressions shared by the operators."""

from candlemill.functions.market import (
    completeness,
    freshness_status,
    is_large_trade,
    price_magnitude,
    price_ticks,
    strip_quote,
    trade_side,
)
from candlemill.functions.rows import compute_once
from candlemill.functions.times import (
    as_timestamp,
    event_time,
    minutes_since,
    partition_values,
)

__all__ = [
    "as_timestamp",
    "completeness",
    "compute_once",
    "event_time",
    "freshness_status",
    "is_large_trade",
    "minutes_since",
    "partition_values",
    "price_magnitude",
    "price_ticks",
    "strip_quote",
    "trade_side",
]
