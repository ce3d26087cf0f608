"""Open/high/low/close/volume candles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlemill.config import DEFAULTS
from candlemill.functions import as_timestamp, price_ticks
from candlemill.functions.times import AsOf

# More than the span of a signed 64-bit tie-breaker, so that a later time always ranks higher.
_TIME_STEP = "20000000000000000000BD"
_LOWEST_TIE = "-9223372036854775808L"

_UNIT_MICROS = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
    "week": 604_800_000_000,
}


def width_micros(width: str) -> int | None:
    """Microseconds of a width like ``5 minutes``; None for a width written otherwise."""
    number, _, unit = width.strip().lower().partition(" ")
    step = _UNIT_MICROS.get(unit.strip().rstrip("s"))
    return int(number) * step if step and number.isdigit() else None


def silver_order() -> dict[str, object]:
    """Tie-breaking argument of :func:`candles` for silver trades, which carry no sequence number."""
    return {"tie": price_ticks("price")}


def _trade_order(trades: DataFrame, time: Column, start: Column, tie: Column | None) -> Column:
    """Ranking of trades within a candle: by time, then by ``tie``.

    Packed into one number where the tie-breaker is an integer: Spark hash-aggregates on numbers,
    but sorts its input when the extremum is taken over a struct. The time counts from the start
    of the window, so that the number fits a decimal for every width and date.
    """
    if tie is None:
        return F.struct(time, F.col("price"))
    kind = trades.select(tie).schema[0].dataType
    if not isinstance(kind, T.IntegralType):
        return F.struct(time, tie, F.col("price"))
    offset = (F.unix_micros(time) - F.unix_micros(start)).cast("decimal(18,0)")
    return offset * F.expr(_TIME_STEP) + F.coalesce(tie.cast("bigint"), F.expr(_LOWEST_TIE)).cast("decimal(19,0)")


def candles(
    trades: DataFrame,
    width: str = DEFAULTS.candle_width,
    tie: str | Column | None = None,
    as_of: AsOf = None,
    time: str = "trade_timestamp",
    ingest: str | None = None,
) -> DataFrame:
    """One candle per window and symbol, on batch or (after a watermark) streaming trades.

    Open and close are the prices at the earliest and the latest trade. Trades at the same time are
    ranked by ``tie``, a column or expression, and by price without one. An integer ``tie`` is the
    fast form; it must tell trades of one time apart, as a sequence number or ``price_ticks`` does.
    Trades without a price count towards volume only. A NULL maker flag counts in neither the
    taker nor the maker volume. Trades without a time are left out.

    ``ingest`` names a column whose latest value per candle is added as ``last_trade_ingest``:
    ``ingested_at`` tells when the candle was built, not when its trades came in.
    """
    tie = F.col(tie) if isinstance(tie, str) else tie
    price, quantity, maker = F.col("price"), F.col("quantity"), F.col("is_buyer_maker")
    extra = [F.max(ingest).alias("last_trade_ingest")] if ingest else []
    window = F.window(time, width)
    if trades.isStreaming:
        # The watermark closes windows, so the whole window is the key.
        keyed, start = trades.withColumn("_window", window), F.col("_window.start")
    else:
        # A plain start is a smaller key, and one that Spark's faster hash map takes.
        keyed, start = trades.withColumn("_window", window["start"]), F.col("_window")
    order = _trade_order(trades, F.col(time).cast("timestamp"), start.cast("timestamp"), tie)
    order = F.when(price.isNotNull(), order)
    return (
        keyed.groupBy("_window", "symbol")
        .agg(
            F.min_by(price, order).alias("open_price"),
            F.max(price).alias("high_price"),
            F.min(price).alias("low_price"),
            F.max_by(price, order).alias("close_price"),
            F.sum(quantity).alias("total_volume"),
            F.sum(F.when(~maker, quantity).otherwise(0.0)).alias("buy_volume_taker"),
            F.sum(F.when(maker, quantity).otherwise(0.0)).alias("sell_volume_maker"),
            F.count("*").alias("trade_count"),
            *extra,
        )
        .select(
            start.alias("candle_start_time"),
            "symbol",
            "open_price",
            "high_price",
            "low_price",
            "close_price",
            "total_volume",
            "buy_volume_taker",
            "sell_volume_maker",
            "trade_count",
            as_timestamp(as_of).alias("ingested_at"),
            *(["last_trade_ingest"] if ingest else []),
        )
    )
