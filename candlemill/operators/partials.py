"""Candles that merge: partial candles keep the order of the trades that opened and closed them.

Partials of any trades of the same minute merge to the partial of all of them, in any order and
grouping, and minutes merge to hours and days. So a late trade changes its own candles without the
other trades of its day, and wider candles come from narrower ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlemill.config import DEFAULTS
from candlemill.functions import as_timestamp
from candlemill.functions.times import AsOf
from candlemill.operators.candles import width_micros

# More than the span of a signed 64-bit tie-breaker, so that a later time always ranks higher.
_TIME_STEP = "20000000000000000000BD"
_LOWEST_TIE = "-9223372036854775808L"

COLUMNS = [
    "candle_start_time",
    "symbol",
    "open_price",
    "open_order",
    "high_price",
    "low_price",
    "close_price",
    "close_order",
    "total_volume",
    "buy_volume_taker",
    "sell_volume_maker",
    "trade_count",
]


def trade_order(time: Column, tie: Column) -> Column:
    """Place of a trade among all trades, by time and then by an integer, as one number."""
    micros = F.unix_micros(time.cast("timestamp")).cast("decimal(18,0)")
    return micros * F.expr(_TIME_STEP) + F.coalesce(tie.cast("bigint"), F.expr(_LOWEST_TIE)).cast("decimal(19,0)")


def partial_candles(
    trades: DataFrame, width: str = DEFAULTS.candle_width, tie: str | Column = "trade_id", time: str = "trade_timestamp"
) -> DataFrame:
    """Partial candles per window and symbol.

    ``tie`` is an integer that tells trades of one time apart. Trades without a price count
    towards volume only; trades without a time are left out. A NULL maker flag counts in neither
    the taker nor the maker volume.
    """
    tie = F.col(tie) if isinstance(tie, str) else tie
    price, quantity, maker = F.col("price"), F.col("quantity"), F.col("is_buyer_maker")
    order = F.when(price.isNotNull(), trade_order(F.col(time), tie))
    return (
        trades.withColumn("candle_start_time", F.window(time, width)["start"])
        .groupBy("candle_start_time", "symbol")
        .agg(
            F.min_by(price, order).alias("open_price"),
            F.min(order).alias("open_order"),
            F.max(price).alias("high_price"),
            F.min(price).alias("low_price"),
            F.max_by(price, order).alias("close_price"),
            F.max(order).alias("close_order"),
            F.sum(quantity).alias("total_volume"),
            F.sum(F.when(~maker, quantity).otherwise(0.0)).alias("buy_volume_taker"),
            F.sum(F.when(maker, quantity).otherwise(0.0)).alias("sell_volume_maker"),
            F.count("*").alias("trade_count"),
        )
        .select(*COLUMNS)
    )


def merge_candles(partials: DataFrame, width: str | None = None) -> DataFrame:
    """Partials merged per symbol and start, or per window of a ``width`` that theirs divides.

    Whether it does, :func:`starts_fit` tells for widths written as a number and a unit.
    """
    rows = partials
    if width:
        rows = rows.withColumn("candle_start_time", F.window("candle_start_time", width)["start"])
    return (
        rows.groupBy("candle_start_time", "symbol")
        .agg(
            F.min_by("open_price", "open_order").alias("open_price"),
            F.min("open_order").alias("open_order"),
            F.max("high_price").alias("high_price"),
            F.min("low_price").alias("low_price"),
            F.max_by("close_price", "close_order").alias("close_price"),
            F.max("close_order").alias("close_order"),
            F.sum("total_volume").alias("total_volume"),
            F.sum("buy_volume_taker").alias("buy_volume_taker"),
            F.sum("sell_volume_maker").alias("sell_volume_maker"),
            F.sum("trade_count").alias("trade_count"),
        )
        .select(*COLUMNS)
    )


def starts_fit(narrow: str, wide: str) -> bool:
    """Whether windows of ``narrow`` fill those of ``wide``, both written as a number and a unit."""
    a, b = width_micros(narrow), width_micros(wide)
    return bool(a and b and b % a == 0)


def finish_candles(partials: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Candles of merged partials, as :func:`candlemill.operators.candles.candles` makes them."""
    return partials.drop("open_order", "close_order").withColumn("ingested_at", as_timestamp(as_of))
