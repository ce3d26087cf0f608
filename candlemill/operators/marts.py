"""Daily price marts and dashboard series over the candle table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlemill.config import DEFAULTS
from candlemill.functions import strip_quote


def daily_prices(
    candles: DataFrame, pairs: Sequence[str] | None = None, quote: str = DEFAULTS.quote
) -> DataFrame:
    """Average close, extremes and volume per date and base currency.

    ``pairs`` keeps the named pairs, whatever their case; None keeps all.
    """
    if pairs is not None:
        candles = candles.where(F.lower("symbol").isin([p.lower() for p in pairs]))
    return candles.groupBy(
        F.to_date("candle_start_time").alias("date"), strip_quote("symbol", quote).alias("symbol")
    ).agg(
        F.avg("close_price").alias("avg_price"),
        F.max("high_price").alias("max_price"),
        F.min("low_price").alias("min_price"),
        F.sum("total_volume").alias("total_volume"),
    )


def price_vs_sentiment(daily: DataFrame, sentiment: DataFrame) -> DataFrame:
    """Daily prices with the day's sentiment; days without one keep NULLs."""
    readings = sentiment.select("date", "fng_value", "fng_classification")
    return daily.join(readings, "date", "left").select(
        "date",
        "symbol",
        "avg_price",
        "max_price",
        "min_price",
        "total_volume",
        "fng_value",
        "fng_classification",
    )


def newest_days_first(mart: DataFrame) -> DataFrame:
    """Reading order of the mart. A stored table keeps no order."""
    return mart.orderBy(F.desc_nulls_first("date"))


def close_series(candles: DataFrame) -> DataFrame:
    """Close price over time per symbol. Order it when reading a bounded part."""
    return candles.select("symbol", "candle_start_time", "close_price")


def volume_by_symbol(candles: DataFrame) -> DataFrame:
    return candles.groupBy("symbol").agg(F.sum("total_volume").alias("total_volume"))


def pressure(candles: DataFrame) -> DataFrame:
    """Taker buys against maker sells per hour and symbol, and the share of buys."""
    buy, sell = F.col("buy_volume"), F.col("sell_volume")
    return (
        candles.groupBy("symbol", F.date_trunc("hour", "candle_start_time").alias("hour"))
        .agg(F.sum("buy_volume_taker").alias("buy_volume"), F.sum("sell_volume_maker").alias("sell_volume"))
        .withColumn("buy_share", buy / F.nullif(buy + sell, F.lit(0.0)))
    )


def activity_heatmap(candles: DataFrame) -> DataFrame:
    """Trades by hour of the day and symbol."""
    return candles.groupBy(F.hour("candle_start_time").alias("hour_of_day"), "symbol").agg(
        F.sum("trade_count").alias("trade_count")
    )
