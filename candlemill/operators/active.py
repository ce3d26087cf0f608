"""Distinct symbols that roll up: bitmaps of numbered symbols by hour.

Counts of distinct symbols by hour cannot be added to those of a day, but bitmaps can be joined.
Symbols get numbers, hour by hour a bitmap keeps which of them had candles, and days, weeks and
months are the union of their hours' bitmaps: exact, and without reading a candle again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

NUMBERS = "symbol string, number long"


def number_symbols(rows: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(symbol, number) from 1 on: those ``known`` as they are, new ones of ``rows`` behind them.

    One row per symbol is put in order, which the number of symbols bounds, not that of rows.
    NULL is no symbol.
    """
    found = rows.select("symbol").where("symbol IS NOT NULL").distinct()
    if known is None:
        known = rows.sparkSession.createDataFrame([], NUMBERS)
    last = known.agg(F.coalesce(F.max("number"), F.lit(0)).alias("last"))
    new = found.join(known, "symbol", "left_anti")
    behind = F.row_number().over(Window.orderBy("symbol")).cast("bigint")
    # One row, the highest number so far.
    new = new.withColumn("_place", behind).join(F.broadcast(last), F.col("_place") > 0)
    return known.unionByName(new.select("symbol", (F.col("last") + F.col("_place")).alias("number")))


def hourly_symbols(candles: DataFrame, known: DataFrame, time: str = "candle_start_time") -> DataFrame:
    """(hour, bucket, symbols): a bitmap of the numbered symbols with candles in each hour.

    A bitmap holds 32,768 numbers; more symbols have more buckets.
    """
    pairs = candles.select(F.date_trunc("hour", time).alias("hour"), "symbol").distinct().join(known, "symbol")
    return pairs.groupBy("hour", F.bitmap_bucket_number("number").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("symbols")
    )


def count_symbols(hours: DataFrame, unit: str = "day") -> DataFrame:
    """(start, active_symbols) by day, week, month or another unit of whole hours."""
    joined = hours.groupBy(F.date_trunc(unit, "hour").alias("start"), "bucket").agg(
        F.bitmap_or_agg("symbols").alias("symbols")
    )
    return joined.groupBy("start").agg(F.sum(F.bitmap_count("symbols")).alias("active_symbols"))
