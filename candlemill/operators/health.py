"""Completeness and freshness of the candle table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlemill.config import DEFAULTS
from candlemill.functions import as_timestamp, completeness, freshness_status, minutes_since
from candlemill.functions.times import AsOf


def hourly_ingestion(
    candles: DataFrame,
    per_hour: int = DEFAULTS.candles_per_hour,
    fill_gaps: bool = False,
    until: AsOf = None,
    stage: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Candles, trades and volume per hour and symbol, with the share of expected candles.

    Hours without any candle have no row. ``fill_gaps`` adds them with zero counts, from each
    symbol's first hour to its last, or to ``until`` when given. That reads the hourly rows twice;
    ``stage`` has them written once, as in :func:`ingestion_health`.
    """
    hourly = candles.groupBy(
        F.date_trunc("hour", "candle_start_time").alias("ingestion_hour"), "symbol"
    ).agg(
        F.count("*").alias("candles_count"),
        F.sum("trade_count").alias("total_trades"),
        F.sum("total_volume").alias("total_volume"),
        F.max("ingested_at").alias("last_ingested_at"),
        F.min("candle_start_time").alias("earliest_candle"),
        F.max("candle_start_time").alias("latest_candle"),
    )
    if fill_gaps:
        hourly = _with_empty_hours(hourly if stage is None else stage(hourly), until)
    count = F.col("candles_count")
    return hourly.withColumns(
        {
            "completeness_pct": completeness(count, F.lit(per_hour)),
            "missing_candles": F.lit(per_hour).cast("bigint") - count,
        }
    )


def freshness(
    candles: DataFrame,
    as_of: AsOf = None,
    fresh: float = DEFAULTS.fresh_minutes,
    stale: float = DEFAULTS.stale_minutes,
) -> DataFrame:
    """Age and status of each symbol's latest candle."""
    return _freshness(candles, "candle_start_time", "ingested_at", as_of, fresh, stale)


def daily_summary(candles: DataFrame, per_day: int = DEFAULTS.candles_per_day) -> DataFrame:
    """Candles, symbols, trades and volume per day over all symbols.

    Grouped by day and symbol first: symbols are then counted without a distinct aggregate.
    """
    per_symbol = candles.groupBy(
        F.date_trunc("day", "candle_start_time").alias("date"), "symbol"
    ).agg(
        F.count("*").alias("candles_count"),
        F.sum("trade_count").alias("total_trades"),
        F.count("trade_count").alias("counted"),
        F.sum("total_volume").alias("total_volume"),
    )
    return per_symbol.groupBy("date").agg(
        F.sum("candles_count").alias("total_candles"),
        F.count("symbol").alias("active_symbols"),
        F.sum("total_trades").alias("total_trades"),
        F.sum("total_volume").alias("total_volume"),
        (F.sum("total_trades") / F.nullif(F.sum("counted"), F.lit(0))).alias(
            "avg_trades_per_candle"
        ),
        _daily_completeness(per_day).alias("daily_completeness_pct"),
    )


def ingestion_health(
    candles: DataFrame,
    as_of: AsOf = None,
    stage: Callable[[DataFrame], DataFrame] | None = None,
    per_hour: int = DEFAULTS.candles_per_hour,
    per_day: int = DEFAULTS.candles_per_day,
    fresh: float = DEFAULTS.fresh_minutes,
    stale: float = DEFAULTS.stale_minutes,
) -> DataFrame:
    """Hourly report with the symbol's freshness and the day's totals alongside.

    The candles are aggregated once, to hours; freshness and day totals are rolled up from those.
    Each of the three reads the hourly rows, so pass ``stage`` (for instance
    :func:`candlemill.sources.staging.stage`) to have them written once and read back; without it
    the hourly aggregate is planned three times.
    """
    hourly = hourly_ingestion(candles, per_hour)
    if stage is not None:
        hourly = stage(hourly)
    return health_from_hours(hourly, as_of, per_day, fresh, stale)


def health_from_hours(
    hourly: DataFrame,
    as_of: AsOf = None,
    per_day: int = DEFAULTS.candles_per_day,
    fresh: float = DEFAULTS.fresh_minutes,
    stale: float = DEFAULTS.stale_minutes,
) -> DataFrame:
    """The report from rows of :func:`hourly_ingestion`, just made or kept by day.

    Kept ones are maintained by :func:`candlemill.streaming.rebuild.hour_days`: an hour belongs to
    one day, so the days that changed are made anew and no others.
    """
    latest = _freshness(hourly, "latest_candle", "last_ingested_at", as_of, fresh, stale)
    days = (
        hourly.groupBy(F.date_trunc("day", "ingestion_hour").alias("_day"), "symbol")
        .agg(F.sum("candles_count").alias("candles_count"))
        .groupBy("_day")
        .agg(
            F.sum("candles_count").alias("day_total_candles"),
            F.count("symbol").alias("day_active_symbols"),
            _daily_completeness(per_day).alias("daily_completeness_pct"),
        )
    )
    # No broadcast hints: the planner broadcasts the right sides by their size, measured at run
    # time, and joins by sorting beyond its limit. Hourly rows hold no hot symbol.
    return (
        hourly.withColumn("_day", F.date_trunc("day", "ingestion_hour"))
        .join(latest.drop("latest_ingestion_time"), "symbol", "left")
        .join(days, "_day", "left")
        .select(
            "ingestion_hour",
            "symbol",
            "candles_count",
            "total_trades",
            "total_volume",
            "last_ingested_at",
            "earliest_candle",
            "latest_candle",
            "completeness_pct",
            "missing_candles",
            "latest_candle_time",
            "minutes_since_last_candle",
            "freshness_status",
            "day_total_candles",
            "day_active_symbols",
            "daily_completeness_pct",
        )
    )


def newest_hours_first(report: DataFrame) -> DataFrame:
    """Reading order of the report. A stored table keeps no order."""
    return report.orderBy(F.desc_nulls_first("ingestion_hour"), F.asc_nulls_last("symbol"))


def _freshness(
    df: DataFrame, time: str, ingested: str, as_of: AsOf, fresh: float, stale: float
) -> DataFrame:
    minutes = F.col("minutes_since_last_candle")
    return (
        df.groupBy("symbol")
        .agg(
            F.max(time).alias("latest_candle_time"),
            F.max(ingested).alias("latest_ingestion_time"),
        )
        .withColumn("minutes_since_last_candle", minutes_since("latest_candle_time", as_of))
        .withColumn("freshness_status", freshness_status(minutes, fresh, stale))
    )


def _daily_completeness(per_day: int) -> Column:
    expected = F.count("symbol") * F.lit(per_day)
    return completeness(F.sum("candles_count"), expected)


def _with_empty_hours(hourly: DataFrame, until: AsOf) -> DataFrame:
    last = F.max("ingestion_hour")
    if until is not None:
        last = F.greatest(last, F.date_trunc("hour", as_timestamp(until)))
    spans = hourly.groupBy("symbol").agg(F.min("ingestion_hour").alias("_first"), last.alias("_last"))
    # By days and then by hours, so that a long span makes no long array.
    days = spans.withColumn("_day", F.explode(F.sequence(F.to_date("_first"), F.to_date("_last"))))
    hours = (
        days.withColumn("_hour", F.explode(F.sequence(F.lit(0), F.lit(23))))
        .withColumn(
            "ingestion_hour",
            F.col("_day").cast("timestamp") + F.make_dt_interval(hours=F.col("_hour")),
        )
        .where(F.col("ingestion_hour").between(F.col("_first"), F.col("_last")))
        .select("symbol", "ingestion_hour")
    )
    # Only hours that the grid adds are filled; a candle without symbol or volume stays as it is.
    own = hourly.select(F.col("symbol").alias("_symbol"), F.col("ingestion_hour").alias("_hour"))
    same = F.col("symbol").eqNullSafe(F.col("_symbol")) & F.col("ingestion_hour").eqNullSafe(F.col("_hour"))
    added = hours.join(own, same, "left_anti").withColumns(
        {
            "candles_count": F.lit(0).cast("bigint"),
            "total_trades": F.lit(0).cast("bigint"),
            "total_volume": F.lit(0.0),
        }
    )
    return hourly.unionByName(added, allowMissingColumns=True)
