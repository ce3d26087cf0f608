"""Bronze and silver transforms: event time, partitions, cleaning, typing, enrichment, dedup."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlemill.config import DEFAULTS, Settings
from candlemill.functions import (
    as_timestamp,
    event_time,
    is_large_trade,
    partition_values,
    price_magnitude,
    trade_side,
)
from candlemill.functions.times import AsOf, has_event_time

DEDUP_KEYS = ("symbol", "trade_timestamp", "price", "quantity")


def add_event_time(df: DataFrame, ms: str = "trade_time", name: str = "timestamp") -> DataFrame:
    return df.withColumn(name, event_time(ms))


def add_partitions(df: DataFrame, ts: str, hour: bool = False) -> DataFrame:
    return df.withColumns(partition_values(ts, hour))


def clean_trades(df: DataFrame, price_cap: float = DEFAULTS.price_cap) -> DataFrame:
    """Trades with a symbol, a time and usable numbers. Stands on raw columns, so it reaches the scan.

    NaN sorts above every number, so the upper bounds drop it along with infinity.
    """
    price, quantity = F.col("price"), F.col("quantity")
    return df.where(
        (price > 0)
        & (price < F.lit(price_cap))
        & (quantity > 0)
        & (quantity < F.lit(float("inf")))
        & F.col("symbol").isNotNull()
        & has_event_time("trade_time")
    )


def type_trades(df: DataFrame) -> DataFrame:
    """Typed times and 8-decimal numbers in place of the raw time and the old partitions."""
    return df.withColumns(
        {
            "trade_timestamp": event_time("trade_time"),
            "ingest_timestamp": F.col("ingested_at").try_cast("timestamp"),
            "price": F.round("price", 8),
            "quantity": F.round("quantity", 8),
        }
    ).drop("trade_time", "ingested_at", "year", "month", "day", "hour")


def enrich_trades(
    df: DataFrame, large: float = DEFAULTS.large_trade, as_of: AsOf = None
) -> DataFrame:
    value = F.round(F.col("price") * F.col("quantity"), 8)
    return df.withColumns(
        {
            "trade_value": value,
            "trade_side": trade_side("is_buyer_maker"),
            "price_magnitude": price_magnitude("price"),
            "is_large_trade": is_large_trade(value, large),
            "processed_at": as_timestamp(as_of),
        }
    )


def dedup_trades(
    df: DataFrame,
    keys: Sequence[str] = DEDUP_KEYS,
    order: Sequence[str] = ("ingest_timestamp",),
    time: str = "trade_timestamp",
    delay: str = DEFAULTS.watermark,
    salts: int = DEFAULTS.dedup_salts,
) -> DataFrame:
    """One row per key.

    Batch: the row lowest in ``order`` (NULLs last), remaining ties broken by the whole row, so the
    survivor does not depend on row order. Spark limits each group to one row before the shuffle,
    so a trade with very many copies sends one row per map task.

    Stream: the first to arrive; rows behind the watermark are dropped. The watermark is one for
    all symbols, so a symbol far ahead makes the others late. All copies of one trade meet in one
    state partition, so they are first reduced within ``salts`` groups, by the task that read
    them. That costs a second state store; 0 or 1 leaves it out. The keys must include ``time`` for
    the watermark to clear state.
    """
    keys = list(keys)
    if not df.isStreaming:
        rest = [c for c in df.columns if c not in keys and c not in order]
        # Sorting compares the first key by a machine word, and times repeat less than symbols.
        by_time = sorted(keys, key=lambda key: key != time)
        ranking = Window.partitionBy(*by_time).orderBy(
            *(F.asc_nulls_last(c) for c in order), *(F.asc_nulls_last(c) for c in rest)
        )
        ranked = df.withColumn("_copy", F.row_number().over(ranking))
        return ranked.where(F.col("_copy") == 1).drop("_copy")

    marked = df.withWatermark(time, delay)
    if salts > 1:
        salted = marked.withColumn("_salt", F.spark_partition_id() % F.lit(salts))
        marked = salted.dropDuplicates([*keys, "_salt"]).drop("_salt")
    return marked.dropDuplicates(keys)


def bronze(records: DataFrame) -> DataFrame:
    """Decoded records with event time and hourly partitions."""
    return add_partitions(add_event_time(records), "timestamp", hour=True)


def silver(bronze_trades: DataFrame, settings: Settings = DEFAULTS, as_of: AsOf = None) -> DataFrame:
    """Clean, typed, enriched, deduplicated trades with daily partitions.

    The dedup runs on the typed columns alone and the derived ones follow it, so that they are
    neither shuffled nor kept in state.
    """
    typed = type_trades(clean_trades(bronze_trades, settings.price_cap)).select(
        "source",
        "symbol",
        "price",
        "quantity",
        "is_buyer_maker",
        "trade_timestamp",
        "ingest_timestamp",
    )
    unique = dedup_trades(typed, delay=settings.watermark, salts=settings.dedup_salts)
    return add_partitions(enrich_trades(unique, settings.large_trade, as_of), "trade_timestamp")
