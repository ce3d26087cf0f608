"""Data tests: one failing-row count per rule."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Volumes are sums of doubles, so a part may exceed the total by rounding.
_ROUNDING = 1e-6

CANDLE_KEYS = ("candle_start_time", "symbol")


def candle_rules() -> dict[str, Column]:
    """What must not occur in the candle table, by rule name."""
    low, high = F.col("low_price"), F.col("high_price")
    open_, close = F.col("open_price"), F.col("close_price")
    parts = F.col("buy_volume_taker") + F.col("sell_volume_maker")
    total = F.col("total_volume")
    return {
        "candle_start_time_not_null": F.col("candle_start_time").isNull(),
        "symbol_not_null": F.col("symbol").isNull(),
        "open_within_range": (open_ < low) | (open_ > high),
        "close_within_range": (close < low) | (close > high),
        "low_not_above_high": low > high,
        "volume_parts_within_total": parts > total + F.lit(_ROUNDING) * F.greatest(F.abs(total), F.lit(1.0)),
        "trade_count_positive": F.col("trade_count") < 1,
    }


def completeness_rules(column: str = "completeness_pct") -> dict[str, Column]:
    share = F.col(column)
    return {f"{column}_within_0_100": (share < 0) | (share > 100)}


def quality_report(
    df: DataFrame, rules: Mapping[str, Column], unique: Sequence[str] | None = None
) -> DataFrame:
    """One row per rule: ``rule``, ``failing_rows``, ``checked_rows``. All rules in one pass.

    ``unique`` adds a rule that counts the rows sharing their key with another. The rules are
    then summed per key first, so repeated keys shrink before the shuffle.
    """
    names = list(rules)
    fails = [F.sum(F.when(cond, 1).otherwise(0)).alias(f"_{i}") for i, cond in enumerate(rules.values())]
    if unique:
        per_key = df.groupBy(*unique).agg(F.count("*").alias("_rows"), *fails)
        repeated = F.sum(F.when(F.col("_rows") > 1, F.col("_rows")).otherwise(0))
        totals = per_key.agg(
            F.sum("_rows").alias("_rows"),
            *(F.sum(f"_{i}").alias(f"_{i}") for i in range(len(names))),
            repeated.alias(f"_{len(names)}"),
        )
        names.append("unique_" + "_".join(unique))
    else:
        totals = df.agg(F.count("*").alias("_rows"), *fails)

    def filled(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0)).cast("bigint")

    rows = [
        F.struct(F.lit(name).alias("rule"), filled(f"_{i}").alias("failing_rows"))
        for i, name in enumerate(names)
    ]
    return totals.select(
        F.explode(F.array(*rows)).alias("_r"), filled("_rows").alias("checked_rows")
    ).select("_r.rule", "_r.failing_rows", "checked_rows")
