from __future__ import annotations

from conftest import rows
from pyspark.sql import functions as F

from candlemill.operators import quality

CANDLES = (
    "candle_start_time timestamp, symbol string, open_price double, high_price double, low_price double, "
    "close_price double, total_volume double, buy_volume_taker double, sell_volume_maker double, trade_count bigint"
)
GOOD = ("2024-01-01 00:00:00", "A", 2, 3, 1, 2, 10, 4, 6, 5)


def report(df, rules, unique=None):
    found = quality.quality_report(df, rules, unique).collect()
    return {r.rule: (r.failing_rows, r.checked_rows) for r in found}


def test_candle_rules(frame):
    df = frame(
        CANDLES,
        GOOD,
        ("2024-01-01 00:01:00", "A", 4, 3, 1, 0.5, 10, 4, 6, 0),
        ("2024-01-01 00:02:00", "A", 2, 1, 3, 2, 10, 4, 6.1, 5),
        (None, None, 2, 3, 1, 2, 10, 4, 6.000000001, 5),
        ("2024-01-01 00:00:00", "A", 2, 3, 1, 2, 10, 4, 6, 5),
        ("2024-01-01 00:00:00", "A", 2, 3, 1, 2, 10, 4, 6, 5),
    )
    found = report(df, quality.candle_rules(), quality.CANDLE_KEYS)
    assert {k: v[0] for k, v in found.items()} == {
        "candle_start_time_not_null": 1,
        "symbol_not_null": 1,
        "open_within_range": 2,
        "close_within_range": 2,
        "low_not_above_high": 1,
        "volume_parts_within_total": 1,
        "trade_count_positive": 1,
        "unique_candle_start_time_symbol": 3,
    }
    assert {v[1] for v in found.values()} == {6}


def test_empty_table(frame):
    found = report(frame(CANDLES), quality.candle_rules(), quality.CANDLE_KEYS)
    assert set(found.values()) == {(0, 0)} and len(found) == 8


def test_completeness(frame):
    df = frame("completeness_pct double", (0,), (100,), (100.1,), (-1,), (None,))
    assert report(df, quality.completeness_rules()) == {"completeness_pct_within_0_100": (2, 5)}


def test_one_pass(frame):
    plan = quality.quality_report(frame(CANDLES, GOOD), quality.candle_rules(), quality.CANDLE_KEYS)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Scan") == 1
    assert rows(plan.where(F.col("failing_rows") > 0)) == []
