from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from candlemill.functions.market import DEAD, FRESH, STALE
from candlemill.operators import health
from candlemill.sources.staging import stage

CANDLES = "symbol string, candle_start_time timestamp, trade_count bigint, total_volume double, ingested_at timestamp"
BUILT = "2024-01-03 00:00:00"


def hour_of(symbol, hour, minutes, trades=2):
    return [(symbol, f"2024-01-01 {hour:02d}:{m:02d}:00", trades, 1.5, BUILT) for m in range(minutes)]


@pytest.mark.parametrize(
    ("minutes", "share", "missing"), [(60, 100.0, 0), (59, 98.3, 1), (1, 1.7, 59), (30, 50.0, 30)]
)
def test_hourly_completeness(frame, minutes, share, missing):
    got = health.hourly_ingestion(frame(CANDLES, *hour_of("A", 5, minutes))).first()
    assert (got.candles_count, got.completeness_pct, got.missing_candles) == (minutes, share, missing)
    assert (got.total_trades, got.total_volume) == (2 * minutes, 1.5 * minutes)


def test_empty_hours(frame):
    df = frame(CANDLES, *hour_of("A", 1, 60), *hour_of("A", 4, 30), *hour_of("B", 2, 60))
    assert health.hourly_ingestion(df).count() == 3
    filled = health.hourly_ingestion(df, fill_gaps=True)
    hours = filled.select("symbol", F.hour("ingestion_hour"), "candles_count", "completeness_pct", "missing_candles")
    assert rows(hours, "symbol", "ingestion_hour") == [
        ("A", 1, 60, 100.0, 0),
        ("A", 2, 0, 0.0, 60),
        ("A", 3, 0, 0.0, 60),
        ("A", 4, 30, 50.0, 30),
        ("B", 2, 60, 100.0, 0),
    ]
    late = health.hourly_ingestion(
        frame(CANDLES, *hour_of("A", 23, 1), ("A", "2024-01-03 00:30:00", 1, 1, BUILT)), fill_gaps=True, stage=stage
    )
    assert late.count() == 26 and late.where("candles_count > 0").count() == 2
    until = health.hourly_ingestion(df, fill_gaps=True, until="2024-01-01 05:10:00")
    assert rows(until.groupBy("symbol").count(), "symbol") == [("A", 5), ("B", 4)]


@pytest.mark.parametrize(
    ("as_of", "minutes", "status"),
    [
        ("2024-01-01 00:05:00", 5.0, FRESH),
        ("2024-01-01 00:05:00.000001", 5.0, STALE),
        ("2024-01-01 00:30:00", 30.0, STALE),
        ("2024-01-01 00:30:01", 30.016667, DEAD),
        ("2023-12-31 23:59:00", -1.0, FRESH),
    ],
)
def test_freshness_bands(frame, as_of, minutes, status):
    df = frame(CANDLES, ("A", "2024-01-01 00:00:00", 1, 1, BUILT), ("A", "2023-12-31 00:00:00", 1, 1, BUILT))
    got = health.freshness(df, as_of).first()
    assert round(got.minutes_since_last_candle, 6) == minutes
    assert got.freshness_status == status


def test_symbol_without_times_is_dead(frame):
    assert health.freshness(frame(CANDLES, ("A", None, 1, 1, BUILT)), BUILT).first().freshness_status == DEAD


def test_daily(frame):
    df = frame(
        CANDLES,
        *hour_of("A", 1, 60),
        *hour_of("B", 2, 12, trades=None),
        (None, "2024-01-01 00:00:00", 5, 1, BUILT),
        (None, "2024-01-02 00:00:00", 5, 1, BUILT),
    )
    found = health.daily_summary(df).select(
        "total_candles", "active_symbols", "total_trades", "avg_trades_per_candle", "daily_completeness_pct"
    )
    assert rows(found, "date") == [(73, 2, 125, 125 / 61, 2.5), (1, 0, 5, 5.0, None)]


def test_report(frame):
    df = frame(CANDLES, *hour_of("A", 1, 60), *hour_of("A", 2, 30), *hour_of("B", 1, 6))
    for staged in (None, stage):
        report = health.ingestion_health(df, "2024-01-01 02:40:00", stage=staged)
        found = health.newest_hours_first(report).select(
            "symbol",
            F.hour("ingestion_hour"),
            "candles_count",
            "minutes_since_last_candle",
            "freshness_status",
            "day_total_candles",
            "day_active_symbols",
            "daily_completeness_pct",
        )
        assert rows(found) == [
            ("A", 2, 30, 11.0, STALE, 96, 2, 3.3),
            ("A", 1, 60, 11.0, STALE, 96, 2, 3.3),
            ("B", 1, 6, 95.0, DEAD, 96, 2, 3.3),
        ]
    assert len(report.columns) == 16


def test_roll_ups_equal_the_direct_forms(frame):
    df = frame(CANDLES, *hour_of("A", 1, 60), *hour_of("A", 2, 30), *hour_of("B", 1, 6))
    report = health.ingestion_health(df, BUILT)
    direct = health.freshness(df, BUILT).drop("latest_ingestion_time")
    assert report.select(*direct.columns).distinct().exceptAll(direct).count() == 0
    days = health.daily_summary(df).select("total_candles", "active_symbols", "daily_completeness_pct")
    rolled = report.select("day_total_candles", "day_active_symbols", "daily_completeness_pct").distinct()
    assert rows(rolled) == rows(days)


def test_staged_hours_are_read_not_rebuilt(frame):
    df = frame(CANDLES, *hour_of("A", 1, 60))
    plan = health.ingestion_health(df, BUILT, stage=stage)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 3
    assert "candle_start_time" not in plan
