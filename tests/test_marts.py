from __future__ import annotations

import datetime as dt

from conftest import rows

from candlemill.functions import strip_quote
from candlemill.operators import marts

CANDLES = (
    "symbol string, candle_start_time timestamp, close_price double, high_price double, low_price double, "
    "total_volume double, buy_volume_taker double, sell_volume_maker double, trade_count bigint"
)
DATA = [
    ("btcusdt", "2024-01-01 00:00:00", 10, 12, 9, 1, 1, 0, 3),
    ("BTCUSDT", "2024-01-01 23:59:00", 20, 22, 8, 2, 0, 2, 4),
    ("btcusdt", "2024-01-02 00:00:00", 30, 30, 30, 4, 0, 0, 5),
    ("ethusdt", "2024-01-01 00:00:00", 1, 1, 1, 1, 1, 0, 1),
]


def test_daily_prices(frame):
    df = frame(CANDLES, *DATA)
    assert rows(marts.daily_prices(df, ["BtcUsdt"]), "date") == [
        (dt.date(2024, 1, 1), "BTC", 15.0, 22.0, 8.0, 3.0),
        (dt.date(2024, 1, 2), "BTC", 30.0, 30.0, 30.0, 4.0),
    ]
    assert marts.daily_prices(df).count() == 3
    assert marts.daily_prices(df, ["solusdt"]).count() == 0


def test_strip_quote_takes_the_suffix_only(frame):
    df = frame("symbol string", ("usdtusdt",), ("btceur",), ("a.b",))
    assert rows(df.select(strip_quote("symbol")), "symbol") == [("A.B",), ("BTCEUR",), ("USDT",)]
    assert rows(df.select(strip_quote("symbol", ".b")), "symbol") == [("A",), ("BTCEUR",), ("USDTUSDT",)]


def test_sentiment_is_optional(frame):
    sentiment = frame(
        "date date, fng_value int, fng_classification string, updated_at timestamp", ("2024-01-01", 40, "Fear", None)
    )
    daily = marts.daily_prices(frame(CANDLES, *DATA), ["btcusdt"])
    mart = marts.newest_days_first(marts.price_vs_sentiment(daily, sentiment))
    assert [(r.date.day, r.fng_value, r.fng_classification) for r in mart.collect()] == [
        (2, None, None),
        (1, 40, "Fear"),
    ]


def test_charts(frame):
    df = frame(CANDLES, *DATA)
    assert marts.close_series(df).count() == 4
    assert rows(marts.volume_by_symbol(df), "symbol") == [("BTCUSDT", 2.0), ("btcusdt", 5.0), ("ethusdt", 1.0)]
    assert [r[2:] for r in rows(marts.pressure(df), "symbol", "hour")] == [
        (0.0, 2.0, 0.0),
        (1.0, 0.0, 1.0),
        (0.0, 0.0, None),
        (1.0, 0.0, 1.0),
    ]
    assert rows(marts.activity_heatmap(df), "hour_of_day", "symbol") == [
        (0, "btcusdt", 8),
        (0, "ethusdt", 1),
        (23, "BTCUSDT", 4),
    ]
