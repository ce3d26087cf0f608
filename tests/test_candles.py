from __future__ import annotations

import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from candlemill.functions import price_ticks
from candlemill.operators.candles import candles, silver_order, width_micros

TRADES = (
    "symbol string, trade_timestamp timestamp, price double, quantity double, "
    "is_buyer_maker boolean, trade_id bigint"
)


def minute(df):
    return rows(df.withColumn("candle_start_time", F.col("candle_start_time").cast("string")), "candle_start_time", "symbol")


def test_one_candle(frame):
    df = frame(
        TRADES,
        ("A", "2024-01-01 00:00:59.999", 4, 1, False, 9),
        ("A", "2024-01-01 00:00:00", 2, 2, True, 5),
        ("A", "2024-01-01 00:00:30", 9, 4, None, 6),
        ("A", "2024-01-01 00:01:00", 7, 8, True, 1),
        ("A", None, 1000, 1, True, 1),
    )
    found = minute(candles(df, tie="trade_id", as_of="2024-02-01").drop("ingested_at"))
    assert found == [
        ("2024-01-01 00:00:00", "A", 2.0, 9.0, 2.0, 4.0, 7.0, 1.0, 2.0, 3),
        ("2024-01-01 00:01:00", "A", 7.0, 7.0, 7.0, 7.0, 8.0, 0.0, 8.0, 1),
    ]


@pytest.mark.parametrize("ids", [(1, 2, 3), (-5, 0, 5), (-(2**63), 0, 2**63 - 1)])
def test_equal_times_follow_the_tie(frame, ids):
    t = "2024-01-01 00:00:10.000001"
    df = frame(
        TRADES,
        ("A", t, 5, 1, True, ids[1]),
        ("A", t, 7, 1, True, ids[0]),
        ("A", t, 6, 1, True, ids[2]),
    )
    got = candles(df, tie="trade_id").first()
    assert (got.open_price, got.close_price) == (7.0, 6.0)


def test_a_later_time_beats_every_tie(frame):
    df = frame(
        TRADES,
        ("A", "2024-01-01 00:00:10.000001", 1, 1, True, 2**63 - 1),
        ("A", "2024-01-01 00:00:10.000002", 2, 1, True, -(2**63)),
        ("A", "1969-12-31 23:59:10.000001", 3, 1, True, 2**63 - 1),
        ("A", "1969-12-31 23:59:10.000002", 4, 1, True, None),
    )
    found = candles(df, tie="trade_id").orderBy("candle_start_time").collect()
    assert [(r.open_price, r.close_price) for r in found] == [(3.0, 4.0), (1.0, 2.0)]


def test_equal_times_follow_the_price(frame):
    t = "2024-01-01 00:00:10"
    df = frame(TRADES, *(("A", t, p, 1, True, None) for p in (5, 3.5, 9, 4)))
    for tie in (None, price_ticks("price")):
        got = candles(df, tie=tie).first()
        assert (got.open_price, got.close_price) == (3.5, 9.0)


def test_trades_without_price(frame):
    df = frame(
        TRADES,
        ("A", "2024-01-01 00:00:01", None, 1, True, 1),
        ("A", "2024-01-01 00:00:02", 5, 1, True, 2),
        ("A", "2024-01-01 00:00:03", None, 1, True, 3),
    )
    got = candles(df, tie="trade_id").first()
    assert (got.open_price, got.close_price, got.total_volume, got.trade_count) == (5.0, 5.0, 3.0, 3)


def test_latest_ingest(frame):
    df = frame(TRADES, ("A", "2024-01-01 00:00:01", 1, 1, True, 1)).withColumn(
        "ingest_timestamp", F.col("trade_timestamp") + F.expr("interval 5 seconds")
    )
    got = candles(df, ingest="ingest_timestamp", as_of="2024-02-01").first()
    assert (got.last_trade_ingest - got.candle_start_time).total_seconds() == 6


def test_empty(frame):
    assert candles(frame(TRADES)).count() == 0


def test_against_brute_force(frame):
    """A third of the trades in one symbol and minute; order and partitioning do not matter."""
    rng = random.Random(3)
    start = datetime(2024, 1, 1)
    data = []
    for i in range(900):
        hot = i % 3 == 0
        at = start + timedelta(milliseconds=rng.randrange(60_000 if hot else 600_000) // 500 * 500)
        data.append(("HOT" if hot else rng.choice("ABC"), at, round(rng.random() * 100, 2), float(rng.randrange(1, 9)), rng.random() < 0.5, i))
    groups = defaultdict(list)
    for row in data:
        groups[row[1].replace(second=0, microsecond=0), row[0]].append(row)
    want = []
    for (at, symbol), group in sorted(groups.items()):
        group.sort(key=lambda r: (r[1], r[5]))
        prices = [r[2] for r in group]
        want.append(
            (str(at), symbol, prices[0], max(prices), min(prices), prices[-1], sum(r[3] for r in group),
             sum(r[3] for r in group if not r[4]), sum(r[3] for r in group if r[4]), len(group))
        )
    for partitions in (1, 5):
        rng.shuffle(data)
        df = frame(TRADES, *data).repartition(partitions)
        assert minute(candles(df, tie="trade_id").drop("ingested_at")) == want


def test_integer_tie_hash_aggregates(frame):
    plan = candles(frame(TRADES), tie="trade_id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") == 2
    assert "SortAggregate" not in plan and "Sort " not in plan


def test_width():
    assert width_micros("1 minute") == 60_000_000
    assert width_micros("5 Minutes") == 300_000_000
    assert width_micros("1 day 2 hours") is None
    assert width_micros("a month") is None


WILD = (
    ("A", "2024-01-01 00:00:10.000001", 5, 1, True, 5),
    ("A", "2024-01-01 00:00:10.000001", 7, 1, True, -3),
    ("A", "2024-01-01 00:00:10.000001", 6e12, 1, True, 9),
    ("B", "1969-12-31 23:59:59.999999", 1, 1, True, 3),
    ("B", "1969-12-31 23:59:00", 2, 1, True, None),
    ("C", "55969-05-06 07:08:09.000001", 3, 1, True, 2),
    ("C", "55969-05-06 07:08:09", 4, 1, True, 2**63 - 1),
)


@pytest.mark.parametrize("width", ["1 minute", "5 minutes", "7 hours", "1 week"])
def test_one_ranking_for_every_width(frame, width):
    """Far times, microseconds and prices above the cap rank alike whatever the width."""
    built = candles(frame(TRADES, *WILD), width, tie="trade_id").select("symbol", "open_price", "close_price")
    assert rows(built, "symbol") == [("A", 7.0, 6e12), ("B", 2.0, 1.0), ("C", 4.0, 3.0)]
    built = candles(frame(TRADES, *WILD), width, **silver_order()).select("symbol", "open_price", "close_price")
    assert rows(built, "symbol") == [("A", 5.0, 6e12), ("B", 2.0, 1.0), ("C", 4.0, 3.0)]


def test_int_ties(frame):
    df = frame(
        TRADES.replace("trade_id bigint", "trade_id int"),
        ("A", "2024-01-01 00:00:10", 5, 1, True, 2**31 - 1),
        ("A", "2024-01-01 00:00:10", 6, 1, True, 0),
    )
    got = candles(df, tie="trade_id").first()
    assert (got.open_price, got.close_price) == (6.0, 5.0)


def test_silver_order_equals_the_exact_form(frame):
    rng = random.Random(5)
    data = [
        (rng.choice("AB"), f"2024-01-01 00:0{rng.randrange(3)}:{rng.randrange(60):02d}.{rng.choice(['000', '001', '999'])}",
         rng.choice([1e-8, 0.5, 999_999.99999999, 1_000_000.0, 12.25]), 1, True, None)
        for _ in range(500)
    ]
    df = frame(TRADES, *data)
    for width in ("1 minute", "1 hour"):
        fast = candles(df, width, **silver_order(), as_of="2024-02-01")
        exact = candles(df, width, as_of="2024-02-01")
        assert fast.exceptAll(exact).count() == 0 and fast.count() == exact.count()
