from __future__ import annotations

import json
import random
from dataclasses import replace

import pytest
from conftest import rows
from pyspark.sql import functions as F

from candlemill import schemas
from candlemill.config import DEFAULTS
from candlemill.operators.candles import candles
from candlemill.operators.decode import decode_records
from candlemill.operators.refine import bronze, silver
from candlemill.session import streaming_session
from candlemill.sources.layers import read_layer, stream_layer
from candlemill.streaming.drain import input_rows, late_rows
from candlemill.streaming.rebuild import candle_days, silver_days
from candlemill.streaming.runs import current_candles, rejected, run_bronze, run_candles, run_silver

START = 1_704_067_200_000  # 2024-01-01
MINUTE = 60_000


def message(minute, symbol="A", price=1.0, quantity=1.0, maker=True):
    return json.dumps(
        {
            "source": "x",
            "symbol": symbol,
            "price": price,
            "quantity": quantity,
            "trade_time": START + int(minute * MINUTE),
            "is_buyer_maker": maker,
            "ingested_at": "2024-01-01T00:00:00",
        }
    )


class Lake:
    """Topic folder, layers and checkpoints of one test."""

    def __init__(self, spark, path, settings=DEFAULTS):
        self.spark, self.path, self.settings = spark, str(path), settings
        self.session = streaming_session(spark, 2)

    def send(self, *messages):
        df = self.spark.createDataFrame([("k", m) for m in messages], schemas.MESSAGE)
        df.coalesce(1).write.mode("append").parquet(f"{self.path}/topic")

    def bronze(self, **options):
        source = stream_layer(self.session, f"{self.path}/topic", schemas.MESSAGE)
        query = run_bronze(source, f"{self.path}/bronze", f"{self.path}/c/bronze", **options)
        query.awaitTermination()
        return query

    def silver(self, **options):
        query = run_silver(
            self.session,
            f"{self.path}/bronze",
            f"{self.path}/silver",
            f"{self.path}/c/silver",
            self.settings,
            as_of="2024-02-01",
            **options,
        )
        query.awaitTermination()
        return query

    def candles(self):
        query = run_candles(
            self.session,
            f"{self.path}/silver",
            f"{self.path}/candles",
            f"{self.path}/c/candles",
            self.settings,
            as_of="2024-02-01",
        )
        query.awaitTermination()
        return query

    def read(self, layer, schema):
        return read_layer(self.spark, f"{self.path}/{layer}", schema)

    def minutes(self):
        """Minute of every silver row."""
        stamp = F.unix_seconds("trade_timestamp") - START // 1000
        return sorted(r[0] for r in self.read("silver", schemas.SILVER).select((stamp / 60).cast("int")).collect())


@pytest.mark.parametrize("salts", [0, 4])
def test_duplicates_and_late_rows_over_two_runs(spark, tmp_path, salts):
    lake = Lake(spark, tmp_path, replace(DEFAULTS, dedup_salts=salts))
    lake.send(message(0), message(0), message(0, maker=False), message(60), message(60, price=2.0))
    lake.bronze()
    first = lake.silver()
    assert lake.minutes() == [0, 60, 60]
    assert late_rows(first) == 0

    # The watermark now stands at minute 50: minute 20 is late, minute 60 a copy, 55 and 61 are new.
    lake.send(message(20), message(60), message(55), message(61), message(61))
    lake.bronze()
    second = lake.silver()
    assert lake.minutes() == [0, 55, 60, 60, 61]
    assert late_rows(second) == 1

    # Nothing new: a third run reads and writes nothing.
    assert input_rows(lake.bronze()) == 0
    assert input_rows(lake.silver()) == 0
    assert lake.minutes() == [0, 55, 60, 60, 61]


def test_rejected_messages_stay_readable(spark, tmp_path):
    lake = Lake(spark, tmp_path)
    lake.send(message(0), "oops", "", "{}", '{"symbol":"A","price":1,"quantity":1}')
    lake.bronze()
    assert sorted(r[0] for r in rejected(spark, f"{tmp_path}/bronze").collect()) == ["", "oops", "{}"]
    assert lake.read("bronze", schemas.BRONZE).count() == 5
    lake.silver()
    assert lake.minutes() == [0]
    plan = rejected(spark, f"{tmp_path}/bronze")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnull(year" in plan


def test_bronze_layout(spark, tmp_path):
    lake = Lake(spark, tmp_path)
    lake.send(*(message(m) for m in range(0, 180, 10)))
    lake.send(*(message(m + 1) for m in range(0, 180, 10)))
    lake.bronze()
    files = sorted(str(p.relative_to(tmp_path / "bronze")) for p in tmp_path.glob("bronze/**/*.parquet"))
    assert [f.rsplit("/", 1)[0] for f in files] == [f"year=2024/month=1/day=1/hour={h}" for h in range(3)]


def test_bronze_without_gathering(spark, tmp_path):
    lake = Lake(spark, tmp_path)
    lake.send(*(message(m) for m in range(0, 120, 10)))
    lake.bronze(gather=False)
    assert lake.read("bronze", schemas.BRONZE).count() == 12


def test_files_per_day(spark, tmp_path):
    lake = Lake(spark, tmp_path)
    lake.send(*(message(m) for m in range(0, 2880, 7)))
    lake.bronze()
    lake.silver(files_per_day=1)
    assert len(list(tmp_path.glob("silver/**/*.parquet"))) == 2
    assert len(lake.minutes()) == len(range(0, 2880, 7))


def random_messages(n=400):
    rng = random.Random(11)
    found = [
        message(rng.randrange(240), rng.choice("ABC"), float(rng.randrange(1, 50)), float(rng.randrange(1, 9)), rng.random() < 0.5)
        for _ in range(n)
    ]
    # A third of all messages are copies of one trade.
    return found + [message(100, "HOT")] * (n // 2)


def test_stream_equals_batch_without_late_rows(spark, tmp_path):
    lake = Lake(spark, tmp_path, replace(DEFAULTS, dedup_salts=3))
    sent = random_messages()
    lake.send(*sent[::2])
    lake.send(*sent[1::2])
    lake.bronze()
    lake.silver()
    keys = ["symbol", "trade_timestamp", "price", "quantity", "trade_value", "is_large_trade"]
    streamed = lake.read("silver", schemas.SILVER).select(*keys)
    messages = spark.read.schema(schemas.MESSAGE).parquet(f"{tmp_path}/topic")
    batch = silver(bronze(decode_records(messages))).select(*keys)
    assert rows(streamed, *keys) == rows(batch, *keys)


def test_candle_stream_equals_batch_for_closed_windows(spark, tmp_path):
    lake = Lake(spark, tmp_path)
    lake.send(*random_messages())
    lake.bronze()
    lake.silver()
    lake.candles()
    trades = lake.read("silver", schemas.SILVER)
    batch = candles(trades, as_of="2024-02-01").cache()
    streamed = lake.read("candles", schemas.CANDLES).select(*schemas.CANDLES.names)
    edge = trades.agg(F.max("trade_timestamp")).first()[0]
    closed = batch.where(
        F.col("candle_start_time") + F.expr("interval 1 minute") <= F.lit(str(edge)).cast("timestamp") - F.expr("interval 10 minutes")
    )
    order = ["candle_start_time", "symbol"]
    assert rows(streamed, *order) == rows(closed, *order)
    assert 0 < streamed.count() < batch.count()
    # With the open windows they are complete.
    whole = current_candles(spark, f"{tmp_path}/silver", f"{tmp_path}/candles", as_of="2024-02-01")
    assert rows(whole, *order) == rows(batch, *order)

    # Later trades close the windows that were open.
    lake.send(message(400))
    lake.bronze()
    lake.silver()
    lake.candles()
    streamed = lake.read("candles", schemas.CANDLES).select(*schemas.CANDLES.names)
    assert rows(streamed, *order) == rows(batch, *order)


@pytest.mark.parametrize("max_files", [None, 1])
def test_days_lose_nothing(spark, tmp_path, max_files):
    """Newest trades first, one far in the future, late ones and copies in a second load."""
    lake = Lake(spark, tmp_path)
    day = 24 * 60
    loads = [
        [message(9 * day), message(day, "B"), message(4_000_000_000, "FAR")],
        [message(0), message(day + 1, price=3.0), message(day, "B"), message(day - 1), message(day - 1)],
    ]
    order = ["trade_timestamp", "symbol"]
    for load in loads:
        for one in load:
            lake.send(one)
        lake.bronze()
        silver_days(
            spark,
            f"{tmp_path}/bronze",
            f"{tmp_path}/silver",
            f"{tmp_path}/c/silver",
            f"{tmp_path}/days",
            as_of="2024-02-01",
            max_files=max_files,
        ).awaitTermination()
        candle_days(
            spark,
            f"{tmp_path}/days",
            f"{tmp_path}/silver",
            f"{tmp_path}/candles",
            f"{tmp_path}/c/candles",
            as_of="2024-02-01",
        ).awaitTermination()
    bronze_rows = lake.read("bronze", schemas.BRONZE)
    whole = silver(bronze_rows, as_of="2024-02-01").select(*schemas.SILVER.names)
    found = lake.read("silver", schemas.SILVER).withColumn("trade_timestamp", F.col("trade_timestamp").cast("string"))
    whole = whole.withColumn("trade_timestamp", F.col("trade_timestamp").cast("string"))
    assert rows(found, *order) == rows(whole, *order)
    assert found.count() == 6
    built = lake.read("candles", schemas.CANDLES)
    assert built.agg(F.sum("trade_count")).first()[0] == 6


def test_settings_stay_in_their_session(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    session = streaming_session(spark, 3)
    assert session.conf.get("spark.sql.shuffle.partitions") == "3"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
