"""Days swapped in the catalog, and marts published at once."""

from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlemill.jobs import marts as marts_job
from candlemill.sources import swaps

SCHEMA = T.StructType(
    [T.StructField("symbol", T.StringType()), T.StructField("price", T.DoubleType())]
    + [T.StructField(name, T.IntegerType()) for name in ("year", "month", "day")]
)


@pytest.fixture
def days(frame):
    def of(*listed):
        return frame("year int, month int, day int", *[(2024, 1, d) for d in listed])

    return of


@pytest.fixture
def table(spark, tmp_path, request):
    name = f"swap_{abs(hash(request.node.name))}"
    swaps.create_day_table(spark, name, SCHEMA, f"{tmp_path}/none")
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def load(frame, *listed):
    return frame("symbol string, price double, year int, month int, day int", *[(s, p, 2024, 1, d) for s, p, d in listed])


def test_days_are_swapped(spark, frame, days, table, tmp_path):
    def read():
        return [(r.symbol, r.price, r.day) for r in spark.table(table).orderBy("day", "symbol").collect()]

    first = swaps.write_days(load(frame, ("a", 1, 1), ("a", 2, 2), ("b", 3, 2), ("a", 4, 3)), str(tmp_path))
    assert read() == []
    swaps.swap_days(spark, table, first, days(1, 2, 3))
    old = [("a", 1.0, 1), ("a", 2.0, 2), ("b", 3.0, 2), ("a", 4.0, 3)]
    assert read() == old
    # Day 2 anew, day 3 comes out empty, day 4 is new; day 1 is not named and stays.
    second = swaps.write_days(load(frame, ("c", 9, 2), ("c", 8, 4), ("z", 7, 1)), str(tmp_path))
    assert read() == old
    for _ in range(2):
        swaps.swap_days(spark, table, second, days(2, 3, 4))
        assert read() == [("a", 1.0, 1), ("c", 9.0, 2), ("c", 8.0, 4)]
    # Files of the old days are still there for readers that have planned on them.
    assert spark.read.parquet(first).count() == 4
    assert spark.table(table).where("day = 4").inputFiles()[0].count("/day=4/") == 1
    # An empty load empties its days.
    empty = swaps.write_days(load(frame).where("false"), str(tmp_path))
    swaps.swap_days(spark, table, empty, days(1, 4))
    assert read() == [("c", 9.0, 2)]


def test_a_failed_write_changes_nothing(spark, frame, days, table, tmp_path):
    good = swaps.write_days(load(frame, ("a", 1, 1)), str(tmp_path))
    swaps.swap_days(spark, table, good, days(1))
    bad = load(frame, ("b", 2, 1)).withColumn("price", F.raise_error(F.lit("no")).cast("double"))
    with pytest.raises(Exception, match="no"):
        swaps.swap_days(spark, table, swaps.write_days(bad, str(tmp_path)), days(1))
    assert [r.symbol for r in spark.table(table).collect()] == ["a"]


def test_marts_are_published_together(spark, frame, tmp_path):
    path = str(tmp_path)
    one, two = frame("x int", (1,)), frame("y string", ("a",))
    swaps.publish_marts({"m_one": one, "m_two": two}, path, 1)
    swaps.point_marts(spark, path, "m_one", "m_two")
    assert [rows(m) for m in swaps.read_marts(spark, path, "m_one", "m_two")] == [[(1,)], [("a",)]]
    # The second mart of version 2 fails: neither is published.
    broken = two.withColumn("y", F.raise_error(F.lit("no")).cast("string"))
    with pytest.raises(Exception, match="no"):
        swaps.publish_marts({"m_one": frame("x int", (2,)), "m_two": broken}, path, 2)
    assert swaps.published_version(spark, path) == 1
    assert [rows(m) for m in swaps.read_marts(spark, path, "m_one", "m_two")] == [[(1,)], [("a",)]]
    swaps.publish_marts({"m_one": frame("x int", (2,)), "m_two": frame("y string", ("b",))}, path, 2)
    swaps.point_marts(spark, path, "m_one", "m_two")
    assert rows(spark.table("m_one")) == [(2,)] and rows(spark.table("m_two")) == [("b",)]
    for name in ("m_one", "m_two"):
        spark.sql(f"DROP TABLE {name}")


def test_marts_job_publishes_a_version(spark, frame, tmp_path):
    candle = ("2024-01-01 00:00:00", "btcusdt", 1, 2, 1, 2, 3, 1, 2, 4, "2024-01-01 00:01:00")
    schema = (
        "candle_start_time timestamp, symbol string, open_price double, high_price double, low_price double, "
        "close_price double, total_volume double, buy_volume_taker double, sell_volume_maker double, "
        "trade_count bigint, ingested_at timestamp"
    )
    frame(schema, candle).write.parquet(f"{tmp_path}/candles")
    readings = frame("date date, fng_value int, fng_classification string, updated_at timestamp", ("2024-01-01", 40, "Fear", None))
    readings.write.parquet(f"{tmp_path}/sentiment")
    args = ["--candles", f"{tmp_path}/candles", "--sentiment", f"{tmp_path}/sentiment", "--out", f"{tmp_path}/marts"]
    for version in (1, 2):
        marts_job.main([*args, "--version", str(version), "--as-of", "2024-01-01 00:05:00"])
        assert swaps.published_version(spark, f"{tmp_path}/marts") == version
    assert spark.table("mart_market_overview").first().fng_value == 40
    assert "version=2" in spark.table("mart_daily_summary").inputFiles()[0]
    for name in ("market_overview", "hourly_ingestion", "ingestion_health", "daily_summary"):
        spark.sql(f"DROP TABLE IF EXISTS mart_{name}")
