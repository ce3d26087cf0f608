"""Watermarks by symbol, and health kept by day."""

from __future__ import annotations

from conftest import rows
from pyspark.sql import functions as F

from candlemill import schemas
from candlemill.operators import health
from candlemill.operators.candles import candles
from candlemill.operators.refine import add_partitions, bronze
from candlemill.session import streaming_session
from candlemill.sources.layers import DAY, stream_layer, write_layer
from candlemill.streaming import marks, rebuild

RECORD = "source string, symbol string, price double, quantity double, trade_time bigint, is_buyer_maker boolean, ingested_at string, rejected_value string"
START = 1_704_067_200_000  # 2024-01-01
HOUR = 3_600_000


def record(symbol, hour, price=1.0):
    return ("x", symbol, price, 1.0, START + int(hour * HOUR), True, "2024-01-01T00:00:00.000000", None)


def drain(spark, frame, path, *records):
    write_layer(bronze(frame(RECORD, *records)).select(*schemas.BRONZE.names), f"{path}/bronze", schemas.BRONZE_PARTITIONS)
    stream = stream_layer(streaming_session(spark), f"{path}/bronze", schemas.BRONZE)
    marks.run_silver_by_symbol(spark, stream, f"{path}/out", f"{path}/c").awaitTermination()


def test_one_symbol_ahead_makes_no_other_late(spark, frame, tmp_path):
    path = str(tmp_path)
    drain(spark, frame, path, record("fast", 90_000), record("slow", 5), record("slow", 6))
    assert marks.read_late(spark, f"{path}/out").count() == 0
    # slow's mark is 6: behind 5:50 is late, whatever the mark of fast. New symbols are on time.
    again = [record("slow", 6), record("slow", 5.9, 2), record("slow", 5.5, 3), record("slow", 30, 4), record("new", 1, 5)]
    drain(spark, frame, path, *again, record("fast", 2, 6), record(None, 1))
    late = marks.read_late(spark, f"{path}/out").orderBy("price")
    assert [(r.symbol, r.price, r.batch) for r in late.collect()] == [("slow", 3.0, 1), ("fast", 6.0, 1)]
    kept = marks.read_by_symbol(spark, f"{path}/out").orderBy("price", "trade_timestamp", "symbol")
    assert [(r.symbol, r.price) for r in kept.collect()] == [
        ("slow", 1.0), ("slow", 1.0), ("fast", 1.0), ("slow", 2.0), ("slow", 4.0), ("new", 5.0),
    ]
    now = {r.symbol: r.mark.timestamp() * 1000 for r in marks.symbol_marks(spark, f"{path}/out").collect()}
    assert now["slow"] == START + 30 * HOUR and set(now) == {"fast", "slow", "new"}
    # A repeated micro-batch starts from what was before it.
    assert {r.symbol for r in marks.symbol_marks(spark, f"{path}/out", before=1).collect()} == {"fast", "slow"}


def test_split_late_by_the_delay(frame):
    trades = frame("symbol string, trade_timestamp timestamp", ("a", "2024-01-01 00:50:00"), ("a", "2024-01-01 00:49:59"))
    known = frame("symbol string, mark timestamp", ("a", "2024-01-01 01:00:00"), ("b", None))
    on_time, late = marks.split_late(trades, known, "10 minutes")
    assert [r.trade_timestamp.second for r in on_time.collect()] == [0]
    assert [r.trade_timestamp.second for r in late.collect()] == [59]


def test_health_reads_the_touched_days_only(spark, frame, tmp_path, monkeypatch):
    schema = "symbol string, price double, quantity double, is_buyer_maker boolean, trade_timestamp timestamp, trade_id bigint"
    trades = frame(schema, *[("a", 1, 1, True, f"2024-01-0{d} 0{h}:00:00", d * 10 + h) for d in (1, 2, 3) for h in range(5)])
    path, session, read = str(tmp_path), streaming_session(spark), []
    whole = rebuild.of_days
    monkeypatch.setattr(rebuild, "of_days", lambda layer, days: read.append(whole(layer, days)) or read[-1])
    built = candles(trades, tie="trade_id")
    for number, days in enumerate(((1, 2, 3), (2,))):
        some = built if number == 0 else built.where("day(candle_start_time) = 2 AND hour(candle_start_time) < 2")
        by_day = add_partitions(some, "candle_start_time")
        write_layer(by_day, f"{path}/candles", DAY, replace_partitions=True)
        frame("year int, month int, day int", *[(2024, 1, d) for d in days]).write.parquet(f"{path}/days/run={number}")
        rebuild.hour_days(
            spark, f"{path}/days", f"{path}/candles", f"{path}/hours", f"{path}/c", stream=session
        ).awaitTermination()
    files = read[1].select(F.input_file_name()).distinct().collect()
    assert {f[0].split("/day=")[1][0] for f in files} == {"2"}
    plan = read[1]._jdf.queryExecution().executedPlan().toString()
    assert "make_date" in plan.split("PartitionFilters: [")[1].split("]")[0]
    kept = spark.read.parquet(f"{path}/hours").drop(*DAY)
    assert [r[1] for r in kept.groupBy(F.to_date("ingestion_hour").alias("d")).count().orderBy("d").collect()] == [5, 2, 5]
    full = spark.read.schema(schemas.CANDLES).parquet(f"{path}/candles").select(*schemas.CANDLES.names)
    report = health.health_from_hours(kept, "2024-01-04 00:00:00")
    want = health.ingestion_health(full, "2024-01-04 00:00:00")
    assert rows(report.select(*want.columns), "ingestion_hour") == rows(want, "ingestion_hour")
