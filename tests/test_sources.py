from __future__ import annotations

from datetime import datetime
from types import SimpleNamespace
from unittest.mock import MagicMock

import pytest
from conftest import rows
from pyspark.sql import functions as F

from candlemill import schemas
from candlemill.operators import history, refine
from candlemill.sources import layers, staging, topic, warehouse

SILVER = "symbol string, price double, quantity double, is_buyer_maker boolean, trade_timestamp timestamp, ingest_timestamp timestamp"


def trades(frame, *stamps, price=1):
    df = frame(SILVER, *(("A", price, 1, True, s, None) for s in stamps))
    return refine.add_partitions(df, "trade_timestamp")


DAYS = ("2024-01-31 10:00:00", "2024-02-01 00:00:00", "2024-02-01 23:59:59.999", "2024-02-02 00:00:00")




def test_day_range_prunes_partitions(spark, frame, tmp_path):
    df = trades(frame, *DAYS)
    path = str(tmp_path / "silver")
    layers.write_layer(df, path, schemas.SILVER_PARTITIONS)
    assert layers.read_layer(spark, path, df.schema).count() == 4
    day = layers.read_layer(spark, path, df.schema, "2024-02-01", "2024-02-01")
    assert day.count() == 2
    assert layers.read_layer(spark, path, df.schema, start="2024-02-01").count() == 3
    plan = day._jdf.queryExecution().executedPlan().toString()
    pruned = plan.split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert ">= 2024-02-01" in pruned and "<= 2024-02-01" in pruned


def test_of_days(spark, frame, tmp_path):
    path = str(tmp_path / "silver")
    layers.write_layer(trades(frame, *DAYS), path, schemas.SILVER_PARTITIONS)
    layer = layers.read_layer(spark, path, trades(frame, *DAYS).schema)
    days = layer.where("day = 1 AND month = 2").select(*layers.DAY)
    found = layers.of_days(layer, days)
    assert {(r.year, r.month, r.day) for r in found.collect()} == {(2024, 2, 1)}
    plan = found._jdf.queryExecution().executedPlan().toString()
    pruned = plan.split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert "2024-02-01" in pruned and "dynamicpruning" not in pruned
    assert layers.of_days(layer, days.where("false")).count() == 0


def test_replacing_partitions_leaves_the_others(spark, frame, tmp_path):
    path = str(tmp_path / "silver")
    layers.write_layer(trades(frame, *DAYS), path, schemas.SILVER_PARTITIONS)
    for _ in range(2):
        layers.write_layer(
            trades(frame, DAYS[1], price=9), path, schemas.SILVER_PARTITIONS, replace_partitions=True
        )
    found = layers.read_layer(spark, path, trades(frame).schema).select("price", "day")
    assert rows(found, "price", "day") == [(1.0, 2), (1.0, 31), (9.0, 1)]


def test_appending_and_file_size(spark, frame, tmp_path):
    path = tmp_path / "silver"
    df = trades(frame, *[DAYS[1]] * 10)
    layers.write_layer(df, str(path), schemas.SILVER_PARTITIONS, max_records_per_file=4)
    layers.write_layer(df, str(path), schemas.SILVER_PARTITIONS)
    assert len(list(path.glob("**/*.parquet"))) == 4
    assert spark.read.parquet(str(path)).count() == 20


def test_concat_fills_missing_columns(frame):
    a = frame("symbol string, price double", ("A", 1))
    b = frame("price double", (2,))
    assert rows(history.concat_frames([a, b, b]), "price") == [("A", 1.0), (None, 2.0), (None, 2.0)]


def test_history_hour_is_replaced_not_repeated(spark, frame, tmp_path):
    stamps = ["2024-01-01 05:00:00", "2024-01-01 05:59:59.999", "2024-01-01 06:00:00", "2024-01-02 05:00:00"]
    df, path = trades(frame, *stamps), str(tmp_path / "history")
    hour = datetime(2024, 1, 1, 5, 30)
    for _ in range(2):
        layers.write_layer(history.history_slice(df, hour), path, history.SLICE_PARTITIONS, True)
    assert spark.read.parquet(path).count() == 2
    empty = history.history_slice(df, datetime(2024, 1, 3))
    layers.write_layer(empty, path, history.SLICE_PARTITIONS, True)
    assert spark.read.parquet(path).count() == 2
    layers.write_layer(history.history_slice(df), path, history.SLICE_PARTITIONS, True)
    back = history.history_columns(spark.read.parquet(path))
    assert back.count() == 4 and back.columns == schemas.HISTORY.names


def test_history_hour_in_another_zone(frame):
    df = trades(frame, "2024-01-31 22:30:00", "2024-02-01 00:30:00")
    hour = datetime.fromisoformat("2024-02-01T00:10:00+02:00")
    assert [r.trade_hour for r in history.history_slice(df, hour).collect()] == [22]


def test_history_hour_prunes_partitions(spark, frame, tmp_path):
    path = str(tmp_path / "silver")
    df = trades(frame, *DAYS)
    layers.write_layer(df, path, schemas.SILVER_PARTITIONS)
    hour = history.history_slice(layers.read_layer(spark, path, df.schema), datetime(2024, 2, 1, 23))
    assert hour.count() == 1
    scan = hour._jdf.queryExecution().executedPlan().toString()
    assert "(day" in scan.split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert "GreaterThanOrEqual(trade_timestamp" in scan


def test_clean_filters_reach_the_scan(spark, frame, tmp_path):
    path = str(tmp_path / "bronze")
    frame("symbol string, price double, quantity double, trade_time bigint", ("A", 1, 1, 1)).write.parquet(path)
    plan = refine.clean_trades(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    pushed = plan.split("PushedFilters:")[1].split("ReadSchema")[0]
    for part in ("IsNotNull(symbol)", "IsNotNull(trade_time)", "GreaterThan(price,0.0)", "LessThan(price,1000000.0)"):
        assert part in pushed


def test_stage_reads_back(spark, frame):
    df = frame("a int, b string", (1, "x"), (None, None))
    staged = staging.stage(df)
    assert staged.schema == df.schema
    assert rows(staged, "a") == [(None, None), (1, "x")]
    assert staging.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def session_like(master, folder=None, warehouse=None):
    settings = {staging.CHECKPOINT_DIR: folder, staging.WAREHOUSE_DIR: warehouse}
    conf = SimpleNamespace(get=lambda key, default=None: settings[key] or default)
    context = SimpleNamespace(master=master, getConf=lambda: conf)
    return SimpleNamespace(sparkContext=context, conf=conf)


def test_shared_folder_is_required_on_a_cluster():
    assert staging.shared_folder(session_like("yarn", "hdfs:///tmp/x/")) == "hdfs:///tmp/x"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        staging.shared_folder(session_like("yarn"))
    assert staging.shared_folder(session_like("local[2]", warehouse="/w/")) == "/w/_staged"


def test_topic_options():
    assert topic.topic_options("h:1", "t") == {
        "kafka.bootstrap.servers": "h:1",
        "subscribe": "t",
        "startingOffsets": "earliest",
        "failOnDataLoss": "true",
    }
    more = topic.topic_options("h:1", "t", fail_on_data_loss=False, min_partitions=64, max_offsets=10)
    assert (more["failOnDataLoss"], more["minPartitions"], more["maxOffsetsPerTrigger"]) == ("false", "64", "10")


def test_topic_wiring():
    spark, messages = MagicMock(), MagicMock()
    topic.read_topic(spark, "h:1", "t", min_partitions=8)
    reader = spark.readStream.format
    reader.assert_called_with("kafka")
    assert reader.return_value.options.call_args.kwargs["minPartitions"] == "8"

    topic.stream_to_topic(messages, "h:1", "/c", "t")
    writer = messages.writeStream.format
    writer.assert_called_with("kafka")
    assert writer.return_value.options.call_args.kwargs == {"kafka.bootstrap.servers": "h:1", "topic": "t"}
    started = writer.return_value.options.return_value.outputMode
    started.assert_called_with("append")
    started.return_value.option.assert_called_with("checkpointLocation", "/c")


def test_jdbc_wiring():
    df, spark = MagicMock(), MagicMock()
    warehouse.write_warehouse(df, "jdbc:x", "t", user="u")
    df.write.format.assert_called_with("jdbc")
    assert df.write.format.return_value.options.call_args.kwargs["truncate"] == "true"
    df.write.format.return_value.options.return_value.mode.assert_called_with("overwrite")
    warehouse.read_warehouse(spark, "jdbc:x", "t")
    assert spark.read.format.return_value.options.call_args.kwargs == {"url": "jdbc:x", "dbtable": "t"}


def test_jdbc_options():
    options = warehouse.jdbc_options("jdbc:x", "t", connections=4, driver="d")
    assert options == {
        "url": "jdbc:x",
        "dbtable": "t",
        "numPartitions": "4",
        "batchsize": "10000",
        "truncate": "true",
        "driver": "d",
    }
    assert "partitionColumn" not in warehouse.read_options("jdbc:x", "t")
    split = warehouse.read_options("jdbc:x", "t", "candle_start_time", "2024-01-01", "2025-01-01", 16)
    assert (split["partitionColumn"], split["numPartitions"]) == ("candle_start_time", "16")
    with pytest.raises(ValueError, match="bounds"):
        warehouse.read_options("jdbc:x", "t", "candle_start_time")


def test_mart_is_rebuilt(spark, frame, tmp_path):
    path = str(tmp_path / "mart")
    for value in (1, 2):
        warehouse.write_mart(frame("a int", (value,)), "mart_rebuilt", path)
    assert rows(warehouse.read_table(spark, "mart_rebuilt")) == [(2,)]
    assert spark.read.parquet(path).select(F.sum("a")).first()[0] == 2


def test_a_day_that_comes_out_empty_goes(spark, frame, tmp_path):
    path, schema = str(tmp_path / "layer"), "x int, year int, month int, day int"
    layers.write_layer(frame(schema, *[(d, 2024, 1, d) for d in (1, 2, 3)]), path, layers.DAY)
    days = frame("year int, month int, day int", (2024, 1, 2), (2024, 1, 3), (2024, 1, 4))
    layers.replace_days(frame(schema, (30, 2024, 1, 3)), path, days)
    assert sorted(r.x for r in spark.read.parquet(path).collect()) == [1, 30]
    layers.replace_days(frame(schema).where("false"), path, days)
    assert [r.x for r in spark.read.parquet(path).collect()] == [1]
