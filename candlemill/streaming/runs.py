"""The streaming runs of the layers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from candlemill import schemas
from candlemill.config import DEFAULTS, Settings
from candlemill.functions.times import AsOf
from candlemill.operators.candles import candles, silver_order
from candlemill.operators.decode import decode_records
from candlemill.operators.refine import add_partitions, bronze, silver
from candlemill.sources.layers import read_layer, stream_layer, stream_to_layer


def run_bronze(
    messages: DataFrame, path: str, checkpoint: str, gather: bool = True
) -> StreamingQuery:
    """Messages with a ``value`` column to the bronze layer.

    Messages that decode to nothing land in the NULL partition with their text in
    ``rejected_value``: one query and one parse serve both, and silver passes over them.

    Rows are gathered by hour, which costs a shuffle. Turn ``gather`` off where every task reads
    messages of few hours anyway, as from a topic that is drained often.
    """
    return stream_to_layer(
        bronze(decode_records(messages)),
        path,
        checkpoint,
        schemas.BRONZE_PARTITIONS,
        "bronze",
        stateless=gather,
    )


def rejected(spark: SparkSession, bronze_path: str) -> DataFrame:
    """Texts of undecodable messages. Reads the NULL partition only."""
    layer = spark.read.schema(schemas.BRONZE).parquet(bronze_path)
    return layer.where(F.col("year").isNull() & F.col("rejected_value").isNotNull()).select(
        "rejected_value"
    )


def run_silver(
    spark: SparkSession,
    bronze_path: str,
    path: str,
    checkpoint: str,
    settings: Settings = DEFAULTS,
    as_of: AsOf = None,
    files_per_day: int = 0,
) -> StreamingQuery:
    """New bronze files to the silver layer, by a watermark: trades behind it are dropped and counted.

    All new files are one micro-batch, because a split one would make the rest late.
    :func:`candlemill.streaming.rebuild.silver_days` drops nothing.
    """
    trades = stream_layer(spark, bronze_path, schemas.BRONZE)
    return stream_to_layer(
        silver(trades, settings, as_of).select(*schemas.SILVER.names),
        path,
        checkpoint,
        schemas.SILVER_PARTITIONS,
        "silver",
        files_per_partition=files_per_day,
    )


def run_candles(
    spark: SparkSession,
    silver_path: str,
    path: str,
    checkpoint: str,
    settings: Settings = DEFAULTS,
    as_of: AsOf = None,
) -> StreamingQuery:
    """Candles of the windows that the watermark has closed, by day. The newest stay open until
    later trades arrive; :func:`current_candles` adds them."""
    trades = stream_layer(spark, silver_path, schemas.SILVER).withWatermark(
        "trade_timestamp", settings.watermark
    )
    built = candles(trades, settings.candle_width, **silver_order(), as_of=as_of)
    by_day = add_partitions(built, "candle_start_time")
    return stream_to_layer(by_day, path, checkpoint, schemas.SILVER_PARTITIONS, "candles", files_per_partition=1)


def current_candles(
    spark: SparkSession, silver_path: str, path: str, settings: Settings = DEFAULTS, as_of: AsOf = None
) -> DataFrame:
    """Candles that :func:`run_candles` wrote and those of the windows still open, from their trades.

    The watermark is one for all symbols and closes windows in order, so the open ones are those
    that start after every written one. Only the days from there on are read.
    """
    closed = spark.read.schema(schemas.CANDLES).parquet(path).select(*schemas.CANDLES.names)
    edge = closed.agg(F.max("candle_start_time").cast("string")).first()[0]
    trades = read_layer(spark, silver_path, schemas.SILVER, edge and edge[:10])
    if edge:
        start = F.window("trade_timestamp", settings.candle_width)["start"]
        edge = F.lit(edge).cast("timestamp")
        trades = trades.where(F.col("trade_timestamp") > edge).withColumn("_start", start)
        trades = trades.where(F.col("_start") > edge).drop("_start")
    return closed.unionByName(candles(trades, settings.candle_width, **silver_order(), as_of=as_of))
