"""Days rebuilt in batch from the layer below, as new files tell which ones changed.

A day is always built from all of its rows, so the result does not depend on the order, the age or
the number of files, and nothing is late. The days that a run has rebuilt are recorded after they
are written; the next layer reads that record as its own stream. So no clock decides what is new,
and a run that is repeated replaces what it wrote.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from candlemill import schemas
from candlemill.config import DEFAULTS, Settings
from candlemill.functions.times import AsOf
from candlemill.operators.candles import candles, silver_order
from candlemill.operators.health import hourly_ingestion
from candlemill.operators.refine import add_partitions, silver
from candlemill.sources.layers import DAY, of_days, read_layer, replace_days, stream_layer
from candlemill.sources.staging import drop_staged, new_folder
from candlemill.streaming.drain import start_drain

_DATED_CANDLES = T.StructType([*schemas.CANDLES.fields, *schemas.DAYS.fields])


def rebuild_days(
    spark: SparkSession,
    changes: DataFrame,
    build: Callable[[DataFrame], None],
    checkpoint: str,
    record: str | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Call ``build(days)`` with the distinct days of what is new in the stream ``changes``, and stop.

    ``spark`` runs the rebuild with its own settings: Spark turns adaptive execution off in the
    session of a micro-batch. Rows without a day are passed over.
    """

    def run(batch: DataFrame, number: int) -> None:
        path = new_folder(spark, "days")
        batch.select(*DAY).where("year IS NOT NULL").distinct().write.parquet(path)
        days = spark.read.schema(schemas.DAYS).parquet(path)
        build(days)
        if record:
            days.coalesce(1).write.mode("overwrite").parquet(f"{record}/run={number}")
        drop_staged(days)

    return start_drain(changes.writeStream.foreachBatch(run), checkpoint, name)


def silver_days(
    spark: SparkSession,
    bronze_path: str,
    path: str,
    checkpoint: str,
    record: str | None = None,
    settings: Settings = DEFAULTS,
    as_of: AsOf = None,
    max_files: int | None = None,
) -> StreamingQuery:
    """Silver of the days that new bronze files hold, each deduplicated over all its trades."""

    def build(days: DataFrame) -> None:
        trades = of_days(read_layer(spark, bronze_path, schemas.BRONZE), days)
        rows = silver(trades, settings, as_of).select(*schemas.SILVER.names)
        replace_days(rows, path, days)

    changes = stream_layer(spark, bronze_path, schemas.BRONZE, max_files)
    return rebuild_days(spark, changes, build, checkpoint, record, "silver_days")


def candle_days(
    spark: SparkSession,
    record: str,
    silver_path: str,
    path: str,
    checkpoint: str,
    settings: Settings = DEFAULTS,
    as_of: AsOf = None,
    done: str | None = None,
) -> StreamingQuery:
    """Candles of the days in the record of :func:`silver_days`. The width has to divide a day.

    The days are recorded in ``done`` in turn, if given.
    """

    def build(days: DataFrame) -> None:
        trades = of_days(read_layer(spark, silver_path, schemas.SILVER), days)
        built = candles(trades, settings.candle_width, **silver_order(), as_of=as_of)
        by_day = add_partitions(built, "candle_start_time")
        replace_days(by_day, path, days)

    changes = stream_layer(spark, f"{record}/*", schemas.DAYS)
    return rebuild_days(spark, changes, build, checkpoint, done, "candle_days")


def hour_days(
    spark: SparkSession,
    record: str,
    candle_path: str,
    path: str,
    checkpoint: str,
    per_hour: int = DEFAULTS.candles_per_hour,
    stream: SparkSession | None = None,
) -> StreamingQuery:
    """Hourly health rows, kept by day, of the days in the record of :func:`candle_days`.

    Only the candles of those days are read. ``stream`` is the session of the stream, if another.
    """

    def build(days: DataFrame) -> None:
        candles_ = of_days(read_layer(spark, candle_path, _DATED_CANDLES), days)
        by_day = add_partitions(hourly_ingestion(candles_, per_hour), "ingestion_hour")
        replace_days(by_day, path, days)

    changes = stream_layer(stream or spark, f"{record}/*", schemas.DAYS)
    return rebuild_days(spark, changes, build, checkpoint, name="hour_days")
