"""Partitioned parquet layers."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from candlemill.streaming.drain import start_drain

DAY = ["year", "month", "day"]


def in_days(start: date | None, end: date | None) -> Column:
    """Predicate on the year, month and day directories, both ends included."""
    day = F.make_date("year", "month", "day")
    keep = F.lit(True)
    if start is not None:
        keep = keep & (day >= F.lit(str(start)).cast("date"))
    if end is not None:
        keep = keep & (day <= F.lit(str(end)).cast("date"))
    return keep


def read_layer(
    spark: SparkSession,
    path: str,
    schema: StructType,
    start: date | None = None,
    end: date | None = None,
) -> DataFrame:
    """A layer, or the directories of some days of it."""
    df = spark.read.schema(schema).parquet(path)
    return df if start is None and end is None else df.where(in_days(start, end))


def of_days(layer: DataFrame, days: DataFrame) -> DataFrame:
    """All rows of the named days (year, month, day).

    Days go into the predicate as literals, so only their directories are listed and read. They
    are no more than the directories of a layer, which the driver lists anyway.
    """
    listed = [date(*row) for row in days.select(*DAY).distinct().sort(*DAY).collect()]
    return layer.where(F.make_date("year", "month", "day").isin(listed))


def stream_layer(
    spark: SparkSession, path: str, schema: StructType, max_files: int | None = None
) -> DataFrame:
    """A layer as a stream of its files. ``max_files`` bounds one micro-batch."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def write_layer(
    df: DataFrame,
    path: str,
    partitions: Sequence[str],
    replace_partitions: bool = False,
    max_records_per_file: int = 0,
) -> None:
    """Append to a layer, or replace exactly the partitions that ``df`` holds.

    Rows are brought together by partition, and adaptive execution splits a partition that is
    large over several tasks, so neither many small files nor one giant task results. Not for a
    folder that a stream writes: its readers go by the stream's log and would not see these files.
    """
    writer = df.hint("rebalance", *partitions).write.partitionBy(*partitions)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    if replace_partitions:
        writer = writer.option("partitionOverwriteMode", "dynamic").mode("overwrite")
    else:
        writer = writer.mode("append")
    writer.parquet(path)


def _files(spark: SparkSession, folder: str) -> set[str]:
    """Names of the files of a folder, none if it does not exist."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return {f.getPath().getName() for f in store.listStatus(path)} if store.exists(path) else set()


def replace_days(df: DataFrame, path: str, days: DataFrame) -> None:
    """Replace the named days of a layer by ``df``, which has rows of no other day.

    A day without rows has its directory removed: its old files are told from new ones by name.
    """
    spark = df.sparkSession
    listed = [tuple(row) for row in days.select(*DAY).distinct().collect()]
    folders = ["/".join([path, *(f"{name}={value}" for name, value in zip(DAY, day))]) for day in listed]
    before = {folder: _files(spark, folder) for folder in folders}
    write_layer(df, path, DAY, replace_partitions=True)
    for folder, files in before.items():
        if files and _files(spark, folder) == files:
            gone = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
            gone.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(gone, True)


def stream_to_layer(
    df: DataFrame,
    path: str,
    checkpoint: str,
    partitions: Sequence[str] = (),
    name: str | None = None,
    stateless: bool = False,
    files_per_partition: int = 0,
) -> StreamingQuery:
    """Append what is available to a layer and stop. Files are committed through the sink's log.

    Otherwise every task writes a file to each partition it has rows for. A ``stateless`` query
    has its rows brought together by partition, split adaptively where a partition is large. Spark
    does not adapt stateful queries; ``files_per_partition`` gathers their rows into at most that
    many files per partition and micro-batch.
    """
    if partitions and stateless:
        df = df.hint("rebalance", *partitions)
    elif partitions and files_per_partition:
        share = F.pmod(F.xxhash64(*df.columns), F.lit(files_per_partition))
        df = df.repartition(*partitions, share)
    writer = df.writeStream.format("parquet").option("path", path)
    if partitions:
        writer = writer.partitionBy(*partitions)
    return start_drain(writer, checkpoint, name)
