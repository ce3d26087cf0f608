"""Silver by a watermark of each symbol's own, with late trades kept.

The highest event time of each symbol is a small table, written with every micro-batch. A trade
further behind its symbol's mark than the delay goes to a layer of late trades instead of silver,
so a symbol that is far ahead, or has a wrong clock, makes no other one late, and nothing is lost.

Every micro-batch writes folders of its own number: one that is repeated replaces what it wrote
and starts from the marks and the silver of those before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from candlemill import schemas
from candlemill.config import DEFAULTS, Settings
from candlemill.functions.times import AsOf
from candlemill.operators.refine import DEDUP_KEYS, silver
from candlemill.sources.layers import DAY, of_days
from candlemill.sources.staging import drop_staged, new_folder
from candlemill.streaming.drain import start_drain

MARKS = "symbol string, mark timestamp"


def _batches(spark: SparkSession, path: str, schema, before: int | None = None) -> DataFrame:
    """Rows of the micro-batches below ``path``, or of those before a number."""
    fields = schema if isinstance(schema, str) else ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    rows = spark.read.schema(f"{fields}, batch long").parquet(path)
    return rows if before is None else rows.where(F.col("batch") < before)


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def symbol_marks(spark: SparkSession, path: str, before: int | None = None) -> DataFrame:
    """(symbol, mark): the highest event time of each symbol, as of the last micro-batch (before a number)."""
    if not _exists(spark, f"{path}/marks"):
        return spark.createDataFrame([], MARKS)
    # Each micro-batch writes all marks; an older one never has a higher mark.
    rows = _batches(spark, f"{path}/marks", MARKS, before)
    return rows.groupBy("symbol").agg(F.max("mark").alias("mark"))


def split_late(trades: DataFrame, marks: DataFrame, delay: str) -> tuple[DataFrame, DataFrame]:
    """Trades on time, and those more than ``delay`` behind the mark of their symbol.

    A symbol without a mark is on time. No broadcast hint: marks grow with the symbols.
    """
    marked = trades.join(marks, "symbol", "left")
    late = F.coalesce(F.col("trade_timestamp") < F.col("mark") - F.expr(f"interval {delay}"), F.lit(False))
    return marked.where(~late).drop("mark"), marked.where(late)


def run_silver_by_symbol(
    spark: SparkSession,
    bronze: DataFrame,
    path: str,
    checkpoint: str,
    settings: Settings = DEFAULTS,
    as_of: AsOf = None,
) -> StreamingQuery:
    """The ``bronze`` stream to ``path/silver``, late trades to ``path/late``, marks to ``path/marks``.

    Trades are deduplicated within the micro-batch and against the silver of its days. ``spark``
    runs the micro-batches with its own settings.
    """

    def run(batch: DataFrame, number: int) -> None:
        staged = new_folder(spark, "batch")
        batch.write.parquet(staged)
        rows = silver(spark.read.schema(batch.schema).parquet(staged), settings, as_of).select(*schemas.SILVER.names)
        old = symbol_marks(spark, path, number)
        on_time, late = split_late(rows, old, settings.watermark)
        if number and _exists(spark, f"{path}/silver"):
            before = _batches(spark, f"{path}/silver", schemas.SILVER, number)
            before = of_days(before, on_time).select(*DEDUP_KEYS)
            on_time = on_time.join(before, list(DEDUP_KEYS), "left_anti")
        for name, part in (("silver", on_time), ("late", late)):
            dealt = part.hint("rebalance", *DAY)
            dealt.write.mode("overwrite").partitionBy(*DAY).parquet(f"{path}/{name}/batch={number}")
        highest = rows.groupBy("symbol").agg(F.max("trade_timestamp").alias("mark"))
        marks = old.unionByName(highest).groupBy("symbol").agg(F.max("mark").alias("mark"))
        # The last write of the micro-batch.
        marks.coalesce(1).write.mode("overwrite").parquet(f"{path}/marks/batch={number}")
        drop_staged(spark.read.schema(batch.schema).parquet(staged))

    return start_drain(bronze.writeStream.foreachBatch(run), checkpoint, "silver_by_symbol")


def read_by_symbol(spark: SparkSession, path: str) -> DataFrame:
    """Silver of all micro-batches."""
    return _batches(spark, f"{path}/silver", schemas.SILVER).drop("batch")


def read_late(spark: SparkSession, path: str) -> DataFrame:
    """Late trades with the mark they were behind, and the number of their micro-batch."""
    fields = [*schemas.SILVER.fields]
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    return _batches(spark, f"{path}/late", f"{ddl}, mark timestamp")
