"""Trades, messages, candles and sentiment read out of the ``events`` table.

An event is taken as a trade: type as symbol, value as price, ``props.k`` as quantity, the parity
of the user as maker flag. Dirt is added by expressions over every row, never by dropping rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlemill.functions import compute_once
from candlemill.operators.candles import candles

# Fixed moments, so that results do not depend on the clock.
BUILT_AT = "2024-02-01 00:00:00"
AS_OF = "2024-01-31 00:00:00"

# Upper bound (exclusive) and name of each sentiment class.
CLASSES = [(25, "Extreme Fear"), (45, "Fear"), (55, "Neutral"), (75, "Greed")]
TOP_CLASS = "Extreme Greed"

_LONG, _NUMBER, _TEXT, _TIME = T.LongType(), T.DoubleType(), T.StringType(), T.TimestampNTZType()


def _fields(**kinds: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in kinds.items()])


EVENTS = _fields(
    event_id=_LONG, ts=_TIME, user_id=_LONG, event_type=_TEXT, value=_NUMBER, props=_TEXT
)
LINEITEM = _fields(
    l_orderkey=_LONG,
    l_partkey=_LONG,
    l_suppkey=_LONG,
    l_linenumber=T.IntegerType(),
    l_quantity=_NUMBER,
    l_extendedprice=_NUMBER,
    l_discount=_NUMBER,
    l_tax=_NUMBER,
    l_returnflag=_TEXT,
    l_linestatus=_TEXT,
    l_shipdate=_TIME,
)


def size() -> Column:
    return F.get_json_object("props", "$.k").try_cast("int")


def table(spark: SparkSession, sf_dir: str, name: str, schema: T.StructType) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.schema(schema).parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events", EVENTS)


def sized_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with ``props.k`` as ``k``, for views that use it in many places."""
    return compute_once(events(spark, sf_dir), "k", size())


def naive(df: DataFrame) -> DataFrame:
    """Timestamps without zone, as the tables have them."""
    return df.select(
        *(
            F.col(f.name).cast("timestamp_ntz").alias(f.name)
            if f.dataType.typeName() == "timestamp"
            else F.col(f.name)
            for f in df.schema
        )
    )


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select(
        F.col("event_type").alias("symbol"),
        F.col("value").alias("price"),
        size().cast("double").alias("quantity"),
        (F.col("user_id") % 2 == 0).alias("is_buyer_maker"),
        F.col("ts").cast("timestamp").alias("trade_timestamp"),
        F.col("event_id").alias("trade_id"),
    )


def trade_candles(spark: SparkSession, sf_dir: str, width: str = "1 minute") -> DataFrame:
    return candles(trades(spark, sf_dir), width, tie="trade_id", as_of=BUILT_AT)


def dirty_candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candles with a fault in most minutes, another one in each of ten, and a completeness."""
    minute = F.minute("candle_start_time")
    fault, low, high = minute % 10, F.col("low_price"), F.col("high_price")
    hour = F.date_trunc("hour", "candle_start_time")
    return trade_candles(spark, sf_dir).withColumns(
        {
            "symbol": F.when(fault != 1, F.col("symbol")),
            "open_price": F.when(fault == 2, high + 1).otherwise(F.col("open_price")),
            "close_price": F.when(fault == 3, low - 1).otherwise(F.col("close_price")),
            "low_price": F.when(fault == 4, high + 1).otherwise(low),
            "buy_volume_taker": F.when(fault == 5, F.col("total_volume") + 1).otherwise(F.col("buy_volume_taker")),
            "trade_count": F.when(fault == 6, 0).otherwise(F.col("trade_count")),
            "completeness_pct": minute * 2.0,
            # Last, as the minute tells the fault: repeated keys, and no key.
            "candle_start_time": F.when(fault == 7, hour).when(fault != 8, F.col("candle_start_time")),
        }
    )


def pair_candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candles of currency pairs, some in upper case."""
    pair = F.concat("symbol", F.lit("usdt"))
    shouted = F.when(F.col("symbol").isin("view", "error"), F.upper(pair)).otherwise(pair)
    return trade_candles(spark, sf_dir).withColumn("symbol", shouted)


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat trade records with a text ingest time a few seconds after the trade."""
    ts = F.col("ts").cast("timestamp")
    ingested = F.timestamp_micros(F.unix_micros(ts) + size().cast("bigint") * F.lit(1_000_000))
    return events(spark, sf_dir).select(
        F.lit("exchange").alias("source"),
        F.col("event_type").alias("symbol"),
        F.col("value").alias("price"),
        size().cast("double").alias("quantity"),
        F.unix_millis(ts).alias("trade_time"),
        (F.col("user_id") % 2 == 0).alias("is_buyer_maker"),
        F.date_format(ingested, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("ingested_at"),
    )


def envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw exchange messages: some without data, some cut short, some with no number as price."""
    price = F.when(F.col("k") % 17 == 0, F.lit("n/a")).otherwise(F.col("value").cast("string"))
    body = F.to_json(
        F.struct(
            F.concat("event_type", F.lit("@trade")).alias("stream"),
            F.struct(
                F.col("event_type").alias("s"),
                price.alias("p"),
                F.col("k").cast("string").alias("q"),
                F.unix_millis(F.col("ts").cast("timestamp")).alias("T"),
                (F.col("user_id") % 2 == 0).alias("m"),
            ).alias("data"),
        )
    )
    whole = compute_once(sized_events(spark, sf_dir), "body", body)
    return whole.select(_broken(F.col("body")).alias("value"))


def _broken(body: Column) -> Column:
    k = F.col("k")
    return (
        F.when(k % 11 == 0, F.lit('{"stream":"status"}'))
        .when(k % 13 == 0, F.left(body, F.length(body) - 1))
        .otherwise(body)
    )


def dirty_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with NULLs, outliers and unusable numbers spread over all rows."""
    dirt = F.col("k") % 10
    none = F.lit(None)
    return sized_events(spark, sf_dir).select(
        F.when(dirt == 5, none).otherwise(F.col("event_type")).alias("symbol"),
        F.when(dirt == 0, none)
        .when(dirt == 1, -F.col("value"))
        .when(dirt == 2, F.col("value") * 10_000)
        .otherwise(F.col("value"))
        .alias("price"),
        F.when(dirt == 3, F.lit(0.0))
        .when(dirt == 4, F.lit(float("inf")))
        .when(dirt == 7, F.lit(float("nan")))
        .otherwise(F.col("k").cast("double") + 1)
        .alias("quantity"),
        F.when(dirt == 6, none).otherwise(F.unix_millis(F.col("ts").cast("timestamp"))).alias("trade_time"),
        "event_id",
    )


def sentiment_class(value: Column) -> Column:
    name = F.lit(TOP_CLASS)
    for limit, label in reversed(CLASSES):
        name = F.when(value < limit, F.lit(label)).otherwise(name)
    return name


def sentiment_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One reading per weekday, from the day's error count. Weekends have none."""
    value = (F.count_if(F.col("event_type") == "error") % 101).cast("int")
    return (
        events(spark, sf_dir)
        .groupBy(F.to_date("ts").alias("date"))
        .agg(value.alias("fng_value"))
        .where(F.weekday("date") < 5)
        .select(
            "date",
            "fng_value",
            sentiment_class(F.col("fng_value")).alias("fng_classification"),
            F.lit(None).cast("timestamp").alias("updated_at"),
        )
    )


def sentiment_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One payload text per day with the afternoon's reading first, then the morning's."""
    halves = (
        events(spark, sf_dir)
        .groupBy(F.to_date("ts").alias("date"))
        .agg(
            (F.count_if((F.col("event_type") == "purchase") & (F.hour("ts") >= 12)) % 101).alias("pm"),
            (F.count_if((F.col("event_type") == "purchase") & (F.hour("ts") < 12)) % 101).alias("am"),
        )
    )
    midnight = F.unix_seconds(F.col("date").cast("timestamp"))

    def reading(value: str, offset: int) -> Column:
        return F.struct(
            F.col(value).cast("string").alias("value"),
            sentiment_class(F.col(value)).alias("value_classification"),
            (midnight + offset).cast("string").alias("timestamp"),
        )

    data = F.array(reading("pm", 43_200), reading("am", 0)).alias("data")
    return halves.select("date", F.to_json(F.struct(data)).alias("value"))
