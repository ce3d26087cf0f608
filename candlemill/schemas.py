"""Declared schema of every layer. Nothing is inferred from data; every field may be NULL."""

from __future__ import annotations

from pyspark.sql import types as T

TEXT, NUMBER, LONG, INT = T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType()
FLAG, TIME, DAY = T.BooleanType(), T.TimestampType(), T.DateType()


def _schema(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


# Raw exchange message. Prices arrive as text.
ENVELOPE = _schema(stream=TEXT, data=_schema(s=TEXT, p=TEXT, q=TEXT, T=LONG, m=FLAG))

MESSAGE = _schema(key=TEXT, value=TEXT)

_RECORD = {
    "source": TEXT,
    "symbol": TEXT,
    "price": NUMBER,
    "quantity": NUMBER,
    "trade_time": LONG,  # epoch milliseconds
    "is_buyer_maker": FLAG,
    "ingested_at": TEXT,
}

# Flat trade record carried by the topic.
RECORD = _schema(**_RECORD)

# The record, the text of an undecodable message, event time and partitions.
BRONZE_PARTITIONS = ["year", "month", "day", "hour"]
BRONZE = _schema(
    **_RECORD, rejected_value=TEXT, timestamp=TIME, **dict.fromkeys(BRONZE_PARTITIONS, INT)
)

SILVER_PARTITIONS = ["year", "month", "day"]
SILVER = _schema(
    source=TEXT,
    symbol=TEXT,
    price=NUMBER,
    quantity=NUMBER,
    is_buyer_maker=FLAG,
    trade_timestamp=TIME,
    ingest_timestamp=TIME,
    trade_value=NUMBER,
    trade_side=TEXT,
    price_magnitude=NUMBER,
    is_large_trade=FLAG,
    processed_at=TIME,
    **dict.fromkeys(SILVER_PARTITIONS, INT),
)

# Days that a run has rebuilt.
DAYS = _schema(**dict.fromkeys(SILVER_PARTITIONS, INT))

CANDLES = _schema(
    candle_start_time=TIME,
    symbol=TEXT,
    open_price=NUMBER,
    high_price=NUMBER,
    low_price=NUMBER,
    close_price=NUMBER,
    total_volume=NUMBER,
    buy_volume_taker=NUMBER,
    sell_volume_maker=NUMBER,
    trade_count=LONG,
    ingested_at=TIME,
)

# Body of one sentiment payload. Numbers arrive as text.
SENTIMENT_PAYLOAD = _schema(
    data=T.ArrayType(_schema(value=TEXT, value_classification=TEXT, timestamp=TEXT))
)

SENTIMENT = _schema(date=DAY, fng_value=INT, fng_classification=TEXT, updated_at=TIME)

HISTORY = _schema(
    symbol=TEXT,
    price=NUMBER,
    quantity=NUMBER,
    is_buyer_maker=FLAG,
    trade_timestamp=TIME,
    ingest_timestamp=TIME,
)
