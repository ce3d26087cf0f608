"""Message decoding: exchange envelopes, trade records and sentiment payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlemill.functions import as_timestamp, compute_once
from candlemill.functions.times import AsOf, second_time
from candlemill.schemas import ENVELOPE, RECORD, SENTIMENT_PAYLOAD

SKIPPED = "no data"


def normalise_envelope(
    df: DataFrame, value: str = "value", source: str = "exchange", as_of: AsOf = None
) -> DataFrame:
    """Flat trade records plus ``reject_reason``, NULL on good rows.

    A message without ``data`` is not an error and carries the reason ``no data``. The text of a
    message that is no good record stays in ``rejected_value``. A ``data`` object must have all
    five fields and numeric price and quantity; a NULL symbol, time or flag passes through.
    """
    text = F.col("_text")
    data = F.col("_parsed.data")
    price = _number(F.col("_parsed.data.p"))
    quantity = _number(F.col("_parsed.data.q"))

    # The key listings re-read the text, so they are reached only by rows that lack something.
    top_keys = F.json_object_keys(text)
    data_keys = F.json_object_keys(F.get_json_object(text, "$.data"))
    is_array = F.get_json_object(text, "$[*]").isNotNull() | (
        F.regexp_replace(text, r"\s", "") == "[]"
    )
    has_all = F.array_size(F.array_intersect(data_keys, F.array(*map(F.lit, "sTm")))) == 3
    reason = (
        F.when(
            data.isNull(),
            F.when(top_keys.isNull() & ~F.coalesce(is_array, F.lit(False)), "malformed")
            .when(F.array_contains(top_keys, "data"), "data is not an object")
            .otherwise(SKIPPED),
        )
        .when(price.isNull(), "price is not a number")
        .when(quantity.isNull(), "quantity is not a number")
        .when(
            (F.col("_parsed.data.s").isNull() | F.col("_parsed.data.T").isNull()
             | F.col("_parsed.data.m").isNull())
            & ~F.coalesce(has_all, F.lit(False)),
            "missing field",
        )
    )
    ingested = F.date_format(as_timestamp(as_of), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    texts = df.select(F.col(value).cast("string").alias("_text"))
    return compute_once(texts, "_parsed", F.from_json(text, ENVELOPE)).select(
        F.lit(source).alias("source"),
        F.col("_parsed.data.s").alias("symbol"),
        price.alias("price"),
        quantity.alias("quantity"),
        F.col("_parsed.data.T").alias("trade_time"),
        F.col("_parsed.data.m").alias("is_buyer_maker"),
        ingested.alias("ingested_at"),
        reason.alias("reject_reason"),
        F.when(reason.isNotNull(), text).alias("rejected_value"),
    )


def decode_envelope(
    df: DataFrame, value: str = "value", source: str = "exchange", as_of: AsOf = None
) -> tuple[DataFrame, DataFrame]:
    """Records and rejects as two frames. Skipped messages are in neither."""
    both = normalise_envelope(df, value, source, as_of)
    records = both.where(F.col("reject_reason").isNull()).select(*RECORD.names)
    rejects = both.where(F.col("reject_reason") != SKIPPED).select("rejected_value", "reject_reason")
    return records, rejects


def to_messages(df: DataFrame, key: str = "symbol") -> DataFrame:
    """Keyed JSON messages. NULL fields are written out, so that decoding sees every field."""
    body = F.to_json(F.struct("*"), {"ignoreNullFields": "false"})
    return df.select(F.col(key).cast("string").alias("key"), body.alias("value"))


def route_messages(df: DataFrame, topic: str, dead_letter: str) -> DataFrame:
    """Messages with a target topic per row: records to one, rejects to the other.

    Takes the output of :func:`normalise_envelope`, so that both go out in one query over one
    parse.
    """
    good = F.col("reject_reason").isNull()
    body = F.to_json(F.struct(*RECORD.names), {"ignoreNullFields": "false"})
    return df.where(good | (F.col("reject_reason") != SKIPPED)).select(
        F.when(good, F.lit(topic)).otherwise(F.lit(dead_letter)).alias("topic"),
        F.when(good, F.col("symbol")).alias("key"),
        F.when(good, body).otherwise(F.col("rejected_value")).alias("value"),
    )


def decode_records(df: DataFrame, value: str = "value") -> DataFrame:
    """The seven record fields plus ``rejected_value``: the text of a message that yields none.

    A field of the wrong type is NULL and the others are kept.
    """
    text = F.col("_text")
    nothing = F.coalesce(*(F.col(f"_record.{n}").cast("string") for n in RECORD.names)).isNull()
    texts = df.select(F.col(value).cast("string").alias("_text"))
    return compute_once(texts, "_record", F.from_json(text, RECORD)).select(
        "_record.*", F.when(nothing, text).alias("rejected_value")
    )


def parse_sentiment(df: DataFrame, value: str = "value", newest_only: bool = False) -> DataFrame:
    """Sentiment readings from payload texts: date, value, class and the reading's own time.

    ``newest_only`` takes the first element of each payload, which the API puts first. Readings
    without a usable value or time are dropped.
    """
    data = F.from_json(F.col(value).cast("string"), SENTIMENT_PAYLOAD)["data"]
    if newest_only:
        items = df.select(F.get(data, 0).alias("item"))
    else:
        items = df.select(F.explode(data).alias("item"))
    seconds = F.trim(F.col("item.timestamp")).try_cast("bigint")
    return (
        items.select(
            second_time(seconds).alias("reading_time"),
            F.trim(F.col("item.value")).try_cast("int").alias("fng_value"),
            F.col("item.value_classification").alias("fng_classification"),
        )
        .where(F.col("reading_time").isNotNull() & F.col("fng_value").isNotNull())
        .select(
            F.to_date("reading_time").alias("date"),
            "fng_value",
            "fng_classification",
            "reading_time",
        )
    )


def _number(text: Column) -> Column:
    """A decimal number, NULL for any other text. The cast alone would take ``1.5d`` or ``0x1p3``."""
    foreign = text.rlike("[dDfFxX]") & ~text.rlike(r"(?i)^\s*[+-]?inf(inity)?\s*$")
    return F.when(~foreign, F.trim(text).try_cast("double"))
