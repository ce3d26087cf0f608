"""Hourly copy of silver into the history table."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlemill.functions import as_timestamp
from candlemill.schemas import HISTORY

SLICE_PARTITIONS = ["trade_date", "trade_hour"]


def concat_frames(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames, matched by column name; missing columns become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def history_columns(silver: DataFrame) -> DataFrame:
    return silver.select(*HISTORY.names)


def run_hour(hour: datetime) -> datetime:
    """The start of a run hour, in UTC and without a zone."""
    if hour.tzinfo is not None:
        hour = hour.astimezone(timezone.utc).replace(tzinfo=None)
    return hour.replace(minute=0, second=0, microsecond=0)


def hour_slice(silver: DataFrame, hour: datetime) -> DataFrame:
    """The trades of one run hour (in UTC unless it has a zone), reading that day's directory only."""
    start = run_hour(hour)
    time = F.col("trade_timestamp")
    end = start + timedelta(hours=1)
    rows = silver.where((time >= as_timestamp(start)) & (time < as_timestamp(end)))
    if {"year", "month", "day"} <= set(silver.columns):
        rows = rows.where(
            (F.col("year") == start.year)
            & (F.col("month") == start.month)
            & (F.col("day") == start.day)
        )
    return rows


def history_slice(silver: DataFrame, hour: datetime | None = None) -> DataFrame:
    """History rows of one run hour, or of every hour, with the columns a slice is replaced by."""
    rows = silver if hour is None else hour_slice(silver, hour)
    return history_columns(rows).withColumns(
        {
            "trade_date": F.to_date("trade_timestamp"),
            "trade_hour": F.hour("trade_timestamp"),
        }
    )
