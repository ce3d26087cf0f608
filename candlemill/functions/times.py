"""Time expressions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

AsOf = Column | datetime | str | None


def as_timestamp(as_of: AsOf) -> Column:
    """A fixed moment, or the query's start time when none is given."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    # As text, so that a time without a zone is read in the session's zone, not the driver's.
    return F.lit(str(as_of)).cast("timestamp")


# The years 1 to 9999 in epoch seconds: what timestamps, dates and their text forms all hold.
FIRST_SECOND, LAST_SECOND = -62_135_596_800, 253_402_300_799


def has_event_time(ms: str | Column) -> Column:
    """Whether epoch milliseconds are in the years 1 to 9999. Bounds on the raw column reach the scan."""
    ms = F.col(ms) if isinstance(ms, str) else ms
    return ms.between(FIRST_SECOND * 1_000, LAST_SECOND * 1_000 + 999)


def event_time(ms: str | Column) -> Column:
    """Timestamp from epoch milliseconds, NULL outside the years 1 to 9999."""
    ms = F.col(ms) if isinstance(ms, str) else ms
    return F.when(has_event_time(ms), F.timestamp_millis(ms))


def second_time(seconds: Column) -> Column:
    """Timestamp from epoch seconds, NULL outside the years 1 to 9999."""
    return F.when(seconds.between(FIRST_SECOND, LAST_SECOND), F.timestamp_seconds(seconds))


def partition_values(ts: str | Column, hour: bool = False) -> dict[str, Column]:
    """Directory columns of a layer, as ints."""
    values = {"year": F.year(ts), "month": F.month(ts), "day": F.dayofmonth(ts)}
    if hour:
        values["hour"] = F.hour(ts)
    return values


def minutes_since(ts: str | Column, as_of: AsOf) -> Column:
    """Minutes from ``ts`` to ``as_of``, with fractions."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    micros = F.unix_micros(as_timestamp(as_of)) - F.unix_micros(ts.cast("timestamp"))
    return micros / F.lit(60_000_000.0)
