from __future__ import annotations

from conftest import rows
from pyspark.sql import functions as F

from candlemill.operators.upsert import latest_per_key, upsert

TABLE = "date date, fng_value int, fng_classification string, updated_at timestamp"
NEW = "date date, fng_value int, fng_classification string, reading_time timestamp"
AS_OF = "2024-02-01 00:00:00"


def text(df):
    return rows(df.select(*(F.col(c).cast("string") for c in df.columns)), "date")


def test_insert_replace_keep(frame):
    existing = frame(TABLE, ("2024-01-01", 1, "a", None), ("2024-01-02", 2, "b", "2024-01-05 00:00:00"))
    new = frame(
        NEW,
        ("2024-01-02", 20, None, "2024-01-02 01:00:00"),
        ("2024-01-02", 21, "late", "2024-01-02 00:00:00"),
        ("2024-01-03", 30, "c", "2024-01-03 00:00:00"),
    )
    merged = upsert(existing, new, ["date"], "reading_time", AS_OF)
    assert merged.columns == existing.columns
    assert text(merged) == [
        ("2024-01-01", "1", "a", None),
        ("2024-01-02", "20", None, AS_OF),
        ("2024-01-03", "30", "c", None),
    ]


def test_again_changes_nothing_but_the_stamp(frame):
    new = frame(NEW, ("2024-01-02", 20, "b", "2024-01-02 01:00:00"))
    once = upsert(frame(TABLE), new, ["date"], "reading_time", AS_OF)
    twice = upsert(once, new, ["date"], "reading_time", AS_OF)
    assert text(once) == [("2024-01-02", "20", "b", None)]
    assert text(twice) == [("2024-01-02", "20", "b", AS_OF)]


def test_missing_columns_keep_their_value(frame):
    existing = frame(TABLE, ("2024-01-01", 1, "a", None))
    new = frame("date date, fng_value int", ("2024-01-01", 9))
    assert text(upsert(existing, new, ["date"], as_of=AS_OF)) == [("2024-01-01", "9", "a", AS_OF)]


def test_ties_do_not_depend_on_order(frame):
    data = [("2024-01-01", v, "x", "2024-01-01 00:00:00") for v in (3, 7, 5)]
    for order in (data, data[::-1]):
        assert latest_per_key(frame(NEW, *order), ["date"], "reading_time").first().fng_value == 7


def test_latest_reduces_before_the_shuffle(frame):
    plan = latest_per_key(frame(NEW), ["date"], "reading_time")._jdf.queryExecution().executedPlan().toString()
    before, after = plan.split("Exchange hashpartitioning", 1)
    assert "WindowGroupLimit" in before and "WindowGroupLimit" in after
