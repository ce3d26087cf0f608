"""Keyed insert-or-replace."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlemill.functions import as_timestamp
from candlemill.functions.times import AsOf


def latest_per_key(df: DataFrame, keys: Sequence[str], order: str | None = None) -> DataFrame:
    """The row highest in ``order`` per key, ties broken by the whole row.

    Spark limits each group to one row before the shuffle, so a hot key stays cheap.
    """
    rest = [c for c in df.columns if c not in keys and c != order]
    columns = rest if order is None else [order, *rest]
    ranking = Window.partitionBy(*keys).orderBy(*(F.desc_nulls_last(c) for c in columns))
    return df.withColumn("_rank", F.row_number().over(ranking)).where("_rank = 1").drop("_rank")


def upsert(
    existing: DataFrame,
    new: DataFrame,
    keys: Sequence[str],
    order: str | None = None,
    as_of: AsOf = None,
    stamp: str = "updated_at",
) -> DataFrame:
    """``existing`` with the rows of ``new`` replaced or added, in the columns of ``existing``.

    ``existing`` has at most one row per key. Of several new rows with one key the highest in
    ``order`` wins. Replaced rows get ``as_of`` in ``stamp``; added rows have it NULL. Columns that
    ``new`` lacks keep their value. Both sides are shuffled once, on the key, and hold each key
    once by then, so no key is hot.
    """
    keys = list(keys)
    new = latest_per_key(new, keys, order)
    values = [c for c in existing.columns if c not in keys and c != stamp]
    given = [c for c in values if c in new.columns]

    old = existing.withColumn("_old", F.lit(True)).alias("old")
    incoming = new.select(*keys, *given, F.lit(True).alias("_new")).alias("incoming")
    is_new, is_old = F.col("incoming._new").isNotNull(), F.col("old._old").isNotNull()

    columns = {k: F.col(k) for k in keys}
    for name in values:
        kept = F.col(f"old.{name}")
        columns[name] = (
            F.when(is_new, F.col(f"incoming.{name}")).otherwise(kept) if name in given else kept
        )
    if stamp in existing.columns:
        columns[stamp] = F.when(is_new & is_old, as_timestamp(as_of)).otherwise(F.col(f"old.{stamp}"))
    return old.join(incoming, keys, "full_outer").select(
        *(columns[c].alias(c) for c in existing.columns)
    )
