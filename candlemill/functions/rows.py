"""Row-level helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def compute_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with a costly column that later steps use many times.

    The optimizer copies a projected expression into every filter it pushes below the projection,
    once per reference. It does not push filters below a generator, so the value is generated.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))
