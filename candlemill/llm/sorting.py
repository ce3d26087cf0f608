"""Rows in one global order: their numbers, and equal neighbours, without a window over all rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlemill.sources.staging import stage


def ordered(df: DataFrame, order: list[str]) -> DataFrame:
    """``df`` dealt to partitions by ranges of ``order`` and sorted in each.

    Their number is left to adaptive execution, which joins small neighbours and keeps the order.
    """
    return df.repartitionByRange(*order).sortWithinPartitions(*order)


def counted(df: DataFrame, order: list[str], flag: str) -> DataFrame:
    """``df`` with ``before``, the rows before in the order, and ``flags_before``, those of them with ``flag``.

    Partitions count their own rows; one row of totals per partition gives what is before it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, rows, flags = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            set_ = batch.column(flag).to_numpy(zero_copy_only=False).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array(np.full(len(set_), part, np.int32)),
                    pa.array(rows + np.arange(len(set_))),
                    pa.array(flags + np.cumsum(set_) - set_),
                ],
                names=[*batch.schema.names, "part", "own_rows", "own_flags"],
            )
            rows, flags = rows + len(set_), flags + int(set_.sum())

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)
    numbered = stage(
        ordered(df, order).mapInArrow(run, f"{fields}, part int, own_rows long, own_flags long"), "numbered"
    )
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    totals = numbered.groupBy("part").agg(
        F.count("*").alias("rows"), F.sum(F.col(flag).cast("long")).alias("flags")
    ).select(
        "part",
        F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("rows_before"),
        F.coalesce(F.sum("flags").over(earlier), F.lit(0)).alias("flags_before"),
    )
    return numbered.join(F.broadcast(totals), "part").select(
        *df.columns,
        (F.col("rows_before") + F.col("own_rows")).alias("before"),
        (F.col("flags_before") + F.col("own_flags")).alias("flags_before"),
    )


def paired(df: DataFrame, order: list[str], same: list[str]) -> DataFrame:
    """``df`` with ``paired``: whether the row before or after in the order is equal in ``same``.

    Rows of a partition are compared where they are. Of each partition the first and the last row
    are compared with those of its neighbours.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held, held_equal, first = None, False, True

        def out(rows: pa.RecordBatch, flags: np.ndarray, starts: bool, ends: bool) -> pa.RecordBatch:
            edge = np.zeros(len(flags), np.int32)
            if starts:
                edge[0] += 1
            if ends:
                edge[-1] += 2
            return pa.RecordBatch.from_arrays(
                [*rows.columns, pa.array(flags), pa.array(np.full(len(flags), part, np.int32)), pa.array(edge)],
                names=[*rows.schema.names, "paired", "part", "edge"],
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            equal = np.ones(rows.num_rows - 1, bool)
            for name in same:
                values = rows.column(name).to_numpy(zero_copy_only=False)
                equal &= values[1:] == values[:-1]
            flags = np.concatenate([[held_equal], equal]) | np.concatenate([equal, [False]])
            held, held_equal = rows.slice(rows.num_rows - 1), bool(flags[-1])
            if rows.num_rows > 1:
                yield out(rows.slice(0, rows.num_rows - 1), flags[:-1], first, False)
                first = False
        if held is not None:
            yield out(held, np.array([held_equal]), first, True)

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)
    flagged = stage(ordered(df, order).mapInArrow(run, f"{fields}, paired boolean, part int, edge int"), "paired")
    # At most two rows per partition.
    edges = flagged.where("edge > 0").select("part", "edge", *same).orderBy("part", "edge").collect()
    ends, starts = {}, {}
    for row in edges:
        value = tuple(row)[2:]
        if row.edge & 1:
            starts[row.part] = value
        if row.edge & 2:
            ends[row.part] = value
    parts = sorted(starts)
    equal = [(a, b) for a, b in zip(parts, parts[1:]) if ends[a] == starts[b]]
    last = F.col("part").isin([a for a, _ in equal]) & (F.col("edge") >= 2)
    first = F.col("part").isin([b for _, b in equal]) & F.col("edge").isin(1, 3)
    return flagged.select(*df.columns, (F.col("paired") | last | first).alias("paired"))
