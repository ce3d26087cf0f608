"""Token ids in ORC files.

ORC writes integer columns run-length encoded in stripes, with an index every so many rows and
Bloom filters for document ids. A read splits files by stripes, and a filter on doc_id skips
files, stripes and row groups by their ranges and Bloom filters.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from candlemill.llm.memory import lean
from candlemill.llm.text import pieces
from candlemill.llm.vocabularies import PIECE_BYTES, WORD_BPE, encoder

END_ID = 2
SCHEMA = "pos int, doc_id long, n_tokens long, ids array<int>"


def encode_documents(docs: DataFrame, vocabulary: str = WORD_BPE, end_id: int = END_ID) -> DataFrame:
    """(pos, doc_id, n_tokens, ids) in ascending doc_id order, an end id after each document.

    A null or empty text has the end id alone. Null ids come first; rows that repeat an id stay
    together, in the order of a hash of their texts. pos numbers the documents of a partition.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = 0
        for batch in batches:
            ids = batch.column("doc_id")
            for row, texts in pieces(batch.column("text"), PIECE_BYTES):
                encoded, first = encoder(vocabulary).encode(texts)
                lengths = np.diff(first) + 1
                offsets = np.concatenate([[0], np.cumsum(lengths)])
                flat = np.full(offsets[-1], end_id, np.int32)
                inside = np.ones(len(flat), bool)
                inside[offsets[1:] - 1] = False
                flat[inside] = encoded
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(done, done + len(texts)), pa.int32()),
                        ids.slice(row, len(texts)),
                        pa.array(lengths),
                        pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat)),
                    ],
                    names=["pos", "doc_id", "n_tokens", "ids"],
                )
                done += len(texts)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    return ordered.mapInArrow(lean(run), SCHEMA)


def write_tokens(docs: DataFrame, path: str, vocabulary: str = WORD_BPE, end_id: int = END_ID) -> None:
    """Write the ids of whole texts as ORC files; partitions and files ascend by doc_id."""
    (
        encode_documents(docs, vocabulary, end_id)
        .write.option("compression", "zstd")
        .option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", "0.01")
        .option("orc.row.index.stride", "1000")
        .option("orc.stripe.size", str(16 << 20))
        .orc(path)
    )


def read_tokens(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """(doc_id, ids) of the files, all or those of some documents, which prune by metadata."""
    rows = spark.read.schema(SCHEMA).orc(path)
    return rows.where(F.col("doc_id").isin(doc_ids)) if doc_ids is not None else rows


def digest(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files: doc_id, start, n_tokens, ids_crc32.

    start counts the ids of all documents before it in the order of the files: sums by file, then
    the order within a file. ids_crc32 is taken of the ids as little-endian 32-bit numbers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("ids")
            offsets = column.offsets.to_numpy()
            values = column.values.to_numpy().astype("<u4", copy=False)
            sums = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:])]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("file"),
                    batch.column("pos"),
                    batch.column("doc_id"),
                    pa.array(np.diff(offsets).astype(np.int64)),
                    pa.array(sums, pa.int64()),
                ],
                names=["file", "pos", "doc_id", "n_tokens", "ids_crc32"],
            )

    files = read_tokens(spark, path).withColumn("file", F.input_file_name())
    rows = files.select("file", "pos", "doc_id", "ids").mapInArrow(
        lean(run), "file string, pos int, doc_id long, n_tokens long, ids_crc32 long"
    )
    # The lengths alone give the sums by file; a row for each file is put in order.
    by_file = files.groupBy("file").agg(F.sum("n_tokens").alias("tokens"), F.min("doc_id").alias("least"), F.max(F.col("doc_id").isNull()).alias("nulls"))
    order = Window.orderBy(F.col("nulls").desc(), F.col("least").asc_nulls_first(), "file")
    by_file = by_file.withColumn(
        "before", F.coalesce(F.sum("tokens").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ).select("file", "before")
    within = Window.partitionBy("file").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    return (
        rows.join(by_file, "file")
        .withColumn("start", F.col("before") + F.coalesce(F.sum("n_tokens").over(within), F.lit(0)))
        .select("doc_id", F.col("start").cast("long").alias("start"), "n_tokens", "ids_crc32")
    )
