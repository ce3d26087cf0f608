"""Bounded samples of labelled documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(column: Column, modulus: int) -> Column:
    """crc32 of a number as text, modulo; a null counts as empty text."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % modulus


def labelled(docs: DataFrame, labels: DataFrame, label: str, fold: Column, limit: int) -> DataFrame:
    """(doc_id, text, label) of at most ``limit`` labelled documents of a fold.

    The sample takes labels in the order of a hash of the id, so it is the same on every run, and
    is small enough to be broadcast: documents are not shuffled. Null labels and ids are left out;
    a document labelled several times counts once, with its largest label.
    """
    sample = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
        .where("doc_id IS NOT NULL AND label IS NOT NULL")
        .where(fold)
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(limit)
    )
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.join(F.broadcast(sample), "doc_id")
