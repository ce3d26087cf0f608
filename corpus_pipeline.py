"""A training corpus in five stages: good, distinct, clean of benchmarks, mixed, in token files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlemill.llm import decontaminate, mixing, neardup, quality, token_files
from candlemill.llm.labels import remainder
from candlemill.llm.ship import ship, shipped
from candlemill.sources.staging import drop_staged, new_folder


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted to the labels, lets pass."""
    model = quality.fit(docs, _table(spark, sf_dir, "labels"), remainder(F.col("doc_id"), 5) != 0)
    return quality.keep_good(docs, model)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return neardup.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontaminate.decontaminate(docs, _table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, the last of a source in part."""
    return mixing.apply_mix(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in ORC files, and what they hold of each document."""
    path = new_folder(spark, "tokens")
    token_files.write_tokens(docs, path)
    return token_files.digest(spark, path)


STAGES = [
    ("quality_classifier", shipped(quality_stage)),
    ("near_duplicates", shipped(near_duplicate_stage)),
    ("decontamination", shipped(decontamination_stage)),
    ("mixing", shipped(mixing_stage)),
    ("token_files", shipped(token_stage)),
]

# Fitted rules, min-max hashing, walks and the tokenizer are beyond SQL: tests/llm compares run()
# with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written as Parquet and read again for the next.

    A null in any column, an empty or very long text, ties, repeated rows, an empty table and more
    columns give what the stages' operators say of them: rows without an id are judged each and
    never linked, of rows that repeat an id one stays after the near-duplicate stage, and all
    columns are carried to the last stage, which returns its digest. What a stage wrote is removed
    when the next one has read it.
    """
    ship(spark)
    docs, written = _table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = new_folder(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        if written is not None:
            drop_staged(written)
        docs = written = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
