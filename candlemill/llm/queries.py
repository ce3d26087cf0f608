"""The corpus operators over the supplied tables."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlemill.llm import (
    decontaminate,
    extract,
    fertility,
    lm,
    mixing,
    neardup,
    negatives,
    passages,
    periodic,
    quality,
    substrings,
    token_files,
    toxicity,
)
from candlemill.llm.labels import remainder
from candlemill.llm.ship import shipped
from candlemill.sources.staging import new_folder

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    fold = remainder(F.col("doc_id"), 5)
    model = quality.fit(docs, labels, fold != 0)
    scored = quality.classify(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id",
        (fold == 0).alias("held_out"),
        F.col("quality_score").alias("score"),
        F.col("quality_pass").cast("int").alias("predicted"),
    )


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    fold = remainder(F.col("doc_id"), 3)
    model = toxicity.fit(docs, labels, fold != 1)
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id",
        (fold == 1).alias("held_out"),
        F.col("toxic_score").alias("score"),
        (F.col("toxic_score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
        "toxic_sentence",
    )


def op3_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated_passages(_table(spark, sf_dir, "documents"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op6_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = extract.extract(_table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return pages.select("page_id", "url", F.col("main_text").alias("text"), F.col("main_chars").alias("n_chars"))


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_table(spark, sf_dir, "documents"))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "tokens")
    token_files.write_tokens(_table(spark, sf_dir, "documents"), path)
    return token_files.digest(spark, path)


def op9_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(_table(spark, sf_dir, "documents"), remainder(F.col("doc_id"), 5) == 1)


def op10_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fertility.fertility_rules(_table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "chars_per_token",
        "byte_share",
        "entropy",
        "word_chars_per_token",
        "word_entropy",
    )


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(_table(spark, sf_dir, "embeddings").withColumn("label", moved))


def op12_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.digest(substrings.remove_repeated(_table(spark, sf_dir, "documents")))


def with_repeated_tail(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words of the contract: those of one document in ten repeat from some place on."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n = len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    start = g % n
    period = 1 + (n - start) // (3 + g % 8)
    return words[:start] + [words[start + (i - start) % period] for i in range(start, n)]


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.digest(periodic.periodic_runs(_table(spark, sf_dir, "documents"), with_repeated_tail))


LLM_QUERIES: dict[str, Query] = {
    name: shipped(query) for name, query in list(globals().items()) if name.startswith("op") and callable(query)
}

# Oracles in DuckDB's SQL, where SQL can express the operator.
_MIX_SQL = rf"""
WITH docs AS (
  SELECT doc_id, source, text,
         coalesce(len(regexp_extract_all(text, '{mixing.WORD}')), 0)::BIGINT AS size,
         coalesce(len(regexp_extract_all(text, '{mixing.SYMBOL}')), 0) AS symbols,
         (('0x' || substr(md5('{mixing.SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT + 0.5)
           / 4503599627370496.0 AS u
  FROM documents),
keyed AS (
  SELECT *, -ln(u::DOUBLE) / greatest(0.1::DOUBLE, 1.0::DOUBLE - symbols::DOUBLE / greatest(size, 1)) AS key FROM docs),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT AS weight
  FROM keyed GROUP BY source),
levels AS (
  SELECT *, 3 * source_size AS most, 3 * source_size / weight AS ratio,
         ((sum(source_size) OVER ())::BIGINT
          - coalesce(sum(3 * source_size) OVER (ORDER BY 3 * source_size / weight, source NULLS LAST
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT)
         / (sum(weight) OVER (ORDER BY 3 * source_size / weight, source NULLS LAST
              ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS level
  FROM sources),
targets AS (
  SELECT source, source_size,
         CASE WHEN level > ratio THEN most::DOUBLE
              ELSE max(level) FILTER (WHERE level <= ratio) OVER () * weight END AS target
  FROM levels),
budgets AS (
  SELECT *, floor(target + 0.5)::BIGINT AS words,
         CASE WHEN source_size > 0 THEN floor(target + 0.5)::BIGINT // source_size ELSE 0 END AS epochs
  FROM targets),
ordered AS (
  SELECT k.doc_id, k.size, b.source_size, b.target, b.epochs, b.words - b.epochs * b.source_size AS rest,
         coalesce(sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.doc_id, k.size
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS prior
  FROM keyed k JOIN budgets b ON k.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target,
       (epochs * size + greatest(0, least(size, rest - prior)))::BIGINT AS taken
FROM ordered
"""

_NEGATIVES_SQL = """
WITH points AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * x::DOUBLE) FOR x IN embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
pairs AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         list_inner_product(a.v, b.v)::BIGINT AS score
  FROM points a JOIN points b ON a.vec_id <> b.vec_id
  WHERE a.vec_id % 50 = 0),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score
  FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) AS place
        FROM pairs WHERE same)
  WHERE place <= 5),
ranked AS (
  SELECT p.anchor_id, positive_id, other_id AS negative_id, positive_score, score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id) AS rank
  FROM positives p JOIN pairs n ON p.anchor_id = n.anchor_id AND NOT same
    AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score
FROM ranked WHERE rank <= 3
"""

LLM_ORACLE: dict[str, str] = {"op5_mixing": _MIX_SQL, "op11_hard_negatives": _NEGATIVES_SQL}
