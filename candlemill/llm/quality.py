"""Quality classifier: a sparse ensemble of rules over text statistics.

Paths through small random trees are conjunctions such as ``pipes > 0.2 AND upper <= 0.4``. A
logistic regression with an L1 penalty gives most of them weight 0; the others become one Spark
column expression over the statistics.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlemill.llm.labels import labelled
from candlemill.llm.text import (
    add_columns,
    byte_table,
    duplicate_lines,
    free_prefix,
    repeated_window_words,
    words,
)
from candlemill.sources.staging import stage

# At most so many labelled documents are learned from.
SAMPLE = 20_000
TREES, DEPTH, PENALTY = 24, 3, 0.002
THRESHOLD = 0.3

STATISTICS = [
    "log_words",
    "word_length",
    "upper",
    "symbols",
    "pipes",
    "bangs",
    "stops",
    "digits",
    "punctuation",
    "short_words",
    "distinct_words",
    "repeated_words",
    "repeated_lines",
    "line_words",
]

_UPPER = byte_table("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_LETTER = _UPPER | byte_table("abcdefghijklmnopqrstuvwxyz")
_SYMBOL = byte_table("#*$%&<>^~_=+@{}[]\\/")
_PUNCTUATION = byte_table(",;:()'\"-")


def statistics(texts: pa.Array) -> list[pa.Array]:
    """The statistics of each text. Shares have at least 1 below the line, so empty texts give 0."""
    w = words(texts, lower=False)
    hashes = w.hashes()
    n = w.counts
    per = np.maximum(n, 1)
    lengths = w.end - w.start
    doc = w.doc
    again, lines = duplicate_lines(texts)
    order = np.lexsort((hashes, doc))
    new = np.ones(len(order), bool)
    new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (doc[order][1:] != doc[order][:-1])
    distinct = np.bincount(doc[order][new], minlength=len(w))
    letters = np.maximum(w.count_bytes(_LETTER), 1)
    columns = [
        np.log1p(n),
        np.bincount(doc, lengths, len(w)) / per,
        w.count_bytes(_UPPER) / letters,
        w.count_bytes(_SYMBOL) / per,
        w.count_bytes(byte_table("|")) / per,
        w.count_bytes(byte_table("!")) / per,
        w.count_bytes(byte_table(".?")) / per,
        w.count_bytes(byte_table("0123456789")) / np.maximum(np.diff(w.offsets), 1),
        w.count_bytes(_PUNCTUATION) / per,
        np.bincount(doc, lengths <= 3, len(w)) / per,
        distinct / per,
        repeated_window_words(w, hashes) / per,
        again / np.maximum(lines, 1),
        n / np.maximum(lines, 1),
    ]
    return [pa.array(c.astype(np.float64)) for c in columns]


def with_statistics(docs: DataFrame, prefix: str = "_") -> DataFrame:
    return add_columns(docs, statistics, ", ".join(f"{prefix}{name} double" for name in STATISTICS))


Rule = tuple[tuple[int, bool, float], ...]  # (statistic, above, limit), all of them


def tree_rules(debug_string: str) -> list[Rule]:
    """Paths from the root to every other node of every tree, repeated ones once."""
    found: dict[Rule, None] = {}
    path: list[tuple[int, tuple[int, bool, float]]] = []
    for line in debug_string.splitlines():
        m = re.match(r"( *)(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)", line)
        if m:
            depth = len(m[1])
            path = [p for p in path if p[0] < depth] + [(depth, (int(m[2]), m[3] == ">", float(m[4])))]
            found[tuple(sorted({p[1] for p in path}))] = None
        elif line.lstrip().startswith("Tree"):
            path = []
    return list(found)


def rule_column(rule: Rule, prefix: str = "_") -> Column:
    """The rule as a condition on the statistics' columns."""
    condition = F.lit(True)
    for statistic, above, limit in rule:
        value = F.col(f"{prefix}{STATISTICS[statistic]}")
        condition = condition & (value > limit if above else value <= limit)
    return condition


@dataclass(frozen=True)
class RuleModel:
    intercept: float
    rules: tuple[tuple[Rule, float], ...]

    def score(self, prefix: str = "_") -> Column:
        """Probability of label 1 as a column over the statistics."""
        total = F.lit(self.intercept)
        for rule, weight in self.rules:
            total = total + F.when(rule_column(rule, prefix), weight).otherwise(0.0)
        return 1 / (1 + F.exp(-total))


def fit(docs: DataFrame, labels: DataFrame, fold: Column, limit: int = SAMPLE) -> RuleModel:
    """Rules and weights from at most ``limit`` labelled documents of the fold.

    Without both labels in the sample no rule is made and the score is constant: 0.5 without any
    label, else the one label.
    """
    sample = stage(with_statistics(labelled(docs, labels, "quality", fold, limit)).drop("text"), "quality")
    count, ones = sample.agg(F.count("*"), F.sum("label")).first()
    if not count or ones in (0, count):
        return RuleModel(0.0 if not count else (20.0 if ones else -20.0), ())
    # At most SAMPLE short rows: in one order and partition, so that reruns fit the same model.
    sample = sample.coalesce(1).sortWithinPartitions("doc_id", "label", *[f"_{n}" for n in STATISTICS])
    rows = VectorAssembler(inputCols=[f"_{n}" for n in STATISTICS], outputCol="features").transform(sample)
    rows = rows.select(F.col("label").cast("double").alias("label"), "features", *[f"_{n}" for n in STATISTICS])
    # Both labels weigh alike while trees grow, so that rules for the rare one are found.
    share = ones / count
    rows = rows.withColumn("weight", F.when(F.col("label") == 1, 0.5 / share).otherwise(0.5 / (1 - share)))
    forest = RandomForestClassifier(
        numTrees=TREES, maxDepth=DEPTH, seed=7, weightCol="weight", featureSubsetStrategy="onethird", minInstancesPerNode=3
    ).fit(rows)
    rules = tree_rules(forest.toDebugString)
    if not rules:
        return RuleModel(float(np.log(share / (1 - share))), ())
    flags = F.array(*[rule_column(r).cast("double") for r in rules])
    matrix = rows.select("label", flags.alias("flags"))
    matrix = stage(matrix, "rules").select("label", array_to_vector("flags").alias("features"))
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=PENALTY, standardization=False, maxIter=60).fit(matrix)
    weights = lasso.coefficients.toArray()
    return RuleModel(
        float(lasso.intercept), tuple((rule, float(x)) for rule, x in zip(rules, weights) if x)
    )


def classify(docs: DataFrame, model: RuleModel, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``quality_score`` (0 to 1, higher: label 1 likelier) and ``quality_pass``.

    Every text is scored whole; null and empty ones have statistics 0. Other columns are kept; the
    two replace columns of their names.
    """
    prefix = free_prefix(docs)
    scored = with_statistics(docs, prefix).withColumn("quality_score", model.score(prefix))
    return scored.withColumn("quality_pass", F.col("quality_score") >= threshold).drop(
        *[f"{prefix}{n}" for n in STATISTICS]
    )


def keep_good(docs: DataFrame, model: RuleModel, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that pass, with their own columns alone."""
    prefix = free_prefix(docs)
    return with_statistics(docs, prefix).where(model.score(prefix) >= threshold).select(
        *[F.col(f"`{c}`") for c in docs.columns]
    )
