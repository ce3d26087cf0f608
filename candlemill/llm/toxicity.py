"""Toxicity by multiple-instance learning: document labels, sentence scores.

A sentence is toxic with probability ``sigmoid(b + sum of the weights of its features)``; a
document with ``1 - (1 - leak) * product(1 - p)`` over its sentences (noisy-or). Features are
words, lower-cased, and their leading bytes; those that labelled toxic documents hold far more
often than others are kept. Weights are fitted to document labels alone, and the sentences with
the largest probabilities are the offending ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlemill.llm.labels import labelled
from candlemill.llm.text import Words, add_columns, pieces, words
from candlemill.sources.staging import stage

# At most so many labelled documents are learned from, and so many features are kept.
SAMPLE = 10_000
FEATURES = 4_096
PREFIXES = (4, 5, 6, 7, 8)
THRESHOLD = 0.7
LEAST_Z, LEAST_DOCS = 4.5, 3

# Letters are a to z and all bytes of non-ASCII characters; these bytes end a sentence.
_BETWEEN = np.ones(256, bool)
_BETWEEN[97:123] = False
_BETWEEN[128:] = False
_BREAK = np.zeros(256, bool)
_BREAK[[ord(c) for c in ".!?\n"]] = True


def _split(texts: pa.Array) -> tuple[Words, np.ndarray, np.ndarray]:
    """Words, the sentence of each word, and the first sentence of each document (one more)."""
    w = words(texts, between=_BETWEEN)
    breaks = np.zeros(len(w.data) + 1, np.int64)
    np.cumsum(_BREAK[w.data], out=breaks[1:])
    # Every document starts a sentence of its own.
    at = breaks[w.offsets] + np.arange(len(w.offsets))
    return w, breaks[w.start] + w.doc, at


def _features(w: Words) -> list[np.ndarray]:
    return [w.hashes(), *w.prefix_hashes(PREFIXES)]


def _lookup(hashes: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of hashes that the sorted table holds, and their places in it."""
    if not len(table) or not len(hashes):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    place = np.minimum(np.searchsorted(table, hashes), len(table) - 1)
    hit = np.flatnonzero(table[place] == hashes)
    return hit, place[hit]


def _hits(texts: pa.Array, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (sentence, feature) pairs, and the first sentence of each document (one more)."""
    w, sentence, first = _split(texts)
    pairs = [np.zeros(0, np.int64)]
    for hashes in _features(w):
        at, place = _lookup(hashes, table)
        pairs.append(sentence[at] * max(len(table), 1) + place)
    both = np.unique(np.concatenate(pairs))
    return both // max(len(table), 1), both % max(len(table), 1), first


@dataclass(frozen=True)
class SentenceModel:
    features: np.ndarray  # sorted hashes
    weights: np.ndarray
    bias: float
    leak: float

    def sentences(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Log odds of every sentence, and the first sentence of each document (one more)."""
        sentence, feature, first = _hits(texts, self.features)
        odds = np.full(first[-1], self.bias)
        np.add.at(odds, sentence, self.weights[feature])
        return odds, first

    def documents(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probability of each document, its likeliest sentence and that one's probability."""
        odds, first = self.sentences(texts)
        clean = -np.logaddexp(0, odds)  # log(1 - p)
        sums = np.add.reduceat(clean, first[:-1]) + np.log1p(-self.leak)
        worst = np.maximum.reduceat(odds, first[:-1])
        owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
        top = np.full(len(first) - 1, len(odds))
        np.minimum.at(top, owner[odds == worst[owner]], np.flatnonzero(odds == worst[owner]))
        return -np.expm1(sums), top - first[:-1], 1 / (1 + np.exp(-worst))


def _count_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(feature, toxic, clean): documents of each label that hold a feature, by batch."""
    for batch in batches:
        label = batch.column("label").to_numpy(zero_copy_only=False)
        for row, texts in pieces(batch.column("text")):
            w, _, _ = _split(texts)
            doc, own = w.doc.astype(np.uint64), label[row : row + len(texts)]
            features = np.concatenate(_features(w))
            docs = np.tile(doc, 1 + len(PREFIXES))
            order = np.lexsort((docs, features))
            features, docs = features[order], docs[order].astype(np.int64)
            new = np.ones(len(order), bool)
            new[1:] = (features[1:] != features[:-1]) | (docs[1:] != docs[:-1])
            features, docs = features[new], docs[new]
            values, begins = np.unique(features, return_index=True)
            if not len(values):
                continue
            toxic = np.add.reduceat((own[docs] > 0).astype(np.int64), begins)
            total = np.diff(np.append(begins, len(features)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(values.view(np.int64)), pa.array(toxic), pa.array(total - toxic)],
                names=["feature", "toxic", "clean"],
            )


def _fit_weights(
    bags: list[tuple[int, int, np.ndarray, np.ndarray]], size: int, rounds: int = 400, ridge: float = 0.02
) -> tuple[np.ndarray, float, float]:
    """Weights, bias and leak that make the labels of bags likely, by Adam on the noisy-or.

    A bag is (label, sentences, sentence of each hit, feature of each hit).
    """
    label = np.array([b[0] for b in bags], float)
    first = np.concatenate([[0], np.cumsum([b[1] for b in bags])])
    sentence = np.concatenate([b[2] + f for b, f in zip(bags, first)]).astype(np.int64)
    feature = np.concatenate([b[3] for b in bags]).astype(np.int64)
    # Sentences without features are alike: only those with features are kept apart.
    used, at = np.unique(sentence, return_inverse=True)
    owner = np.searchsorted(first, used, "right") - 1
    plain = np.diff(first) - np.bincount(owner, minlength=len(bags))
    theta = np.concatenate([np.full(size, 1.0), [-7.0, -4.0]])
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, rounds + 1):
        w, bias, leak = theta[:size], theta[size], theta[size + 1]
        odds = bias + np.bincount(at, w[feature], len(used))
        p = 1 / (1 + np.exp(-odds))
        p0, pl = 1 / (1 + np.exp(-bias)), 1 / (1 + np.exp(-leak))
        clean = -np.bincount(owner, np.logaddexp(0, odds), len(bags)) - plain * np.logaddexp(0, bias) - np.logaddexp(0, leak)
        toxic = np.maximum(-np.expm1(clean), 1e-9)
        # d(loss)/d(clean) for loss = -label * log(toxic) - (1 - label) * clean
        slope = label * np.exp(clean) / toxic - (1 - label)
        d_odds = -slope[owner] * p
        gradient = np.concatenate([
            np.bincount(feature, d_odds[at], size) + ridge * w,
            [d_odds.sum() - (slope * plain).sum() * p0, -slope.sum() * pl],
        ])
        gradient /= len(bags)
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.999 * square + 0.001 * gradient**2
        rate = 0.1 if step < rounds * 2 // 3 else 0.03
        theta -= rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return theta[:size], float(theta[size]), float(1 / (1 + np.exp(-theta[size + 1])))


def fit(docs: DataFrame, labels: DataFrame, fold: Column, limit: int = SAMPLE) -> SentenceModel:
    """Model from at most ``limit`` labelled documents of the fold.

    Without toxic documents every score is about 0, without clean ones about 1, without labels 0.
    """
    empty = np.zeros(0, np.uint64)
    sample = stage(labelled(docs, labels, "toxic", fold, limit).select("doc_id", "label", "text"), "toxicity")
    count, toxic = sample.agg(F.count("*"), F.coalesce(F.sum(F.signum("label")), F.lit(0.0))).first()
    if not toxic or toxic == count:
        return SentenceModel(empty, np.zeros(0), -30.0, 1 - 1e-9 if toxic else 1e-9)
    x, y = F.col("toxic") / toxic, F.col("clean") / (count - toxic)
    both = (F.col("toxic") + F.col("clean")) / count
    z = (x - y) / F.sqrt(both * (1 - both) * (1 / toxic + 1 / (count - toxic)) + 1e-12)
    chosen = (
        sample.mapInArrow(_count_features, "feature long, toxic long, clean long")
        .groupBy("feature")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .where(F.col("feature") != 0)
        .where(F.col("toxic") >= LEAST_DOCS)
        .where((z >= LEAST_Z) & (x >= 4 * y))
        .orderBy(z.desc(), "feature")
        .limit(FEATURES)
        .select("feature")
    )
    table = np.sort(np.array([r[0] for r in chosen.collect()], np.int64).view(np.uint64))
    if not len(table):
        return SentenceModel(empty, np.zeros(0), -30.0, max(1e-9, toxic / count))

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = batch.column("label").to_pylist()
            for row, texts in pieces(batch.column("text")):
                sentence, feature, first = _hits(texts, table)
                cut = np.searchsorted(sentence, first)
                rows = range(len(texts))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(label[row : row + len(texts)], pa.int32()),
                        pa.array(np.diff(first)),
                        pa.array([(sentence[cut[i] : cut[i + 1]] - first[i]).tolist() for i in rows], pa.list_(pa.int64())),
                        pa.array([feature[cut[i] : cut[i + 1]].tolist() for i in rows], pa.list_(pa.int64())),
                    ],
                    names=["label", "sentences", "sentence", "feature"],
                )

    # Bounded by the sample; sorted, so that a rerun adds in the same order.
    rows = sample.mapInArrow(bags, "label int, sentences long, sentence array<long>, feature array<long>").collect()
    rows.sort(key=lambda r: (r[0], r[1], r[2], r[3]))
    weights, bias, leak = _fit_weights(
        [(int(r[0] > 0), r[1], np.array(r[2], np.int64), np.array(r[3], np.int64)) for r in rows], len(table)
    )
    return SentenceModel(table, weights, bias, leak)


def score(docs: DataFrame, model: SentenceModel) -> DataFrame:
    """``docs`` with ``toxic_score``, ``toxic_sentence`` and ``toxic_sentence_score``.

    toxic_sentence numbers the likeliest sentence from 0; sentences end at ``. ! ?`` or a line end.
    Every text is scored whole. A null or empty text is one sentence without features.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by FEATURES

    def compute(texts: pa.Array) -> list[pa.Array]:
        p, sentence, worst = shared.value.documents(texts)
        return [pa.array(p), pa.array(sentence), pa.array(worst)]

    return add_columns(docs, compute, "toxic_score double, toxic_sentence long, toxic_sentence_score double")


def offending_sentences(docs: DataFrame, model: SentenceModel, least: float = 0.5) -> DataFrame:
    """(doc_id, sentence, score, text) of every sentence at least so likely toxic."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            for row, texts in pieces(batch.column("text")):
                odds, first = shared.value.sentences(texts)
                p = 1 / (1 + np.exp(-odds))
                found = np.flatnonzero(p >= least)
                doc = np.searchsorted(first, found, "right") - 1
                parts = {d: _sentence_texts(texts[int(d)].as_py()) for d in np.unique(doc)}
                number = found - first[doc]
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(doc + row)),
                        pa.array(number),
                        pa.array(p[found]),
                        pa.array([parts[d][k] for d, k in zip(doc, number)], pa.string()),
                    ],
                    names=["doc_id", "sentence", "score", "text"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, sentence long, score double, text string")


def _sentence_texts(text: str) -> list[str]:
    for mark in "!?\n":
        text = text.replace(mark, ".")
    return [s.strip() for s in text.split(".")]
