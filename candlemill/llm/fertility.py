"""Quality rules by tokeniser fertility.

Public vocabularies cut natural text into pieces of a usual length; noise falls apart into many
short pieces, bytes or a few repeated ones. Each language has bands for characters per token and
the entropy of the tokens of two vocabularies, and for the share of byte fallback of the one that
has it; a document outside one is rejected.

The bands of a language with few documents lean on those of the script, more so the fewer they
are, and are wider: there is no number of documents at which another rule begins.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlemill.llm.text import add_columns, byte_table, duplicate_lines, repeated_window_words, words
from candlemill.llm.vocabularies import PIECE_BPE, WORD_BPE, encoder
from candlemill.sources.staging import stage

MIN_WORDS = 50
# Half-width of a band in interquartile ranges, and its least half-width.
SPREAD = 3.0
FLOORS = {
    "chars_per_token": 0.25,
    "byte_share": 0.02,
    "entropy_gap": 0.4,
    "word_chars_per_token": 0.25,
    "word_entropy_gap": 0.4,
}
# So many documents of a script weigh as much as a language's own.
PRIOR_DOCS = 100
# A band is wider by this over the root of the number of documents behind it.
WIDER = 2.0
# More languages than these, of some 100 bytes each, are joined without a broadcast.
BROADCAST_LANGUAGES = 10_000

_SYMBOL = byte_table("#*$%&|<>")
_CONTINUES = (np.arange(256) & 0xC0) == 0x80
_FIELDS = (
    "_n_words long, _word_chars long, _n_symbols long, _n_dup_lines long, _n_repeat_words long, "
    "_n_tokens long, _chars_per_token double, _byte_share double, _entropy double, _n_word_tokens long, "
    "_word_chars_per_token double, _word_entropy double, _script string"
)
# Scripts by the range of code points that their letters mostly have.
SCRIPTS = [
    ("latin", 0x41, 0x24F),
    ("greek", 0x370, 0x3FF),
    ("cyrillic", 0x400, 0x52F),
    ("hebrew", 0x590, 0x5FF),
    ("arabic", 0x600, 0x6FF),
    ("devanagari", 0x900, 0x97F),
    ("thai", 0xE00, 0xE7F),
    ("kana", 0x3040, 0x30FF),
    ("han", 0x4E00, 0x9FFF),
    ("hangul", 0xAC00, 0xD7AF),
]


def script(text: str) -> str:
    """The script that most letters have; ``none`` without any."""
    if text.isascii():
        return "latin" if any(map(str.isalpha, text[:1000])) or any(map(str.isalpha, text)) else "none"
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    counts = [int(((points >= a) & (points <= b)).sum()) for _, a, b in SCRIPTS]
    return SCRIPTS[int(np.argmax(counts))][0] if max(counts) else "none"


def _entropy(ids: np.ndarray) -> float:
    """Entropy of the tokens in bits."""
    if not len(ids):
        return 0.0
    ordered = np.sort(ids)
    cuts = np.flatnonzero(ordered[1:] != ordered[:-1]) + 1
    p = np.diff(np.concatenate([[0], cuts, [len(ids)]])) / len(ids)
    return float(-(p * np.log2(p)).sum())


def measures(texts: pa.Array, vocabulary: str = PIECE_BPE, second: str = WORD_BPE) -> list[pa.Array]:
    """The columns of ``_FIELDS`` for each text; the first vocabulary has byte fallback."""
    w = words(texts, lower=False)
    strings = texts.to_pylist()
    model = encoder(vocabulary)
    flat, first = model.encode(texts)
    tokens = np.diff(first)
    ids = [flat[a:b] for a, b in zip(first[:-1], first[1:])]
    other, at = encoder(second).encode(texts)
    other_tokens = np.diff(at)
    in_words = np.bincount(w.doc, w.end - w.start, len(w)).astype(np.int64)
    chars = in_words - w.count_bytes(_CONTINUES)
    fallback = np.array([int(model.is_byte[i].sum()) for i in ids], np.int64)
    return [
        pa.array(w.counts.astype(np.int64)),
        pa.array(chars),
        pa.array(w.count_bytes(_SYMBOL)),
        pa.array(duplicate_lines(texts)[0]),
        pa.array(repeated_window_words(w, w.hashes())),
        pa.array(tokens),
        pa.array(chars / np.maximum(tokens, 1)),
        pa.array(fallback / np.maximum(tokens, 1)),
        pa.array([_entropy(i) for i in ids], pa.float64()),
        pa.array(other_tokens),
        pa.array(chars / np.maximum(other_tokens, 1)),
        pa.array([_entropy(other[a:b]) for a, b in zip(at[:-1], at[1:])], pa.float64()),
        pa.array([script(t) for t in strings], pa.string()),
    ]


def _quartiles(usable: DataFrame, by: str, prefix: str) -> DataFrame:
    """Per value of ``by``: the number of documents and the quartiles of each measure."""
    found = [
        F.percentile_approx(name, F.array(F.lit(0.25), F.lit(0.75)), F.lit(10_000)).alias(f"{prefix}{name}")
        for name in FLOORS
    ]
    return usable.groupBy(by).agg(F.count("*").alias(f"{prefix}docs"), *found)


def bands(measured: DataFrame, spread: float = SPREAD) -> DataFrame:
    """Per language and script: low_ and high_ limits of each measure, of documents that pass the base rules.

    A band reaches ``spread`` times the quartiles' range beyond them, by ``FLOORS`` at least. The
    quartiles are those of the language, with the script's as ``PRIOR_DOCS`` documents more.
    """
    usable = measured.where("NOT base_failed")
    pairs = usable.select("language", "script").distinct()
    joined = pairs.join(_quartiles(usable, "language", "own_"), "language").join(
        _quartiles(usable, "script", "all_"), "script"
    )
    own, wide = F.col("own_docs"), 1 + WIDER / F.sqrt(F.col("all_docs"))
    out = [F.col("language"), F.col("script")]
    for name, floor in FLOORS.items():
        low, high = (
            (own * F.col(f"own_{name}")[k] + PRIOR_DOCS * F.col(f"all_{name}")[k]) / (own + PRIOR_DOCS) for k in (0, 1)
        )
        reach = F.greatest(spread * (high - low), F.lit(floor)) * wide
        out += [(low - reach).alias(f"low_{name}"), (high + reach).alias(f"high_{name}")]
    return joined.select(*out)


def entropy_gap(entropy: str, tokens: str) -> Column:
    """The entropy less what the number of tokens lets expect, so that long and short documents are alike."""
    return F.col(entropy) - 8.0 * (1 - F.exp(-F.ln(1 + F.col(tokens)) / 4))


def fertility_rules(
    docs: DataFrame, vocabulary: str = PIECE_BPE, spread: float = SPREAD, second: str = WORD_BPE
) -> DataFrame:
    """One row per document: doc_id, the base counts, the measures, base_failed, kept, language.

    The language is the lang column, or the script of the text where lang is null or missing. The
    bands come from all documents that pass the base rules (50 words at least, at most half of
    them in repeated windows of three). Null and empty texts fail the base rules. Other columns
    are not read; rows that repeat an id are judged each; an empty table gives an empty result.
    """
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), lang.alias("_lang"), F.col("text").cast("string").alias("text")
    )
    rows = add_columns(rows, lambda texts: measures(texts, vocabulary, second), _FIELDS).drop("text")
    rows = rows.toDF(*[c.lstrip("_") for c in rows.columns])
    rows = rows.withColumn("language", F.coalesce("lang", "script")).drop("lang")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    rows = rows.withColumns(
        {
            "base_failed": failed,
            "entropy_gap": entropy_gap("entropy", "n_tokens"),
            "word_entropy_gap": entropy_gap("word_entropy", "n_word_tokens"),
        }
    )
    rows = stage(rows, "fertility")
    limits = stage(bands(rows, spread), "bands")  # one row per language and script
    names = [f"{side}_{n}" for n in FLOORS for side in ("low", "high")]
    if limits.count() <= BROADCAST_LANGUAGES:
        limits = F.broadcast(limits)
    joined = rows.join(limits, ["language", "script"], "left")
    inside = F.lit(True)
    for name in FLOORS:
        within = F.col(name).between(F.col(f"low_{name}"), F.col(f"high_{name}"))
        inside = inside & F.coalesce(within, F.lit(True))
    return joined.withColumn("kept", ~F.col("base_failed") & inside).drop(*names)
