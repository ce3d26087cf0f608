"""Benchmark decontamination by edit distance.

Edit distance is of words, A to Z lower-cased, without punctuation around them. A document's
windows of the size of a benchmark item are put through the CGK random walk: it copies a sequence
into a longer one, and after each copied word a random bit, shared by all windows and drawn from
the step and the word, says whether to move on. Sequences at a small edit distance stay together
for most steps, so that the Hamming distance of the walks is small, and repeated samples of their
steps are keys that they share. Every pair that shares a key is confirmed by its edit distance.

Windows are embedded only where they can match: a window within the edit limit of an item shares
a run of words with it, as long as the item divided by the limit plus one. That is exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlemill.llm.memory import lean
from candlemill.llm.text import Words, add_columns, free_prefix, mix, pieces, words
from candlemill.sources.staging import drop_staged, stage

SIMILARITY = 0.8
# Walks of an item, and one more for every so many of its words: the longer two sequences, the
# fewer walks keep them together. A walk goes over so many words at most; those of a longer item
# begin at places spread over it. test_decontamination_recall measures the sum of it.
WALKS = 32
WORDS_PER_WALK = 8
WALK_WORDS = 512
SAMPLED = 2
# Starts between the ends of a range that are compared; ranges of short items have no more.
STARTS = 64
# Cells of a block of windows, walks or words.
CELLS = 4_000_000
# Bytes of prepared items that one broadcast holds; larger benchmarks are searched part by part.
BROADCAST_BYTES = 64_000_000
# Shorter items are matched word by word only: an edit more would match common phrases.
LEAST_WORDS = 8

_BETWEEN = np.ones(256, bool)
_BETWEEN[48:58] = False
_BETWEEN[97:123] = False
_BETWEEN[128:] = False
_STEP = np.uint64(0xD6E8FEB86659FD93)

FOUND = "doc_id long, item_id long, start_word long, n_words long, edits int"


def allowed(n: np.ndarray | int, similarity: float = SIMILARITY) -> np.ndarray:
    """Edits that an item of n words allows."""
    n = np.asarray(n)
    return np.where(n < LEAST_WORDS, 0, np.floor(n * (1 - similarity) + 1e-9)).astype(np.int64)


def run_length(n: np.ndarray | int, similarity: float = SIMILARITY) -> np.ndarray:
    """Words of an item that some window within the limit shares with it without a break."""
    return np.maximum(1, np.asarray(n) // (allowed(n, similarity) + 1))


def edit_distance(a: np.ndarray, b: np.ndarray, limit: int) -> int:
    """Edit distance of two sequences, or limit + 1 where it is larger. Only cells near the diagonal count."""
    if abs(len(a) - len(b)) > limit:
        return limit + 1
    far = limit + 1
    # Row i holds the distances of a[:i] to b[:j] for j from i - limit to i + limit.
    width = 2 * limit + 1
    place = np.arange(width)
    row = np.where((place >= limit) & (place - limit <= len(b)), place - limit, far)
    padded = np.concatenate([np.zeros(limit, np.uint64), b, np.zeros(len(a) + limit + 1, np.uint64)])
    inside = np.zeros(len(padded), bool)
    inside[limit : limit + len(b)] = True
    for i, x in enumerate(a, 1):
        # Word j - 1 of b is at limit + j - 1 of the padded words; j = i - limit + place.
        own = slice(i - 1, i - 1 + width)
        new = row + ((padded[own] != x) | ~inside[own])
        new[:-1] = np.minimum(new[:-1], row[1:] + 1)
        j = i - limit + place
        new[(j < 0) | (j > len(b))] = far
        if i <= limit:
            new[limit - i] = i
        # A run of insertions from any place before: the least of value minus place, plus place.
        row = np.minimum(np.minimum.accumulate(new - place) + place, far)
        row[(j < 0) | (j > len(b))] = far
        if row.min() >= far:
            return far
    return int(min(row[len(b) - len(a) + limit], far))


def walks_of(n: int) -> int:
    """Walks of an item of n words."""
    return WALKS + min(int(n), WALK_WORDS) // WORDS_PER_WALK


def walk_keys(sequences: np.ndarray, lengths: np.ndarray, seed: int, walks: int) -> np.ndarray:
    """Keys (sequences, walks) of sequences given as padded rows of hashes.

    A walk takes up to 2 n steps over n words. Each key is a hash of the words copied at
    ``SAMPLED`` steps; the steps and the first word are drawn from the length alone, so equal
    lengths sample alike.
    """
    count, width = sequences.shape
    keys = np.zeros((count, walks), np.uint64)
    rows = np.arange(count)[:, None]
    padded = np.concatenate([sequences, np.zeros((count, 1), np.uint64)], axis=1)
    salt = mix(np.arange(1, walks + 1, dtype=np.uint64) + np.uint64(seed * 100_003))
    draws = mix(np.arange(1, SAMPLED + 1, dtype=np.uint64)[None, :] * _STEP + salt[:, None])
    share = np.sort((draws >> np.uint64(11)).astype(np.float64) / float(1 << 53), axis=1)
    reach = np.minimum(lengths, WALK_WORDS)
    samples = (share[None] * np.maximum(1.6 * reach, 1)[:, None, None]).astype(np.int64)
    at = (np.arange(walks)[None, :] * (lengths - reach)[:, None]) // max(walks - 1, 1)
    ends = lengths[:, None]
    for step in range(int(samples.max()) + 1 if count else 0):
        word = np.where(at < ends, padded[rows, np.minimum(at, width)], np.uint64(0))
        for k in range(SAMPLED):
            due = samples[:, :, k] == step
            if due.any():
                keys[due] = mix(keys[due] * _STEP + word[due] + np.uint64(1))
        with np.errstate(over="ignore"):
            turn = salt + np.uint64(step) * _STEP
        at += (mix(word + turn[None, :]) >> np.uint64(63)).astype(np.int64)
    return keys


@dataclass
class Items:
    """A part of the benchmark, ready to be searched for."""

    ids: np.ndarray
    words: list[np.ndarray]
    lengths: np.ndarray
    edits: np.ndarray
    keys: list[np.ndarray]
    grams: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]  # by run length: hash, item, place


def embed(texts: pa.Array, seed: int = 1) -> list[tuple[np.ndarray, np.ndarray]]:
    """(words, walk keys) of each text."""
    w = words(texts, between=_BETWEEN)
    h = w.hashes()
    out = []
    for a, b in zip(w.first[:-1], w.first[1:]):
        own = h[a:b]
        out.append((own, walk_keys(own[None, :], np.array([b - a]), seed, walks_of(b - a))[0]))
    return out


def make_items(ids: list[int], embedded: list[tuple[np.ndarray, np.ndarray]], similarity: float) -> Items:
    """Items with words, of those given."""
    kept = [i for i, (own, _) in enumerate(embedded) if len(own)]
    sequences = [embedded[i][0] for i in kept]
    lengths = np.array([len(s) for s in sequences], np.int64)
    run = run_length(lengths, similarity)
    grams = {}
    for q in np.unique(run):
        found = [(_runs(sequences[i], int(q)), i) for i in np.flatnonzero(run == q)]
        value = np.concatenate([g for g, _ in found])
        item = np.concatenate([np.full(len(g), i) for g, i in found])
        place = np.concatenate([np.arange(len(g)) for g, _ in found])
        order = np.argsort(value, kind="stable")
        grams[int(q)] = (value[order], item[order], place[order])
    own_ids = np.array([ids[i] for i in kept], np.int64)
    return Items(own_ids, sequences, lengths, allowed(lengths, similarity), [embedded[i][1] for i in kept], grams)


def _runs(hashes: np.ndarray, q: int) -> np.ndarray:
    """Hashes of all runs of q words."""
    if len(hashes) < q:
        return np.zeros(0, np.uint64)
    rolled = hashes[: len(hashes) - q + 1].copy()
    for k in range(1, q):
        rolled = rolled * _STEP + hashes[k : len(hashes) - q + 1 + k]
    return mix(rolled)


def _diagonals(items: Items, w: Words, hashes: np.ndarray) -> np.ndarray:
    """Distinct (document, item, start) at which a shared run would be in its place, in words of the piece."""
    found = []
    doc = w.doc
    for q, (value, item, place) in items.grams.items():
        own = _runs(hashes, q)
        if not len(own):
            continue
        own_at = np.flatnonzero(doc[q - 1 :] == doc[: len(doc) - q + 1])
        left = np.searchsorted(value, own[own_at], "left")
        right = np.searchsorted(value, own[own_at], "right")
        hit = np.flatnonzero(right > left)
        # A few at a time: a run that is frequent in both makes many, most of them on one diagonal.
        times = right[hit] - left[hit]
        for part in np.array_split(np.arange(len(hit)), 1 + int(times.sum()) // CELLS):
            if not len(part):
                continue
            n = times[part]
            entry = np.repeat(left[hit[part]], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            at = np.repeat(own_at[hit[part]], n)
            found.append(np.unique(np.stack([doc[at], item[entry], at - place[entry]], axis=1), axis=0))
    return np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 3), np.int64)


def _starts(first: int, stop: int, diagonals: np.ndarray, edits: int) -> list[np.ndarray]:
    """Starts to compare, in two rounds: on the diagonals, then up to ``edits`` around them.

    Ranges around diagonals are joined before they are spread. Of a range as long as twice
    ``STARTS`` and more only every so many starts are taken.
    """
    near = np.unique(np.clip(diagonals, first, max(stop - 1, first)))
    step = max(1, edits // STARTS)
    low = np.maximum(near - edits, first)
    high = np.minimum(near + edits, max(stop - 1, first))
    new = np.ones(len(near), bool)
    new[1:] = low[1:] > high[:-1]
    ends = np.append(np.flatnonzero(new)[1:], len(near)) - 1
    around = np.concatenate([np.arange(a, b + 1, step) for a, b in zip(low[new], high[ends])])
    return [near, np.setdiff1d(around, near)]


def _alike(items: Items, i: int, hashes: np.ndarray, starts: np.ndarray, stop: int, seed: int) -> np.ndarray:
    """The starts whose window shares a key with item i."""
    n, walks = int(items.lengths[i]), len(items.keys[i])
    out = []
    for part in np.array_split(starts, 1 + len(starts) * max(n, walks) // CELLS):
        at = part[:, None] + np.arange(n)[None, :]
        rows = np.where(at < stop, hashes[np.minimum(at, len(hashes) - 1)], np.uint64(0))
        keys = walk_keys(rows, np.full(len(part), n), seed, walks)
        out.append(part[(keys == items.keys[i][None, :]).any(axis=1)])
    return np.concatenate(out)


def _search(items: Items, texts: pa.Array, seed: int) -> list[tuple[int, int, int, int, int]]:
    """(document, item, first word, words, edits) of the best window of each item in each document."""
    w = words(texts, between=_BETWEEN)
    hashes = w.hashes()
    near = _diagonals(items, w, hashes)
    cuts = np.flatnonzero((near[1:, :2] != near[:-1, :2]).any(axis=1)) + 1 if len(near) else []
    out = []
    for group in np.split(near, cuts) if len(near) else ():
        doc, i = int(group[0, 0]), int(group[0, 1])
        first, stop = int(w.first[doc]), int(w.first[doc + 1])
        n, limit = int(items.lengths[i]), int(items.edits[i])
        best = (limit + 1, 0, 0)
        for starts in _starts(first, stop, group[:, 2], limit):
            if best[0] == 0 or not len(starts):
                break
            for start in _alike(items, i, hashes, starts, stop, seed).tolist():
                end = min(start + n, stop)
                # An equal or a better one only: the limit falls.
                edits = edit_distance(items.words[i], hashes[start:end], min(limit, best[0]))
                best = min(best, (edits, start - first, end - start))
        if best[0] <= limit:
            out.append((doc, i, best[1], best[2], best[0]))
    return out


def contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, seed: int = 1) -> DataFrame:
    """(doc_id, item_id, start_word, n_words, edits) of benchmark items found in documents.

    An item of n words is found where a window of as many words is within ``(1 - similarity) * n``
    edits of it; items of fewer than ``LEAST_WORDS`` words have to occur as they are. One row per
    pair, the window with fewest edits, the first of them. Words are numbered as runs of letters
    and digits. Null or empty texts hold nothing and items without words are nowhere; rows that
    repeat an id give the best of them, null ids of documents count as one. Of items whose limit
    is ``STARTS`` edits and more, every so many starts around a shared run are compared.

    Items are embedded by tasks and broadcast in parts of about ``BROADCAST_BYTES``; a part is
    searched for, its rows are written and it is let go before the next.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def hits(shared: Broadcast) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = shared.value
            for batch in batches:
                ids = batch.column("doc_id")
                for row, texts in pieces(batch.column("text")):
                    found = np.array(_search(held, texts, seed), np.int64).reshape(-1, 5)
                    yield pa.RecordBatch.from_arrays(
                        [
                            ids.take(pa.array(found[:, 0] + row)),
                            pa.array(held.ids[found[:, 1]]),
                            pa.array(found[:, 2]),
                            pa.array(found[:, 3]),
                            pa.array(found[:, 4].astype(np.int32)),
                        ],
                        names=["doc_id", "item_id", "start_word", "n_words", "edits"],
                    )

        return rows.mapInArrow(lean(run), FOUND)

    out = None
    for shared, more in _parts(benchmark, similarity, seed):
        found = hits(shared)
        if more or out is not None:
            found = stage(found, "hits")
            shared.destroy()
        out = found if out is None else out.union(found)
    best = F.min(F.struct("edits", "start_word", "n_words")).alias("best")
    return out.groupBy("doc_id", "item_id").agg(best).select(
        "doc_id", "item_id", "best.start_word", "best.n_words", "best.edits"
    )


def _parts(benchmark: DataFrame, similarity: float, seed: int) -> Iterator[tuple[Broadcast, bool]]:
    """The benchmark, prepared, in broadcasts of a bounded size, and whether another follows.

    One empty one where it has no rows. Next to the bound a part holds one item at least.
    """
    items = benchmark.select(
        F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")
    ).where("item_id IS NOT NULL AND text IS NOT NULL")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, texts in pieces(batch.column("text")):
                found = embed(texts, seed)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("item_id").slice(row, len(texts)),
                        pa.array([own.tobytes() for own, _ in found], pa.binary()),
                        pa.array([keys.tobytes() for _, keys in found], pa.binary()),
                    ],
                    names=["item_id", "words", "keys"],
                )

    embedded = stage(items.mapInArrow(lean(run), "item_id long, words binary, keys binary"), "items")
    total = embedded.agg(F.coalesce(F.sum(F.length("words") + F.length("keys") + 64), F.lit(0))).first()[0]
    parts = 1 if total <= BROADCAST_BYTES else -(-2 * total // BROADCAST_BYTES)
    for part in range(parts):
        own = embedded.where(F.pmod(F.xxhash64("item_id", "words"), F.lit(parts)) == part)
        listed = sorted((r[0], bytes(r[1]), bytes(r[2])) for r in own.collect())  # half of the bound, about
        arrays = [(np.frombuffer(x, np.uint64), np.frombuffer(k, np.uint64)) for _, x, k in listed]
        made = make_items([r[0] for r in listed], arrays, similarity)
        yield benchmark.sparkSession.sparkContext.broadcast(made), part + 1 < parts
    drop_staged(embedded)


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, seed: int = 1
) -> DataFrame:
    """``docs`` without the rows that hold a benchmark item, as ``contaminated`` finds them.

    All columns are kept, repeated rows and rows without an id too; nothing is shuffled. A
    benchmark of several parts has the documents left by each written before the next.
    """
    for shared, more in _parts(benchmark, similarity, seed):

        def compute(texts: pa.Array, shared=shared) -> list[pa.Array]:
            leaks = np.zeros(len(texts), bool)
            leaks[[f[0] for f in _search(shared.value, texts, seed)]] = True
            return [pa.array(leaks)]

        name = f"{free_prefix(docs)}leaks"
        docs = add_columns(docs, compute, f"{name} boolean").where(~F.col(name)).drop(name)
        if more:
            docs = stage(docs, "clean")
            shared.destroy()
    return docs
