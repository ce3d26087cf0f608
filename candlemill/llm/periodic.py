"""Periodic runs of words, by a suffix automaton whose links are kept as a link-cut tree.

A document's words are appended to a suffix automaton one by one. Every state's strings end last
at one place, its colour, and appending word t recolours the path from the new state to the root
with t. The link tree is cut into paths of one colour; access to the new state walks over them. A
path of colour e whose longest string has L words says that the last L words stood before, ending
at word e: at a distance of q = t - e, a square for every L >= q, and four periods in a row for
L >= 3 q. That e is the last such place, so q is the smallest period. Such a repetition is
extended to both sides to the whole run.

Only stretches of a document that can hold a run go through the automaton: in a run of four
periods or more, and six words or more, each three words in a row occur three times at least. The
rest of the work is a sort of each document's word triples. Documents are independent: nothing is
shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from candlemill.llm.memory import lean
from candlemill.llm.text import pieces

PERIODS = 4
LEAST_LENGTH = 6

Run = tuple[int, int, int]  # first word, words, smallest period
RUNS = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


class LastPlaces:
    """A suffix automaton with the last place of every state, recoloured by link-cut access."""

    def __init__(self) -> None:
        # State 0 is none, state 1 the empty string.
        self.next: list[dict] = [{}, {}]
        self.link, self.length = [0, 0], [0, 0]
        # Splay trees of the paths, by depth; a tree's root has its path's colour and, as parent,
        # the state that its path hangs from.
        self.parent, self.left, self.right, self.colour = [0, 0], [0, 0], [0, 0], [-1, -1]
        self.last = 1
        self.words = 0

    def _state(self, length: int, link: int, transitions: dict) -> int:
        self.next.append(transitions)
        self.link.append(link)
        self.length.append(length)
        self.parent.append(link)
        self.left.append(0)
        self.right.append(0)
        self.colour.append(-1)
        return len(self.length) - 1

    def _splay(self, x: int) -> None:
        """Make x the root of its splay tree."""
        parent, left, right = self.parent, self.left, self.right
        while True:
            y = parent[x]
            if not y or (left[y] != x and right[y] != x):
                return
            z = parent[y]
            inner = z and (left[z] == y or right[z] == y)
            if inner and (left[z] == y) == (left[y] == x):
                self._rotate(y)
            elif inner:
                self._rotate(x)
            self._rotate(x)

    def _rotate(self, x: int) -> None:
        parent, left, right = self.parent, self.left, self.right
        y = parent[x]
        z = parent[y]
        if left[y] == x:
            b = right[x]
            left[y], right[x] = b, y
        else:
            b = left[x]
            right[y], left[x] = b, y
        if b:
            parent[b] = y
        parent[y], parent[x] = x, z
        if z and left[z] == y:
            left[z] = x
        elif z and right[z] == y:
            right[z] = x
        else:
            self.colour[x] = self.colour[y]

    def _split(self, q: int, length: int) -> int:
        """A state for the strings of q up to ``length``, between q and its link, on q's path."""
        clone = self._state(length, self.link[q], dict(self.next[q]))
        self._splay(q)
        above = self.left[q]
        self.left[clone], self.parent[clone] = above, q
        if above:
            self.parent[above] = clone
        self.left[q] = clone
        self.link[q] = clone
        return clone

    def append(self, word) -> list[tuple[int, int]]:
        """Append a word: (place, length) of each path above it, the longest first.

        The last ``length`` words stood before, and last ended at word ``place``.
        """
        following, link, length = self.next, self.link, self.length
        at = self.words
        self.words += 1
        p = self.last
        new = self._state(length[p] + 1, 1, {})
        while p and word not in following[p]:
            following[p][word] = new
            p = link[p]
        if p:
            q = following[p][word]
            if length[q] != length[p] + 1:
                clone = self._split(q, length[p] + 1)
                while p and following[p].get(word) == q:
                    following[p][word] = clone
                    p = link[p]
                q = clone
            link[new] = self.parent[new] = q
        else:
            link[new] = self.parent[new] = 1
        self.last = new
        # Access: join the paths from the new state to the root into one of colour t.
        found = []
        parent, right, colour = self.parent, self.right, self.colour
        below, x = new, parent[new]
        while x:
            self._splay(x)
            if colour[x] >= 0 and length[x]:
                found.append((colour[x], length[x]))
            if right[x]:
                colour[right[x]] = colour[x]
            right[x] = below
            below, x = x, parent[x]
        self._splay(new)
        colour[new] = at
        return found


def _zones(ids: np.ndarray) -> list[tuple[int, int]]:
    """Stretches [first, stop) of words whose triples all occur three times or more."""
    n = len(ids)
    if n < LEAST_LENGTH:
        return []
    if n < 2_000_000:
        triples = (ids[:-2] * n + ids[1:-1]) * n + ids[2:]
    else:
        pairs = np.unique(ids[:-1] * n + ids[1:], return_inverse=True)[1]
        triples = pairs[:-1] * n + ids[2:]
    order = np.argsort(triples, kind="stable")
    ranked = triples[order]
    many = ranked[2:] == ranked[:-2]
    if not many.any():
        return []
    flags = np.zeros(n, bool)
    for k in range(3):
        flags[order[k : len(order) - 2 + k][many]] = True
    edges = np.flatnonzero(np.diff(np.concatenate([[False], flags, [False]]).astype(np.int8)))
    return [(a, b + 2) for a, b in edges.reshape(-1, 2).tolist() if b - a + 2 >= LEAST_LENGTH]


def find_runs(words: list) -> list[Run]:
    """Runs of a sequence of hashable words: (start, length, period), by start, then period.

    A run is a stretch with smallest period q and at least ``max(6, 4 q)`` words that no
    neighbouring word extends.
    """
    n = len(words)
    place = dict(zip(words, range(n)))
    ids = np.fromiter(map(place.__getitem__, words), np.int64, n)
    runs: set[Run] = set()
    for first, stop in _zones(ids):
        seen: dict[int, int] = {}  # end of the last run by period
        places = LastPlaces()
        for t in range(first, stop):
            for before, length in places.append(words[t]):
                q = t - first - before
                if length < (PERIODS - 1) * q or seen.get(q, -1) >= t:
                    continue
                a, b = t - PERIODS * q + 1, t + 1
                while a and words[a - 1] == words[a - 1 + q]:
                    a -= 1
                while b < n and words[b] == words[b - q]:
                    b += 1
                seen[q] = b - 1
                if b - a >= max(LEAST_LENGTH, PERIODS * q):
                    runs.add((a, b - a, q))
    return sorted(runs, key=lambda r: (r[0], r[2]))


def strongest(runs: list[Run]) -> Run | None:
    """The run of the greatest length / period; ties go to the smallest start, then period."""
    return min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)


def collapse(words: list, runs: list[Run]) -> list:
    """The words outside of all runs, and the first period of each that no other run covers."""
    if not runs:
        return words
    gone = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    kept = np.cumsum(gone[:-1]) == 0
    return [words[i] for i in np.flatnonzero(kept)]


def periodic_runs(docs: DataFrame, change: Callable[[int | None, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of every row of ``docs (doc_id, text)``.

    ``runs`` has every run (start, length, period) by start, then period; ``collapsed`` the words
    that no run contains after its first period, joined by one space. ``change`` may replace a
    document's words before. Words are runs of bytes other than space and 0x09 to 0x0D, compared
    as they are.

    A null text has no words, like an empty one: no runs and an empty ``collapsed``. Rows stand
    for themselves: repeated ids and texts and null ids give a row each. Ties do not arise, as
    runs are ordered in full. Other columns are not read; an empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            all_ids = batch.column("doc_id").to_pylist()
            for row, texts in pieces(batch.column("text")):
                ids = all_ids[row : row + len(texts)]
                counts, flat, ends, out = [], [], [0], []
                for doc_id, text in zip(ids, texts.cast(pa.large_binary()).to_pylist()):
                    words = text.split()
                    if change:
                        words = change(doc_id, words)
                    runs = find_runs(words)
                    counts.append(len(words))
                    flat += runs
                    ends.append(len(flat))
                    out.append(b" ".join(collapse(words, runs)))
                columns = np.array(flat, np.int64).reshape(-1, 3)
                struct = pa.StructArray.from_arrays(
                    [pa.array(columns[:, k]) for k in range(3)], names=["start", "length", "period"]
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids, pa.int64()),
                        pa.array(counts, pa.int64()),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), struct),
                        pa.array(out, pa.binary()).cast(pa.string()),
                    ],
                    names=["doc_id", "n_words", "runs", "collapsed"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(lean(run), StructType.fromDDL(RUNS))


def digest(runs: DataFrame) -> DataFrame:
    """One row per row of ``periodic_runs``: its strongest run and checksums of runs and words."""
    text = F.concat_ws(
        "", F.transform("runs", lambda r: F.format_string("%d,%d,%d\n", r["start"], r["length"], r["period"]))
    )

    def stronger(best, r):
        # a / b > c / d for positive numbers is a * d > c * b; runs come by start, then period.
        return F.when(best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best)

    best = F.aggregate("runs", F.expr("cast(null as struct<start:long,length:long,period:long>)"), stronger)
    rows = runs.withColumn("best", best)
    return rows.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(text.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
        "n_words",
    )
