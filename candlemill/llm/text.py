"""Words, their hashes and shingles of whole Arrow string columns, by numpy.

A word is a maximal run of bytes other than space and 0x09 to 0x0D. Hashes are 64 bits wide and
the same in every process. Columns are cut into pieces of a bounded number of bytes, so that
memory does not depend on how many rows a batch has; only one long text can exceed it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from candlemill.llm.memory import at_end, lean

PIECE_BYTES = 1_000_000
SHINGLE = 5

_BASE = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD6E8FEB86659FD93)
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the output."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, 0 to n."""
    global _powers
    if len(_powers[0]) <= n:
        size = max(n + 1, PIECE_BYTES + 1)
        tables = []
        for base in (_BASE, _INVERSE):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            tables.append(np.cumprod(table, dtype=np.uint64))
        _powers = tuple(tables)
    return _powers


@at_end
def forget_tables() -> None:
    """Drop the tables of powers, which are as long as the longest piece so far."""
    global _powers
    _powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))


@dataclass
class Words:
    """Words of a piece: byte range and hash of each, and the first word of each document."""

    data: np.ndarray  # bytes of all texts, A to Z lower-cased if asked for
    offsets: np.ndarray  # bytes before each document, one longer than the documents
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray  # one longer than the documents

    def __len__(self) -> int:
        return len(self.first) - 1

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def doc(self) -> np.ndarray:
        """Document of each word."""
        return np.repeat(np.arange(len(self)), self.counts)

    def _sums(self) -> tuple[np.ndarray, np.ndarray]:
        power, inverse = _power_tables(len(self.data))
        sums = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum(_BYTE[self.data] * power[: len(self.data)], out=sums[1:])
        return sums, inverse

    def hashes(self) -> np.ndarray:
        sums, inverse = self._sums()
        return mix((sums[self.end] - sums[self.start]) * inverse[self.start])

    def prefix_hashes(self, lengths: tuple[int, ...]) -> list[np.ndarray]:
        """Hashes of the first so many bytes, for each length; 0 for words that are not longer."""
        sums, inverse = self._sums()
        out = []
        for n in lengths:
            longer = self.end - self.start > n
            stop = np.where(longer, self.start + n, self.start)
            h = mix((sums[stop] - sums[self.start]) * inverse[self.start] + np.uint64(n))
            out.append(np.where(longer, h, np.uint64(0)))
        return out

    def count_bytes(self, table: np.ndarray) -> np.ndarray:
        """Bytes of each document that the table of 256 flags holds."""
        sums = np.zeros(len(self.data) + 1, np.int64)
        np.cumsum(table[self.data], out=sums[1:])
        return np.diff(sums[self.offsets])


def pieces(column: pa.Array | pa.ChunkedArray, limit: int = PIECE_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """Cut a string column into (first row, rows) of at most ``limit`` bytes, one row at least."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    row = 0
    while row < len(column):
        last = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        last = min(max(last, row + 1), len(column))
        yield row, column.slice(row, last - row)
        row = last


def byte_table(chars: str) -> np.ndarray:
    """256 flags for ASCII characters."""
    table = np.zeros(256, bool)
    table[[ord(c) for c in chars]] = True
    return table


def words(
    texts: pa.Array,
    lower: bool = True,
    between: np.ndarray = _IS_SPACE,
    cut: tuple[np.ndarray, np.ndarray] | None = None,
) -> Words:
    """Words of a piece given by ``pieces``: runs of bytes that ``between`` does not flag.

    ``cut`` also parts a word after a byte of its first table before one of its second.
    """
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    if lower:
        data = _LOWER[data]
    n = len(data)
    is_word = ~between[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.ones(n, bool)  # a word may start here
    if n:
        before[1:] = ~is_word[:-1]
        if cut:
            before[1:] |= cut[0][data[:-1]] & cut[1][data[1:]]
    start = np.flatnonzero(is_word & (before | edge[:n]))
    after = np.ones(n, bool)
    if n:
        after[:-1] = ~is_word[1:] | before[1:]
    end = np.flatnonzero(is_word & (after | edge[1 : n + 1])) + 1
    return Words(data, offsets, start, end, np.searchsorted(start, offsets))


def shingles(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all five-word shingles in order, and the first shingle of each document.

    A document of one to four words has one shingle, of its whole sequence.
    """
    n = np.diff(first)
    of_doc = np.where(n >= SHINGLE, n - SHINGLE + 1, np.minimum(n, 1))
    begins = np.zeros(len(n) + 1, np.int64)
    np.cumsum(of_doc, out=begins[1:])
    out = np.zeros(begins[-1], np.uint64)
    if len(hashes) >= SHINGLE:
        rolled = hashes[: len(hashes) - SHINGLE + 1].copy()
        for k in range(1, SHINGLE):
            rolled = rolled * _STEP + hashes[k : len(hashes) - SHINGLE + 1 + k]
        long = n >= SHINGLE
        take = np.repeat(first[:-1][long] - begins[:-1][long], of_doc[long])
        put = np.flatnonzero(np.repeat(long, of_doc))
        out[put] = mix(rolled[take + put])
    for doc in np.flatnonzero((n > 0) & (n < SHINGLE)):
        value = n[doc].astype(np.uint64)
        for h in hashes[first[doc] : first[doc + 1]]:
            with np.errstate(over="ignore"):
                value = value * _STEP + h
        out[begins[doc]] = mix(np.array([value], np.uint64) ^ _BASE)[0]
    return out, begins


def repeated_window_words(w: Words, hashes: np.ndarray) -> np.ndarray:
    """Words of each document in windows of three words that occur in it twice or more."""
    marked = np.zeros(len(hashes), bool)
    if len(hashes) >= 3:
        doc = w.doc
        whole = np.flatnonzero(doc[2:] == doc[:-2])
        rolled = (hashes[:-2] * _STEP + hashes[1:-1]) * _STEP + hashes[2:]
        key = mix(rolled[whole]) ^ mix(doc[whole].astype(np.uint64) + _BASE)
        order = np.argsort(key, kind="stable")
        same = key[order][1:] == key[order][:-1]
        twice = np.zeros(len(key), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        for k in range(3):
            marked[whole[twice] + k] = True
    sums = np.zeros(len(hashes) + 1, np.int64)
    np.cumsum(marked, out=sums[1:])
    return np.diff(sums[w.first])


def duplicate_lines(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lines with a word that equal an earlier line, and all lines with a word, of each text."""
    again, lines = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
    for doc, text in enumerate(texts.to_pylist()):
        seen = set()
        for line in text.split("\n"):
            if line.strip(" \t\n\v\f\r"):
                lines[doc] += 1
                if line in seen:
                    again[doc] += 1
                else:
                    seen.add(line)
    return again, lines


def free_prefix(df: DataFrame) -> str:
    """Underscores that no column of ``df`` starts with, for names of helper columns."""
    prefix = "_"
    while any(c.startswith(prefix) for c in df.columns):
        prefix += "_"
    return prefix


def add_columns(
    df: DataFrame, compute: Callable[[pa.Array], list[pa.Array]], fields: str, text: str = "text"
) -> DataFrame:
    """``df`` with columns that ``compute`` makes of pieces of its text column (null: empty).

    They replace columns of ``df`` with the same names, which must not be the text column's.
    """
    names = [f.split()[0] for f in fields.split(", ")]
    clash = {n.lower() for n in names}
    df = df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in clash])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, texts in pieces(batch.column(text)):
                part = batch.slice(row, len(texts))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, *compute(texts)], names=[*part.schema.names, *names]
                )

    return df.mapInArrow(lean(run), StructType([*df.schema.fields, *StructType.fromDDL(fields).fields]))


def set_similarity(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """Sizes of the intersection and union of two sets given as sorted distinct values."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both, len(a) + len(b) - both
