"""Repeated strings of bytes, by a suffix array built with difference covers.

A suffix per byte would take many times the corpus on disk, so texts are cut first, where their
content says: the least hash of 16 bytes among 160 places in a row is a cut, and the bytes between
two cuts are a token. Two equal strings of 400 bytes have the same cuts, but for their ends, and a
whole token at least. A token that occurs once is in no repeated string, so only stretches of
tokens that occur again are sorted.

Suffixes of tokens are sorted by the difference cover of 3: triples at places 1 and 2 of every
three are sorted and named, their order is found by recursion on those names that are neither the
only ones nor as long as a repeated string has to be, and the remaining third, sorted by its first
token and the place of the suffix behind it, is merged in: each suffix's place is its place in its
own order plus the number of the others before it, which two sorts with plain keys give. Adjacent
suffixes with an equal prefix of whole tokens and 400 bytes or more are repeated.

What that leaves open are strings that begin or end within a token at the end of a repeated
stretch. These remaining suffixes, which start between two cuts, are merged with one each of the
repeated ones that hold the same token. Sixteen neighbours at a time, counted from their next cut,
are sorted by the 415 bytes that hold all of them, which prove them repeated if adjacent ones are
equal, and looked up by the 385 bytes that are in each, which have to occur elsewhere. Those still
open are sorted one by one by their 400 bytes. So the result is exact to the byte.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from candlemill.llm.memory import at_end, lean
from candlemill.llm.sorting import counted, ordered, paired
from candlemill.llm.text import _BYTE, mix, pieces
from candlemill.sources.staging import drop_staged, stage

LENGTH = 400
SEED = 16
PLACES = 160
# A string's windows of places start at its bytes 0 to LAST.
LAST = LENGTH - SEED - PLACES + 1

# Equal names of so many bytes need no order: a string of each start in a first token is in them.
REACH = LENGTH + PLACES
# Strings compared at once.
NEAR = 16
# So many keys, of 8 bytes each in a broadcast; with a longer list all texts are shuffled.
BROADCAST_IDS = 8_000_000

SEGMENT = 1 << 20
CACHED = 1 << 16
_BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
_LOW = np.uint64(SEGMENT - 1)

CUTS = (
    "sid long, k1 long, k2 long, n_bytes long, first_cut int, tokens array<long>, lengths array<short>, back array<short>"
)
SUFFIXES = "sid long, i long, s long, s1 long, s2 long, b long, e3 long, stop long, print long"
STRINGS = "sid long, start long, stop long, open boolean, cut long, token long, context long, offset long"
BLOCKS = "sid long, at long, start long, stop long, open boolean, inner long, o1 long, o2 long"
PRINTS = "sid long, at long, open boolean, f1 long, f2 long"
SPANS = "array<struct<start:long,stop:long>>"


def _powers(base: np.uint64, n: int) -> tuple[np.ndarray, np.ndarray]:
    tables = []
    for value in (base, np.uint64(pow(int(base), -1, 1 << 64))):
        table = np.full(n, value, np.uint64)
        table[:1] = 1
        tables.append(np.cumprod(table, dtype=np.uint64))
    return tuple(tables)


_tables: dict[int | str, tuple[np.ndarray, np.ndarray]] = {}
at_end(_tables.clear)


def byte_hashes(data: np.ndarray, start: np.ndarray, stop: np.ndarray, base: int = 0) -> np.ndarray:
    """Hashes of the strings [start, stop) of at most ``LENGTH + NEAR`` bytes; starts ascend."""
    if base not in _tables:
        _tables[base] = _powers(_BASES[base], SEGMENT + LENGTH + NEAR + 1)
    power, inverse = _tables[base]
    out = np.empty(len(start), np.uint64)
    for x in range(0, max(len(data), 1), SEGMENT):
        a, b = np.searchsorted(start, [x, x + SEGMENT])
        if a == b:
            continue
        part = data[x : x + SEGMENT + LENGTH + NEAR]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_BYTE[part] * power[: len(part)], out=sums[1:])
        out[a:b] = mix((sums[stop[a:b] - x] - sums[start[a:b] - x]) * inverse[start[a:b] - x])
    return out


def seed_hashes(data: np.ndarray) -> np.ndarray:
    """``byte_hashes`` of the strings of ``SEED`` bytes at all places, by parts that stay in cache."""
    if 0 not in _tables:
        _tables[0] = _powers(_BASES[0], SEGMENT + LENGTH + NEAR + 1)
    power, inverse = _tables[0]
    count = max(len(data) - SEED + 1, 0)
    out = np.empty(count, np.uint64)
    for x in range(0, count, CACHED):
        part = data[x : min(x + CACHED, count) + SEED - 1]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_BYTE[part] * power[: len(part)], out=sums[1:])
        own = sums[SEED:] - sums[:-SEED]
        own *= inverse[: len(own)]
        out[x : x + CACHED] = mix(own)
    return out


def run_hashes(tokens: np.ndarray, first: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Hashes of runs [first, stop) of tokens."""
    if "runs" not in _tables or len(_tables["runs"][0]) <= len(tokens):
        _tables["runs"] = _powers(_BASES[1], 2 * len(tokens) + 1024)
    power, inverse = _tables["runs"]
    sums = np.zeros(len(tokens) + 1, np.uint64)
    np.cumsum(mix(tokens) * power[: len(tokens)], out=sums[1:])
    return mix((sums[stop] - sums[first]) * inverse[first])


def least_places(hashes: np.ndarray) -> np.ndarray:
    """Place of the least (first 44 bits, the first of equal ones) of each ``PLACES`` hashes in a row."""
    count = len(hashes) - PLACES + 1
    out = np.empty(max(count, 0), np.int64)
    step = CACHED
    for x in range(0, max(count, 0), step):
        part = hashes[x : x + step + PLACES - 1]
        keys = np.full(-(-len(part) // PLACES) * PLACES, ~np.uint64(0))
        keys[: len(part)] = (part & ~_LOW) | np.arange(len(part), dtype=np.uint64)
        blocks = keys.reshape(-1, PLACES)
        ahead = np.minimum.accumulate(blocks, axis=1).ravel()
        behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        own = len(part) - PLACES + 1
        out[x : x + own] = (np.minimum(behind[:own], ahead[PLACES - 1 : PLACES - 1 + own]) & _LOW).astype(np.int64) + x
    return out


def cut(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, window, cut): cuts of the texts and the first window of each, as places in ``data``.

    Texts shorter than ``LENGTH`` have none.
    """
    none = np.zeros(0, np.int64)
    if len(data) < LENGTH:
        return none, none, none
    least = least_places(seed_hashes(data))
    count = np.maximum(np.diff(offsets) - (SEED + PLACES - 2), 0)
    count[np.diff(offsets) < LENGTH] = 0
    doc = np.repeat(np.arange(len(count)), count)
    window = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count) + offsets[:-1][doc]
    at = least[window]
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1]) | (doc[1:] != doc[:-1])
    return doc[new], window[new], at[new]


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, and their offsets."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def _cuts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, texts in pieces(batch.column("text")):
            data, offsets = _bytes(texts)
            doc, window, at = cut(data, offsets)
            first = np.searchsorted(doc, np.arange(len(texts) + 1))
            whole = np.flatnonzero(doc[1:] == doc[:-1]) if len(doc) else doc
            tokens = byte_hashes(data, at[whole], at[whole + 1])
            tokens[tokens == 0] = 1  # 0 stands for the end of a stretch
            token_ends = np.searchsorted(whole, first)
            starts = np.zeros(len(texts), np.int32)
            starts[doc[::-1]] = (at - offsets[:-1][doc])[::-1]
            part = batch.slice(row, len(texts))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("k1"),
                    part.column("k2"),
                    pa.array(np.diff(offsets)),
                    pa.array(starts),
                    pa.ListArray.from_arrays(pa.array(token_ends, pa.int32()), pa.array(tokens.view(np.int64))),
                    pa.ListArray.from_arrays(
                        pa.array(token_ends, pa.int32()), pa.array((at[whole + 1] - at[whole]).astype(np.int16))
                    ),
                    pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array((at - window).astype(np.int16))),
                ],
                names=["k1", "k2", "n_bytes", "first_cut", "tokens", "lengths", "back"],
            )


def _arrays(batch: pa.RecordBatch, name: str, kind) -> list[np.ndarray]:
    column = batch.column(name)
    ends = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False)
    return [
        values[a:b].astype(kind) if column[i].is_valid else np.zeros(0, kind)
        for i, (a, b) in enumerate(zip(ends[:-1], ends[1:]))
    ]


class Cut:
    """Cuts and tokens of one text."""

    def __init__(self, n_bytes, first_cut, tokens, lengths, back, shared):
        self.n_bytes = n_bytes
        self.tokens = tokens.view(np.uint64)
        self.cuts = first_cut + np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
        self.windows = self.cuts - back  # first string whose first cut is this one
        self.shared = np.zeros(len(tokens), bool)
        self.shared[shared] = True


def _each(batch: pa.RecordBatch) -> Iterator[tuple[int, Cut]]:
    columns = [_arrays(batch, n, np.int64) for n in ("tokens", "lengths", "back", "shared")]
    rows = zip(batch.column("sid").to_pylist(), batch.column("n_bytes").to_pylist(), batch.column("first_cut").to_pylist())
    for k, (sid, n_bytes, first_cut) in enumerate(rows):
        if len(columns[0][k]):
            yield k, Cut(n_bytes, first_cut, *[c[k] for c in columns])


def _batch(columns: list[list[np.ndarray]], ddl: str) -> pa.RecordBatch:
    fields = [f.split()[:2] for f in ddl.split(", ")]
    kinds = {"long": pa.int64(), "boolean": pa.bool_(), "int": pa.int32()}
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.concatenate(c) if c else np.zeros(0), kinds[k]) if k == "boolean"
            else pa.array(np.concatenate(c).astype(np.int64, copy=False) if c else np.zeros(0, np.int64), kinds[k])
            for c, (_, k) in zip(columns, fields)
        ],
        names=[n for n, _ in fields],
    )


def _suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Suffixes of the stretches of shared tokens that are long enough for a repeated string.

    A token that repeats itself, as it does in one letter or word over and over, is one symbol with
    the times that it stands there, or the names of such stretches would never be done. What
    starts within is left open.
    """
    for batch in batches:
        sids = batch.column("sid").to_pylist()
        columns: list[list[np.ndarray]] = [[] for _ in range(9)]
        for k, text in _each(batch):
            edges = np.flatnonzero(np.diff(np.concatenate([[False], text.shared, [False]]).astype(np.int8)))
            for x, y in edges.reshape(-1, 2):
                if text.cuts[y] - text.cuts[x] < LENGTH:
                    continue
                alike = text.tokens[x:y]
                head = np.flatnonzero(np.append(True, alike[1:] != alike[:-1]))
                times = np.diff(np.append(head, y - x)).astype(np.uint64)
                symbols = np.where(times > 1, mix(alike[head] + times), alike[head])
                place = text.cuts[np.append(x + head, y)]
                n = len(head)
                own = np.arange(n)
                # The tokens that hold all strings that start in the first, or one at least.
                last = np.searchsorted(place, place[1:] - 1 + LENGTH)
                short = np.searchsorted(place, place[:-1] + LENGTH)
                last = np.where((last <= n) & (place[1:] - place[:-1] <= PLACES), last, short)
                whole = last <= n
                prints = run_hashes(symbols, own, np.minimum(last, n)).view(np.int64)
                tokens = np.concatenate([symbols.view(np.int64), [0, 0, 0]])
                row = [
                    np.full(n, sids[k]),
                    x + own,
                    tokens[own],
                    tokens[own + 1],
                    tokens[own + 2],
                    place[:-1],
                    place[np.minimum(own + 3, n)],
                    np.where(whole, place[np.minimum(last, n)], -1),
                    prints,
                ]
                for column, values in zip(columns, row):
                    column.append(values)
        yield _batch(columns, SUFFIXES)


def name_triples(suffixes: DataFrame) -> DataFrame:
    """Names of the triples at places 1 and 2 of three, in their order: (s, s1, s2, name, done).

    A name is done if it occurs once, reaches ``REACH`` bytes or reaches the end of its stretch.
    """
    triples = (
        suffixes.where("i % 3 <> 0")
        .groupBy("s", "s1", "s2")
        .agg((F.expr(f"count(*) = 1 OR min(e3 - b) >= {REACH}") | (F.col("s2") == 0)).alias("done"))
    )
    return stage(ordered(triples, ["s", "s1", "s2"]).withColumn("name", F.monotonically_increasing_id() + 1), "names")


def suffix_ranks(suffixes: DataFrame) -> DataFrame:
    """(sid, i, rank) of ``suffixes (sid, i, s, s1, s2, b, e3)``: places in the order of the suffixes.

    A suffix starts with symbol s at place i of string sid, followed by s1 and s2; 0 is the end.
    It starts at byte b, and its first three symbols end before e3. Suffixes that are equal for
    ``REACH`` bytes, or to their ends, come in any order; no other is between them.
    """
    names = name_triples(suffixes)
    named = suffixes.where("i % 3 <> 0").join(names, ["s", "s1", "s2"]).select("sid", "i", "name", "done", "b", "e3")
    if not names.where("NOT done").limit(1).count():
        return merge(suffixes, named.select("sid", "i", "name", F.lit(0).cast("long").alias("finer")))
    # The names at places 1, then those at places 2, with a gap between. A name that is done ends
    # a string: only names that are not, and those right behind them, go on.
    base = suffixes.agg(F.max("i")).first()[0] // 3 + 2
    place = F.expr(f"i div 3 + if(i % 3 = 1, 0, {base})")
    named = stage(named.select("sid", place.alias("i"), F.col("name").alias("s"), "done", "b", F.col("e3").alias("e")), "named")
    by_text = W.partitionBy("sid").orderBy("i")
    behind = (F.lag("i").over(by_text) == F.col("i") - 1) & ~F.lag("done").over(by_text)
    shorter = named.withColumn("behind", F.coalesce(behind, F.lit(False))).where("behind OR NOT done")
    one, two = F.lead("i", 1).over(by_text) == F.col("i") + 1, F.lead("i", 2).over(by_text) == F.col("i") + 2
    inner = stage(
        shorter.select(
            "sid",
            "i",
            "s",
            F.when(one, F.lead("s", 1).over(by_text)).otherwise(0).alias("s1"),
            F.when(two, F.lead("s", 2).over(by_text)).otherwise(0).alias("s2"),
            "b",
            F.when(two, F.lead("e", 2).over(by_text)).otherwise(F.col("e")).alias("e3"),
        ),
        "inner",
    )
    ranks = suffix_ranks(inner)
    drop_staged(inner)
    finer = F.when(F.col("done"), 0).otherwise(F.coalesce("rank", F.lit(0)))
    place = F.expr(f"if(i < {base}, 3 * i + 1, 3 * (i - {base}) + 2)")
    known = named.join(ranks, ["sid", "i"], "left").select("sid", place.alias("i"), F.col("s").alias("name"), finer.alias("finer"))
    merged = merge(suffixes, known)
    drop_staged(ranks)
    drop_staged(named)
    drop_staged(names)
    return merged


def merge(suffixes: DataFrame, known: DataFrame) -> DataFrame:
    """Ranks of all suffixes from the order ``known (sid, i, name, finer)`` of those at places 1 and 2 of three."""
    own = ["sid", "i"]
    sampled = counted(known.withColumn("third", F.lit(False)), ["name", "finer", *own], "third")
    sampled = sampled.select(*own, (F.col("before") + 1).alias("known"))
    by_text = W.partitionBy("sid").orderBy("i")

    def behind(k: int):
        there = F.lead("i", k).over(by_text) == F.col("i") + k
        return F.coalesce(F.when(there, F.lead("known", k).over(by_text)), F.lit(0))

    rows = stage(
        suffixes.select(*own, "s", "s1")
        .join(sampled, own, "left")
        .select(*own, "s", "s1", "known", behind(1).alias("r1"), behind(2).alias("r2")),
        "known",
    )
    third = (F.col("i") % 3 == 0).alias("third")
    # Each sort has the suffixes of a place, or two, of three: who is before whom is known there.
    near = counted(rows.where("i % 3 <> 2").select(*own, "s", "r1", third), ["s", "r1", *own], "third")
    far = counted(rows.where("i % 3 <> 1").select(*own, "s", "s1", "r2", third), ["s", "s1", "r2", *own], "third")
    others = F.col("before") - F.col("flags_before")
    places = (
        near.select(*own, F.when(F.col("third"), F.col("before")).otherwise(F.col("flags_before")).alias("n"))
        .union(far.select(*own, F.when(F.col("third"), others).otherwise(F.col("flags_before")).alias("n")))
        .union(rows.where("known IS NOT NULL").select(*own, (F.col("known") - 1).alias("n")))
    )
    ranks = stage(places.groupBy(*own).agg((F.sum("n") + 1).alias("rank")), "ranks")
    for used in (rows, near, far, sampled):
        drop_staged(used)
    return ranks


def _strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ranges of strings that whole tokens leave open, and of those that they prove repeated."""
    for batch in batches:
        sids = batch.column("sid").to_pylist()
        proven = batch.column("proven").to_pylist()
        columns: list[list[np.ndarray]] = [[] for _ in range(8)]
        for k, text in _each(batch):
            strings = text.n_bytes - LENGTH + 1
            spans = np.array([(p["b"], p["stop"]) for p in proven[k] or ()], np.int64).reshape(-1, 2)
            spans = spans[np.argsort(spans[:, 0], kind="stable")]
            reach = np.maximum.accumulate(spans[:, 1])
            bounds = [[0, strings], text.windows, text.windows - LAST, spans[:, 0], spans[:, 1] - LENGTH + 1]
            bounds = np.unique(np.clip(np.concatenate(bounds), 0, strings))
            start, stop = bounds[:-1], bounds[1:]
            first = np.searchsorted(text.windows, start, "right") - 1
            last = np.searchsorted(text.windows, start + LAST, "right") - 1
            counts = np.concatenate([[0], np.cumsum(text.shared)])
            shared = counts[last] - counts[first] == last - first
            within = np.searchsorted(spans[:, 0], start, "right")
            sure = np.zeros(len(start), bool)
            sure[within > 0] = reach[within[within > 0] - 1] >= start[within > 0] + LENGTH
            kept = np.flatnonzero(shared | sure)
            if not len(kept):
                continue
            start, stop, first, sure = start[kept], stop[kept], first[kept], sure[kept]
            # Ranges of one first cut and kind are one.
            new = np.ones(len(start), bool)
            new[1:] = (start[1:] != stop[:-1]) | (first[1:] != first[:-1]) | (sure[1:] != sure[:-1])
            head = np.flatnonzero(new)
            start, stop = start[head], stop[np.append(head[1:], len(stop)) - 1]
            first, sure = first[head], sure[head]
            # Whole tokens around a range tell equal ranges apart from others; at the ends of a
            # text a range stands for itself.
            low = np.searchsorted(text.cuts, start, "right") - 1
            high = np.searchsorted(text.cuts, stop - 1 + LENGTH)
            inside = (low >= 0) & (high < len(text.cuts))
            low, high = np.maximum(low, 0), np.minimum(high, len(text.cuts) - 1)
            context = run_hashes(text.tokens, low, np.maximum(high, low)).view(np.int64)
            row = [
                np.full(len(start), sids[k]),
                start,
                stop,
                ~sure,
                text.cuts[first],
                text.tokens[first].view(np.int64),
                np.where(inside, context, sids[k]),
                np.where(inside, start - text.cuts[low], -1 - start),
            ]
            for column, values in zip(columns, row):
                column.append(values)
        yield _batch(columns, STRINGS)


def _spread(first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(range, number) of ``count`` numbers from ``first`` on for each range."""
    of = np.repeat(np.arange(len(count)), count)
    return of, first[of] + np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, dict[str, np.ndarray]]]:
    """Bytes of a piece, the offsets of its texts, and the ranges of all with their text's number and sid."""
    for batch in batches:
        sids, column = batch.column("sid").to_numpy(), batch.column("ranges")
        ends, values = column.offsets.to_numpy(), column.values
        fields = {f.name: values.field(f.name).to_numpy(zero_copy_only=False).astype(np.int64) for f in values.type}
        for row, texts in pieces(batch.column("text")):
            data, offsets = _bytes(texts)
            own = slice(ends[row], ends[row + len(texts)])
            of = np.repeat(np.arange(len(texts)), np.diff(ends[row : row + len(texts) + 1]))
            ranges = {name: x[own] for name, x in fields.items()}
            yield data, offsets, ranges | {"of": of, "sid": sids[row + of]}


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ranges by ``NEAR`` strings, with hashes of what is in each of the strings and of what holds all."""
    for data, offsets, ranges in _texts(batches):
        least = (ranges["cut"] - ranges["stop"] + 1) // NEAR
        of, k = _spread(least, (ranges["cut"] - ranges["start"]) // NEAR - least + 1)
        sid, start, stop, open_, text = (ranges[n][of] for n in ("sid", "start", "stop", "open", "of"))
        at = ranges["cut"][of] - NEAR * k - (NEAR - 1)
        order = np.lexsort((-open_, k, at, text))
        sid, start, stop, open_, text, k, at = (x[order] for x in (sid, start, stop, open_, text, k, at))
        first = at + offsets[text]
        inner = byte_hashes(data, first + NEAR - 1, first + LENGTH)
        # Of ranges of the same sixteen only one stands for them, or they would be adjacent.
        alone = np.ones(len(at), bool)
        alone[1:] = (at[1:] != at[:-1]) | (k[1:] != k[:-1]) | (text[1:] != text[:-1])
        inside = (at >= 0) & (first + NEAR - 1 + LENGTH <= offsets[text + 1])
        whole = np.flatnonzero(alone & inside)
        # The distance to the next cut is a part of the hash: two cuts of a text may count a place.
        salt = mix(k.astype(np.uint64) + np.uint64(1))
        start, stop = np.maximum(at, start), np.minimum(at + NEAR, stop)
        outer = [sid.astype(np.uint64), (-1 - start).astype(np.uint64)]
        for base in (0, 1):
            found = byte_hashes(data, first[whole], first[whole] + NEAR - 1 + LENGTH, base)
            outer[base][whole] = mix(found ^ salt[whole])
        hashes = [x.view(np.int64) for x in (mix(inner ^ salt), *outer)]
        yield _batch([[x] for x in (sid, at, start, stop, open_.astype(bool), *hashes)], BLOCKS)


def _prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Two hashes of each string in the ranges of texts."""
    for data, offsets, ranges in _texts(batches):
        of, at = _spread(ranges["start"], ranges["stop"] - ranges["start"])
        order = np.lexsort((at, ranges["of"][of]))
        of, at = of[order], at[order]
        first = at + offsets[ranges["of"][of]]
        prints = [byte_hashes(data, first, first + LENGTH, base).view(np.int64) for base in (0, 1)]
        yield _batch([[ranges["sid"][of]], [at], [ranges["open"][of].astype(bool)], *[[x] for x in prints]], PRINTS)


def of_keys(docs: DataFrame, wanted: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """The rows of ``docs`` whose k1 the staged ``wanted`` has, and the others.

    A list of checked size is broadcast, so that no other text is shuffled. A longer one is not
    used: then all rows come first, and there are no others.
    """
    if wanted.count() > BROADCAST_IDS:
        return docs, None
    ids = F.broadcast(wanted.select("k1"))
    return docs.join(ids, "k1", "left_semi").select(*docs.columns), docs.join(ids, "k1", "left_anti").select(*docs.columns)


def repeated_strings(docs: DataFrame) -> DataFrame:
    """(k1, k2, spans): maximal bytes [start, stop) of texts in strings of ``LENGTH`` bytes that start elsewhere too.

    ``docs`` has k1 and k2, which tell different (doc_id, text) apart, and text. Rows equal in both
    are one here and their whole text is repeated. Texts without spans have no row.
    """
    cuts = docs.select("k1", "k2", "text").mapInArrow(lean(_cuts), CUTS.removeprefix("sid long, "))
    cuts = stage(cuts.withColumn("sid", F.monotonically_increasing_id()), "cuts")
    same = cuts.groupBy("k1", "k2").agg(F.min("sid").alias("least"), F.count("*").alias("rows"), F.first("n_bytes").alias("n"))
    same = stage(same.where("rows > 1"), "same")
    texts = cuts.where(f"n_bytes >= {LENGTH}")
    if same.limit(1).count():
        texts = texts.join(same.select("k1", "k2", "least"), ["k1", "k2"], "left").where("sid = coalesce(least, sid)").drop("least")

    # Tokens that occur again, as places in their text.
    tokens = texts.select("sid", F.posexplode("tokens").alias("at", "token"))
    shared = tokens.groupBy("token").agg(F.count("*").alias("n")).where("n > 1").select("token")
    places = tokens.join(shared, "token", "left_semi").groupBy("sid").agg(F.collect_list("at").alias("shared"))
    work = stage(texts.join(places, "sid"), "work")

    suffixes = stage(work.mapInArrow(lean(_suffixes), SUFFIXES), "suffixes")
    if suffixes.limit(1).count():
        ranks = suffix_ranks(suffixes)
        long = suffixes.where("stop >= 0").select("sid", "i", "b", "stop", "print").join(ranks, ["sid", "i"])
        repeated = paired(long, ["rank", "sid", "i"], ["print"]).where("paired").select("sid", "b", "stop")
        drop_staged(ranks)
        drop_staged(suffixes)
    else:
        repeated = suffixes.select("sid", "b", "stop")

    # The remaining suffixes: open ones, and one each of the repeated ones with the same token.
    proven = repeated.groupBy("sid").agg(F.collect_list(F.struct("b", "stop")).alias("proven"))
    strings = stage(work.join(proven, "sid", "left").mapInArrow(lean(_strings), STRINGS), "strings")
    open_ = strings.where("open")
    sure = (
        strings.where("NOT open")
        .join(open_.select("token").distinct(), "token", "left_semi")
        .groupBy("context", "offset", (F.col("stop") - F.col("start")).alias("n"))
        .agg(F.min(F.struct("sid", "start", "stop", "open", "cut")).alias("one"))
        .select("one.*")
    )
    fields = ["sid", "start", "stop", "open", "cut"]
    keys = stage(texts.select("sid", "k1", "k2"), "keys")
    twice = same.limit(1).count()
    drop_staged(work)
    drop_staged(cuts)

    def with_texts(ranges: DataFrame) -> DataFrame:
        listed = ranges.groupBy("sid").agg(F.collect_list(F.struct(*ranges.columns[1:])).alias("ranges"))
        listed = stage(listed.join(keys, "sid"), "listed")
        asked = of_keys(docs.select("k1", "k2", "text"), listed)[0]
        if twice:
            asked = asked.dropDuplicates(["k1", "k2"])
        return asked.join(listed, ["k1", "k2"]).select("sid", "text", "ranges")

    by_sixteen = with_texts(open_.select(*fields).union(sure.select(*fields))).mapInArrow(lean(_blocks), BLOCKS)
    by_sixteen = stage(by_sixteen, "sixteen")  # the order takes a sample first
    drop_staged(strings)
    blocks = paired(by_sixteen, ["o1", "o2", "sid", "at"], ["o1", "o2"]).withColumn("asks", F.expr("open AND NOT paired"))
    drop_staged(by_sixteen)
    inner = blocks.groupBy("inner").agg(F.count("*").alias("n"), F.bool_or("asks").alias("asked"))
    members = blocks.join(inner.where("n > 1 AND asked").select("inner"), "inner", "left_semi")
    known = (
        members.where("NOT asks")
        .groupBy("o1", "o2", (F.col("start") - F.col("at")).alias("x"), (F.col("stop") - F.col("at")).alias("y"))
        .agg(F.min(F.struct("sid", "start", "stop")).alias("one"))
        .select("one.*", F.lit(False).alias("open"))
    )
    single = members.where("asks").select("sid", "start", "stop", "open").union(known)
    found = stage(with_texts(single).mapInArrow(lean(_prints), PRINTS), "prints")
    more = paired(found, ["f1", "f2", "sid", "at"], ["f1", "f2"]).where("paired AND open")
    drop_staged(found)

    by_sid = (
        repeated.select("sid", F.col("b").alias("start"), "stop")
        .union(blocks.where("open AND paired").select("sid", "start", F.col("stop") + (LENGTH - 1)))
        .union(more.select("sid", F.col("at").alias("start"), (F.col("at") + LENGTH).alias("stop")))
    )
    all_spans = by_sid.join(keys, "sid").select("k1", "k2", "start", "stop")
    whole = same.where(f"n >= {LENGTH}").select("k1", "k2", F.lit(0).cast("long").alias("start"), F.col("n").alias("stop"))
    listed = all_spans.union(whole).groupBy("k1", "k2").agg(F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("spans"))
    return stage(listed.mapInArrow(lean(_maximal), f"k1 long, k2 long, spans {SPANS}"), "spans")


def _maximal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (k1, k2, spans) with the spans joined to maximal ones."""
    for batch in batches:
        column = batch.column("spans")
        ends = column.offsets.to_numpy()
        own = slice(ends[0], ends[-1])
        start, stop = (column.values.field(n).to_numpy()[own] for n in ("start", "stop"))
        row = np.repeat(np.arange(batch.num_rows), np.diff(ends))
        # Spans come by start; one begins anew behind all stops before it in its row.
        shift = row * (int(stop.max()) + 1 if len(stop) else 1)
        reach = np.maximum.accumulate(stop + shift)
        new = np.ones(len(start), bool)
        new[1:] = (start[1:] + shift[1:] > reach[:-1]) | (row[1:] != row[:-1])
        head = np.flatnonzero(new)
        tail = np.append(head[1:], len(start))[: len(head)] - 1
        struct = pa.StructArray.from_arrays([pa.array(start[head]), pa.array((reach - shift)[tail])], ["start", "stop"])
        counts = np.bincount(row[head], minlength=batch.num_rows)
        offsets = pa.array(np.append(0, np.cumsum(counts)), pa.int32())
        yield pa.RecordBatch.from_arrays(
            [batch.column("k1"), batch.column("k2"), pa.ListArray.from_arrays(offsets, struct)], names=["k1", "k2", "spans"]
        )


def remove_repeated(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, spans, kept) of every row of ``docs (doc_id, text)``.

    A text counts as its UTF-8 bytes. ``spans`` are the maximal stretches [start, stop) of bytes
    that a string of ``LENGTH`` bytes covers which also starts anywhere else, in the same text or
    another; ``kept`` is the text without them. Strings are judged on the texts as given and do
    not cross them.

    A null text is empty, and like any text shorter than ``LENGTH`` it is kept as it is. Every row
    is a text of its own: rows that repeat a doc_id, or repeat a row in full, are other places, so
    of texts that occur twice nothing is kept, whatever the order of rows. Rows without a doc_id
    are treated alike. Other columns are not read; an empty table gives an empty result.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    keyed = rows.select(
        "*", F.xxhash64("doc_id", "text").alias("k1"), F.xxhash64("text", F.lit(1), F.length("text")).alias("k2")
    )
    spans = repeated_strings(keyed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, listed = batch.column("doc_id").to_pylist(), batch.column("spans").to_pylist()
            for row, texts in pieces(batch.column("text")):
                counts, flat, ends, kept = [], [], [0], []
                for k, text in enumerate(texts.cast(pa.large_binary()).to_pylist()):
                    own = [(s["start"], s["stop"]) for s in listed[row + k]]
                    counts.append(len(text))
                    flat += own
                    ends.append(len(flat))
                    edges = [0, *(x for span in own for x in span), len(text)]
                    kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2])))
                pairs = np.array(flat, np.int64).reshape(-1, 2)
                struct = pa.StructArray.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["start", "stop"])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids[row : row + len(texts)], pa.int64()),
                        pa.array(counts, pa.int64()),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), struct),
                        pa.array(kept, pa.binary()),
                    ],
                    names=["doc_id", "n_bytes", "spans", "kept"],
                )

    some, others = of_keys(keyed, spans)
    cut_ = some.join(spans, ["k1", "k2"]).select("doc_id", "text", "spans")
    cut_ = cut_.mapInArrow(lean(run), StructType.fromDDL(f"doc_id long, n_bytes long, spans {SPANS}, kept binary"))
    text = F.coalesce("text", F.lit("")).cast("binary")
    whole = some.join(spans, ["k1", "k2"], "left_anti")
    whole = (whole if others is None else whole.unionByName(others)).select(
        "doc_id", F.octet_length(text).cast("long").alias("n_bytes"), F.array().cast(SPANS).alias("spans"), text.alias("kept")
    )
    return cut_.union(whole)


def digest(removed: DataFrame) -> DataFrame:
    """One row per row of ``remove_repeated``: counts, and the checksum of the bytes kept."""
    gone = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return removed.select(
        "doc_id",
        "n_bytes",
        gone.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2(F.col("kept"), 256).alias("kept_sha256"),
    )
