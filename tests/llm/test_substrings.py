"""Repeated strings against all strings of 400 bytes, and suffix ranks against sorted suffixes."""

from __future__ import annotations

import collections
import hashlib
import os
import random

import numpy as np
import pyarrow as pa
import pytest

from candlemill.llm import substrings
from candlemill.llm.queries import op12_repeated_strings
from candlemill.llm.sorting import counted, paired
from candlemill.llm.substrings import LENGTH, _maximal, cut, digest, least_places, remove_repeated, suffix_ranks

SF_DIR = "/root/testdata/sf0.001"


def plain(rows: list[tuple]) -> list[tuple]:
    seen: collections.Counter = collections.Counter()
    texts = [(doc_id, (text or "").encode()) for doc_id, text in rows]
    for _, b in texts:
        seen.update(b[i : i + LENGTH] for i in range(len(b) - LENGTH + 1))
    out = []
    for doc_id, b in texts:
        gone = bytearray(len(b))
        for i in range(len(b) - LENGTH + 1):
            if seen[b[i : i + LENGTH]] > 1:
                gone[i : i + LENGTH] = b"\1" * LENGTH
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for i in range(len(b)) if gone[i] and not (i and gone[i - 1]))
        out.append((doc_id, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def mosaic(seed: int) -> list[tuple]:
    """Texts made of pieces of a few others, with runs of one letter or word and repeated rows."""
    rng = random.Random(seed)
    base = ["".join(rng.choice("abc d") for _ in range(900)) for _ in range(6)]
    rows = []
    for k in range(150):
        text = ""
        for _ in range(rng.randrange(1, 5)):
            source, a = rng.choice(base), rng.randrange(400)
            text += source[a : a + rng.randrange(100, 700)]
            text += "".join(rng.choice("xyz ") for _ in range(rng.choice([0, 1, 30, 300])))
        if k % 20 == 0:
            text = "a" * rng.randrange(300, 1500) + text
        if k % 21 == 0:
            text = "abcdefg" * rng.randrange(50, 250) + text
        rows.append((k % 140, text))
    alike = [(1000, rows[5][1])] * 2
    edges = [(None, "é" * 300), (None, None), (None, None), (7, ""), (8, "q" * 399), (9, "r" * 400), (10, "s" * 401)]
    return rows + alike + edges


def test_strings_equal_plain_ones(shipped_spark):
    rows = mosaic(5)
    df = shipped_spark.createDataFrame([(*r, None, None) for r in rows], "doc_id long, text string, k1 string, sid int")
    removed = remove_repeated(df.repartition(3))
    assert removed.columns == ["doc_id", "n_bytes", "spans", "kept"]
    assert sorted(map(tuple, digest(removed).collect()), key=str) == plain(rows)


def test_query_equals_plain(shipped_spark):
    docs = shipped_spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    got = op12_repeated_strings(shipped_spark, SF_DIR)
    assert sorted(map(tuple, got.collect()), key=str) == plain([tuple(d) for d in docs])


def test_odd_rows(odd_docs, no_docs):
    rows = [tuple(r) for r in odd_docs.select("doc_id", "text").collect()]
    assert sorted(map(tuple, digest(remove_repeated(odd_docs)).collect()), key=str) == plain(rows)
    assert digest(remove_repeated(no_docs)).count() == 0
    short = odd_docs.where("doc_id IN (3, 4, 5, 7)")
    assert [r.n_removed for r in digest(remove_repeated(short)).collect()] == [0] * 4


@pytest.mark.parametrize("letters, reach", [(2, 400), (4, 400), (2, 1)])
def test_suffix_ranks(shipped_spark, letters, reach):
    """Ranks order suffixes; with symbols that reach far only their first triples have to."""
    rng = random.Random(letters + reach)
    strings = [[rng.randrange(1, letters + 1) for _ in range(rng.randrange(1, 60))] for _ in range(12)]
    strings += [[1] * 50, [1, 2] * 20, strings[0]]
    rows = []
    for sid, own in enumerate(strings):
        padded = own + [0, 0, 0]
        for i in range(len(own)):
            rows.append((sid, i, *padded[i : i + 3], reach * i, reach * min(i + 3, len(own))))
    df = shipped_spark.createDataFrame(rows, "sid long, i long, s long, s1 long, s2 long, b long, e3 long")
    ranks = {(r.sid, r.i): r["rank"] for r in suffix_ranks(df).collect()}
    assert len(ranks) == len(rows)
    order = sorted(ranks, key=ranks.get)
    suffixes = [tuple(strings[sid][i:]) for sid, i in order]
    if reach == 1:
        assert suffixes == sorted(suffixes)
    # Equal prefixes that reach 400 are side by side.
    for n in (2, 3):
        heads = [s[:n] for s in suffixes if len(s) >= n and n * reach >= LENGTH]
        assert len([h for h, _ in zip(heads, heads[1:]) if h != _]) + 1 == len(set(heads)) or not heads


def test_order_helpers(shipped_spark):
    """Numbers and equal neighbours across partitions, with a value that fills most of them."""
    rng = random.Random(4)
    rows = [(7 if rng.random() < 0.5 else rng.randrange(200), k, k % 3 == 0) for k in range(300)]
    df = shipped_spark.createDataFrame(rows, "v long, k long, third boolean")
    rows.sort()
    before = {k: (n, sum(t for *_, t in rows[:n])) for n, (_, k, _) in enumerate(rows)}
    got = counted(df, ["v", "k"], "third").collect()
    assert {r.k: (r.before, r.flags_before) for r in got} == before
    often = collections.Counter(v for v, *_ in rows)
    got = paired(df, ["v", "k"], ["v"]).collect()
    assert {r.k: r.paired for r in got} == {k: often[v] > 1 for v, k, _ in rows}
    assert counted(df.where("false"), ["v"], "third").count() == paired(df.where("false"), ["v"], ["v"]).count() == 0


def test_cuts_depend_on_content():
    """A string of 400 bytes has the same cuts wherever it is, and a whole token."""
    rng = np.random.default_rng(6)
    string = rng.integers(97, 101, 400).astype(np.uint8)
    found = []
    for _ in range(20):
        ahead, behind = (rng.integers(97, 123, n).astype(np.uint8) for n in rng.integers(0, 900, 2))
        data = np.concatenate([ahead, string, behind])
        _, windows, cuts = cut(data, np.array([0, len(data)]))
        first = np.searchsorted(windows, len(ahead), "right") - 1
        last = np.searchsorted(windows, len(ahead) + 225, "right") - 1
        found.append(tuple(cuts[first : last + 1] - len(ahead)))
        assert np.diff(cuts).max() <= 160
    assert len(set(found)) == 1 and len(found[0]) >= 2
    hashes = rng.integers(0, 2**63, 5000).astype(np.uint64)
    assert (least_places(hashes) == [k + int(hashes[k : k + 160].argmin()) for k in range(len(hashes) - 159)]).all()


def test_maximal_spans():
    kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
    rows = [[(0, 4), (2, 3), (4, 6), (8, 9)], [], [(5, 7)], [(0, 9), (1, 2), (3, 4), (20, 30)]]
    listed = pa.array([[{"start": a, "stop": b} for a, b in row] for row in rows], kind)
    keys = pa.array(range(4), pa.int64())
    batch = pa.RecordBatch.from_arrays([keys, keys, listed], names=["k1", "k2", "spans"])
    found = next(_maximal(iter([batch]))).column("spans").to_pylist()
    assert [[tuple(s.values()) for s in row] for row in found] == [[(0, 6), (8, 9)], [], [(5, 7)], [(0, 9), (20, 30)]]


def test_texts_by_a_broadcast_list_or_all(shipped_spark, frame, monkeypatch):
    rows = mosaic(5)
    docs = frame("doc_id long, text string", *rows)
    for most in (substrings.BROADCAST_IDS, 0):
        monkeypatch.setattr(substrings, "BROADCAST_IDS", most)
        assert sorted(map(tuple, digest(remove_repeated(docs)).collect()), key=str) == plain(rows)


def test_intermediates_are_dropped_once_read(shipped_spark, frame):
    folder = shipped_spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    remove_repeated(frame("doc_id long, text string", *mosaic(6)))
    left = {name.split("-")[0] for name in set(os.listdir(folder)) - before}
    assert "spans" in left and not left & {"cuts", "work", "strings", "sixteen", "prints"}


def test_seed_hashes_across_parts(monkeypatch):
    monkeypatch.setattr(substrings, "CACHED", 100)
    for n in (0, 15, 16, 115, 116, 1000):
        data = np.random.default_rng(n).integers(0, 256, n).astype(np.uint8)
        starts = np.arange(max(n - substrings.SEED + 1, 0))
        assert (substrings.seed_hashes(data) == substrings.byte_hashes(data, starts, starts + substrings.SEED)).all()
