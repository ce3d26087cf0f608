"""Words, hashes and shingles against plain Python."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from candlemill.llm.text import duplicate_lines, pieces, repeated_window_words, shingles, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TEXTS = st.lists(st.text(alphabet="aB é|.\n\t\x0b", max_size=40), min_size=1, max_size=6)


def only(texts):
    ((row, part),) = pieces(pa.array(texts, pa.string()))
    assert row == 0
    return part


@settings(max_examples=60, deadline=None)
@given(TEXTS)
def test_words_and_shingles(texts):
    w = words(only(texts))
    hashes = w.hashes()
    expected = [WORD.findall(t.translate(LOWER)) for t in texts]
    assert w.counts.tolist() == [len(e) for e in expected]
    flat = [x for e in expected for x in e]
    # Equal words have equal hashes, different words different ones.
    assert len({(x, int(h)) for x, h in zip(flat, hashes)}) == len(set(flat)) == len(set(hashes.tolist()))
    values, begins = shingles(hashes, w.first)
    seen = {}
    for doc, e in enumerate(expected):
        own = [tuple(e[i : i + 5]) for i in range(len(e) - 4)] if len(e) >= 5 else [tuple(e)] * bool(e)
        got = values[begins[doc] : begins[doc + 1]].tolist()
        assert len(got) == len(own)
        for s, h in zip(own, got):
            assert seen.setdefault(s, h) == h
    assert len(set(seen.values())) == len(seen)


@settings(max_examples=60, deadline=None)
@given(TEXTS)
def test_repeats(texts):
    part = only(texts)
    w = words(part, lower=False)
    marked = repeated_window_words(w, w.hashes())
    again, lines = duplicate_lines(part)
    for doc, t in enumerate(texts):
        e = WORD.findall(t)
        grams = [tuple(e[i : i + 3]) for i in range(len(e) - 2)]
        inside = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)}
        assert marked[doc] == len(inside)
        full = [x for x in t.split("\n") if WORD.search(x)]
        assert lines[doc] == len(full)
        assert again[doc] == len(full) - len(set(full))


def test_pieces_cover_all_rows():
    column = pa.chunked_array([pa.array(["aa", None, "b" * 50]), pa.array(["", "cc"])])
    got = [(row, p.to_pylist()) for row, p in pieces(column, 10)]
    assert [t for _, p in got for t in p] == ["aa", "", "b" * 50, "", "cc"]
    assert [row for row, _ in got] == np.cumsum([0, *[len(p) for _, p in got]])[:-1].tolist()
    assert list(pieces(pa.array([], pa.string()))) == []
