"""Periodic runs against all squares compared word by word."""

from __future__ import annotations

import hashlib
import random
import zlib

from pyspark.sql import functions as F

from candlemill.llm.periodic import LastPlaces, collapse, digest, find_runs, periodic_runs, strongest
from candlemill.llm.queries import op13_periodic_runs

from .conftest import odd_rows

SF_DIR = "/root/testdata/sf0.001"


def plain_runs(words: list) -> list[tuple[int, int, int]]:
    found, n = [], len(words)
    for q in range(1, n // 4 + 1):
        i = q
        while i < n:
            j = i
            while j < n and words[j] == words[j - q]:
                j += 1
            start, length = i - q, j - i + q
            if length >= max(6, 4 * q):
                own = words[start : start + length]
                if not any(own[r:] == own[:-r] for r in range(1, q)):
                    found.append((start, length, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def random_words(rng: random.Random) -> list[int]:
    words = [rng.randrange(rng.choice([1, 2, 3, 4])) for _ in range(rng.randrange(60))]
    unit = [rng.randrange(3) for _ in range(rng.randrange(1, 8))]
    return words[:20] + unit * rng.randrange(9) + unit[: rng.randrange(len(unit))] + words[20:]


def test_runs_equal_plain_ones():
    rng = random.Random(1)
    for _ in range(2000):
        words = random_words(rng)
        assert find_runs(words) == plain_runs(words), words


def test_last_places():
    """After each word, every suffix that stood before has the place where it last ended."""
    rng = random.Random(2)
    for _ in range(100):
        words = [rng.randrange(2) for _ in range(30)]
        places = LastPlaces()
        for t, word in enumerate(words):
            paths = places.append(word)
            got = {}
            for (place, length), (_, below) in zip(paths, [*paths[1:], (0, 0)]):
                got |= {n: place for n in range(below + 1, length + 1)}
            want = {}
            for n in range(1, t + 1):
                ends = [e for e in range(n - 1, t) if words[e - n + 1 : e + 1] == words[t - n + 1 : t + 1]]
                if ends:
                    want[n] = max(ends)
            assert got == want


def test_long_texts():
    for n, q in ((50_000, 1), (50_000, 7), (20_000, 5_000)):
        words = [i % q for i in range(n)]
        assert find_runs(words) == [(0, n, q)]
    a, b = [0], [1]
    while len(b) < 20_000:  # Fibonacci words: squares at every place, none of four periods
        a, b = b, b + a
    assert find_runs(b) == []


def test_strongest_and_collapse():
    assert strongest([(9, 8, 2), (3, 4, 1), (3, 8, 2)]) == (3, 4, 1)
    assert strongest([(3, 8, 2), (3, 4, 1)]) == (3, 4, 1)
    assert strongest([]) is None
    words = list("xabababababy")
    assert "".join(collapse(words, find_runs(words))) == "xaby"


def plain_digest(doc_id, text):
    words = (text or "").encode().split()
    if doc_id is not None and words and (h := zlib.crc32(str(doc_id).encode())) % 10 == 0:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words) if len(words) < 3000 else find_runs(words)
    kept = [w for i, w in enumerate(words) if not any(s + q <= i < s + n for s, n, q in runs)]
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None,) * 3)
    milli = best[1] * 1000 // best[2] if runs else None
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    sha = [hashlib.sha256(x).hexdigest() for x in (lines.encode(), b" ".join(kept))]
    return (doc_id, len(runs), *best, milli, *sha)


def test_query(shipped_spark):
    rows = op13_periodic_runs(shipped_spark, SF_DIR).drop("n_words").collect()
    docs = shipped_spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    want = {d.doc_id: plain_digest(d.doc_id, d.text) for d in docs}
    assert len(rows) == len(want)
    assert {r.doc_id: tuple(r) for r in rows} == want
    assert sum(r.n_runs > 0 for r in rows) > 10


def test_odd_rows(odd_docs, no_docs):
    found = periodic_runs(odd_docs)
    rows = digest(found).collect()
    assert sorted(map(repr, (r.doc_id for r in rows))) == sorted(repr(r[0]) for r in odd_rows())
    by_id = {r.doc_id: r for r in rows}
    nothing = hashlib.sha256(b"").hexdigest()
    for doc_id in (3, 4, 5):
        assert tuple(by_id[doc_id])[1:] == (0, None, None, None, None, nothing, nothing, 0)
    assert tuple(by_id[10])[1:6] == (1, 0, 300, 1, 300_000)
    assert found.where("doc_id = 10").first().collapsed == "For"
    assert found.where("doc_id = 9").first().collapsed == "Ünïcode ∑ 漢字 \x00 \x1c end\x85."
    assert [f.dataType.simpleString() for f in digest(found).schema][:3] == ["bigint"] * 3
    assert digest(periodic_runs(no_docs)).agg(F.count("*")).first()[0] == 0
