"""Hard negatives against all scores, and bounds against the scores they bound."""

from __future__ import annotations

import math

import numpy as np
import pytest
from oracle_check import compare, connect

from candlemill.llm import negatives
from candlemill.llm.negatives import WINDOW_ROWS, Block, Rows, angles_to, choose_directions, hard_negatives, norms
from candlemill.llm.queries import LLM_ORACLE, op11_hard_negatives

SCHEMA = "vec_id long, label int, embedding array<double>, rank string, score int, block string"


def plain(points: list[tuple]) -> list[tuple]:
    """By all scores of ``(vec_id, label, vector)``."""
    one: dict = {}
    for vec_id, label, vector in points:
        if None in (vec_id, label, vector) or any(x is None or not math.isfinite(x) for x in vector):
            continue
        v = [math.floor(256 * x) for x in vector]
        if any(abs(x) >= negatives.TOO_LARGE for x in v):
            continue
        raw = np.array(v + [0] * (3 - len(v)), np.int32).tobytes()
        one[vec_id] = min(one.get(vec_id, (label, raw, v)), (label, raw, v))
    rows = []
    for a, (label, _, v) in one.items():
        if a % 50:
            continue
        scores = [(-sum(x * y for x, y in zip(v, w)), b, other == label) for b, (other, _, w) in one.items() if b != a]
        for minus, p, _ in sorted(s for s in scores if s[2])[:5]:
            hard = sorted(s for s in scores if not s[2] and -50 * minus <= -100 * s[0] <= -95 * minus)[:3]
            rows += [(a, p, k, n, -minus, -score) for k, (score, n, _) in enumerate(hard, 1)]
    return sorted(rows)


def blocks_of(rng, kind: str, n: int = 1000, width: int = 16) -> tuple[Rows, Rows]:
    if kind == "clustered":
        centres = rng.normal(size=(8, width))
        vectors = centres[rng.integers(8, size=n)] + 0.02 * rng.normal(size=(n, width))
    else:
        vectors = rng.normal(size=(n, width)) * rng.choice([0, 0.01, 1, 50], size=(n, 1))
    vectors = np.floor(256 * vectors).astype(np.int64)
    angles = angles_to(vectors, choose_directions(vectors[:64]))
    order = np.lexsort((angles.min(axis=1), angles.argmin(axis=1)))
    rows = Rows(np.arange(n), rng.integers(3, size=n), vectors, norms(vectors), angles.astype(float)).part(order)
    return rows.part(np.flatnonzero(rows.ids % 50 == 0)), rows


@pytest.mark.parametrize("kind", ["spread", "clustered"])
def test_bounds_hold(kind):
    rng = np.random.default_rng(1)
    anchors, rows = blocks_of(rng, kind)
    block = Block(anchors, rows)
    scores = anchors.vectors @ rows.vectors.T
    for w, start in enumerate(block.starts):
        part = scores[:, start : start + WINDOW_ROWS]
        assert (block.lower[:, w] <= part.min(axis=1)).all() and (part.max(axis=1) <= block.upper[:, w]).all()


def test_windows_apart_are_not_scored():
    anchors, rows = blocks_of(np.random.default_rng(2), "clustered", 5000)
    block = Block(anchors, rows)
    block.positives()
    assert block.done.mean() < 0.4


def test_query_equals_sql(shipped_spark):
    duck = connect("/root/testdata/sf0.01")
    got = op11_hard_negatives(shipped_spark, "/root/testdata/sf0.01").toPandas()
    assert len(got) > 100
    assert compare(got, duck.execute(LLM_ORACLE["op11_hard_negatives"]).df()) is None


@pytest.mark.parametrize("scale", [1.0, 40_000.0])
def test_many_blocks(shipped_spark, monkeypatch, scale):
    """Ties, a hot vector, products beyond 2 ** 53, and blocks of a few rows and anchors."""
    for name, value in (("LEAST_GROUP", 40), ("CHUNK_ANCHORS", 3), ("WINDOW_ROWS", 8)):
        monkeypatch.setattr(negatives, name, value)
    rng = np.random.default_rng(3)
    vectors = rng.integers(-2, 3, size=(400, 3)) * scale
    vectors[::3] = vectors[0]
    points = [(i, int(rng.integers(3)), [float(x) for x in v]) for i, v in enumerate(vectors)]
    df = shipped_spark.createDataFrame(points, "vec_id long, label int, embedding array<double>")
    got = sorted(map(tuple, hard_negatives(df).collect()))
    assert got == plain(points) and got


def test_odd_rows(shipped_spark):
    nan, far = float("nan"), float("inf")
    points = [
        (0, 1, [1.0, 1.0, 0.5]), (50, 1, [0.0, 0.0, 0.0]), (1, 1, [1.0, 1.0, 0.5]), (2, 1, [1.0, 1.0, 0.5]),
        (3, 2, [0.9, 0.8]), (3, 2, [0.9, 0.8]), (3, 1, [0.1, 0.8, 0.1]), (4, 2, []), (5, 2, [0.9, 0.9, 0.3]),
        (100, 2, [0.9, 0.9, 0.3]), (6, None, [1.0, 1.0, 1.0]), (7, 2, None), (8, 2, [nan, 1.0, 1.0]),
        (9, 2, [far, 1.0, 1.0]), (10, 2, [None, 1.0, 1.0]), (11, 2, [1e9, 1.0, 1.0]), (None, 2, [0.9, 0.9, 0.9]),
        (12, 3, [-1.0, -1.0, -1.0]), (150, 4, [1.0, 0.0, 0.0]), (-50, 2, [0.5, 0.5, 0.5]),
    ]
    df = shipped_spark.createDataFrame([(*p, None, None, None) for p in points], SCHEMA)
    found = hard_negatives(df)
    got = sorted(map(tuple, found.collect()))
    assert got == plain(points) and got
    assert [f.dataType.simpleString() for f in found.schema] == ["bigint", "bigint", "int"] + ["bigint"] * 3
    assert hard_negatives(df.where("false")).count() == 0
    assert hard_negatives(df.where("vec_id = 0")).count() == 0
