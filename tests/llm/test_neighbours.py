"""Nearest neighbours against a full comparison; bounds against distances."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from tidemark.llm import neighbours


def fine(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)


def distance(a, b):
    total = 0.0
    for x, y in zip(a, b, strict=True):
        total += (x - y) * (x - y)
    return math.sqrt(total)


def brute(rows, nearest=10, every=100):
    rows = [(i, v) for i, v in rows if fine(v)]
    out = []
    for n, (i, v) in enumerate(rows):
        if i is None or i % every:
            continue
        found = sorted((distance(v, w), j is None, j or 0) for m, (j, w) in enumerate(rows) if m != n and len(w) == len(v))
        out += [(i, k + 1, None if absent else j, s) for k, (s, absent, j) in enumerate(found[:nearest])]
    return sorted(out, key=repr)


def found(spark, rows, **how):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "7 AS row", "'x' AS name", "1 AS class").repartition(5)
    return sorted([tuple(r) for r in neighbours.neighbours(df, **how).collect()], key=repr)


def some(seed, n, width, wide=1.0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(7, width)) * wide
    return [(i, [float(x) for x in centres[rng.integers(7)] + rng.normal(size=width) * rng.choice([0.01, 1.0]) * wide]) for i in range(n)]


@pytest.mark.parametrize(("seed", "width", "how"), [(1, 8, {}), (2, 64, {"nearest": 3, "every": 7}), (3, 1, {"every": 10}), (4, 1500, {"every": 40}), (5, 3, {"nearest": 1000, "every": 90})])
def test_neighbours_equal_a_full_comparison(spark, monkeypatch, seed, width, how):
    monkeypatch.setattr(neighbours, "STREAM_ROWS", 60)
    monkeypatch.setattr(neighbours, "QUERY_BLOCK", 10)
    rows = some(seed, 400, width, 1e6 if seed == 2 else 1.0)
    assert found(spark, rows, **how) == brute(rows, **how)


def test_copies_ties_nulls_lengths_and_repeated_rows(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "STREAM_ROWS", 50)
    rng = random.Random(6)
    grid = [(i, [float(rng.randrange(3)), float(rng.randrange(3)), 1.0]) for i in range(300)]  # 9 vectors, many ties
    odd = [(None, [1.0, 1.0, 1.0]), (400, None), (500, [0.0, 0.0, 0.0]), (600, [math.nan, 1.0, 1.0]), (700, [1.0, None, 2.0]), (800, [math.inf, 1.0, 0.0]), (900, [])]
    other = [(1000, [1.0, 2.0]), (1001, [3.0, 4.0]), (1100, [5.0]), (100, [1.0, 1.0, 1.0]), (100, [1.0, 1.0, 1.0]), (-100, [2.0, 2.0, 2.0])]
    rows = grid + odd + other
    assert found(spark, rows) == brute(rows)


def test_thousands_of_copies_are_one_class(spark):
    rows = [(i, [1.0, 2.0]) for i in range(30_000)] + [(30_000, [1.0, 2.5]), (30_001, [9.0, 9.0])]
    got = found(spark, rows)
    assert len(got) == 301 * 10
    assert [r[1:] for r in got if r[0] == 0] == sorted([(k, k, 0.0) for k in range(1, 11)], key=repr)
    assert sorted(r[2] for r in got if r[0] == 30_000) == [*range(10)]


@pytest.mark.parametrize("rows", [[], [(100, [1.0])], [(100, None)], [(1, [1.0]), (2, [2.0])]])
def test_no_neighbours(spark, rows):
    assert found(spark, rows) == []


@pytest.mark.parametrize("scale", [1e-310, 1e-150, 1.0, 1e12, 1e150])
def test_bounds_hold(scale):
    rng = np.random.default_rng(8)
    a, b = rng.normal(size=(20, 12)) * scale, rng.normal(size=(30, 12)) * scale
    b[0] = a[0]
    lower, upper = neighbours.bounds(neighbours.coded(a), neighbours.coded(b))
    exact = np.array([[distance(x, y) for y in b.tolist()] for x in a.tolist()])
    assert (lower <= exact).all() and (exact <= upper).all()
    if scale == 1.0:
        assert np.median(upper - lower) < 0.1 * np.median(exact)


@pytest.mark.parametrize(("spread", "share"), [(1.0, 0.05), (0.001, 1.0)])
def test_what_survives_is_recomputed_and_what_is_returned_is_bounded(spread, share):
    """Bounds leave few pairs of spread vectors; of near copies, which they cannot tell apart, no more than the heaps are returned."""
    rng = np.random.default_rng(9)
    rows = 1 + rng.normal(size=(3000, 32)) * spread
    block = neighbours._Block(11)
    at = np.arange(0, 3000, 100)
    block.ask(at.tolist(), rows[at])
    assert block.meet([*range(3000)], [*range(3000)], rows) <= share * len(at) * 3000
    got = [r for b in block.left() for r in zip(*(c.to_pylist() for c in b.columns), strict=True)]
    assert len(got) == 11 * len(at)
    for q in at[:5].tolist():
        assert sorted((s, c) for i, c, _, s in got if i == q) == sorted((distance(rows[q], rows[c]), c) for c in range(3000))[:11]
