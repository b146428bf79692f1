"""Operator 12 against a plain version: clustered and spread vectors, copies, ties, odd rows, several dimensions, long numbers."""

import math

import numpy as np
import pytest

from marketrates.llm import hard_negatives as H
from marketrates.llm import store

SCHEMA = "vec_id long, embedding array<float>, label int, score string, row string, cell int, anchor int, known string"


def plain(rows, anchor, positives=5, negatives=5, window=(80, 100), scale=256):
    """rows: (id, vector, label)"""
    own = []
    for i, v, label in rows:
        if label is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        own.append((i, [math.floor(scale * float(np.float32(x))) for x in v], label))
    order = lambda x: (-x[1], x[0] is None, x[0] or 0)
    out = []
    for k, (i, v, label) in enumerate(own):
        if not anchor(i):
            continue
        scored = [(j, sum(a * b for a, b in zip(v, w)), other) for n, (j, w, other) in enumerate(own) if n != k and len(w) == len(v)]
        for j, p, _ in sorted((x for x in scored if x[2] == label), key=order)[:positives]:
            fits = [x for x in scored if x[2] != label and window[0] * p <= 100 * x[1] <= window[1] * p]
            out += [(i, j, n + 1, x[0], p, x[1]) for n, x in enumerate(sorted(fits, key=order)[:negatives])]
    return sorted(out, key=str)


def moved(rows):
    return [(i, v, (label + 1) % 10 if i is not None and label is not None and i % 7 == 0 else label) for i, v, label in rows]


def frame(spark, rows):
    return spark.createDataFrame([(i, v, label, "clash", "clash", 1, 2, "x") for i, v, label in rows], SCHEMA).repartition(3)


def check(spark, rows):
    store.tune(spark)
    out = H.digest_query(frame(spark, rows))
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    got = sorted(map(tuple, out.collect()), key=str)
    assert got == plain(moved(rows), lambda i: i is not None and i % 100 == 0)
    return got


@pytest.fixture
def small(monkeypatch):
    for name, value in {"CELL_ROWS": 8, "SEED": 20, "BLOCK": 16, "SLICE": 3, "FIT_ROWS": 200}.items():
        monkeypatch.setattr(H, name, value)


def test_clusters(spark, small):
    r = np.random.default_rng(1)
    centres = r.normal(size=(12, 16))
    rows = [(25 * k, (centres[k % 12] + 0.2 * r.normal(size=16)).tolist(), int(r.integers(10))) for k in range(500)]
    assert len(check(spark, rows)) > 1000


def test_spread_copies_and_ties(spark, small):
    r = np.random.default_rng(2)
    vectors = [(r.integers(-2, 3, size=3) / 256).tolist() for _ in range(9)]
    rows = [(20 * k, vectors[int(r.integers(9))] if k % 3 else vectors[0], int(r.integers(3))) for k in range(300)]
    check(spark, rows + rows[:10])


def test_odd_rows(spark, small):
    r = np.random.default_rng(3)
    v = lambda n=4: r.normal(size=n).tolist()
    rows = [(100 * k, v(), k % 2) for k in range(8)] + [(None, v(), 1), (None, v(), 0), (100, v(), 1), (100, v(), 1), (200, None, 1), (300, v(), None), (400, [], 1), (500, [None, 1.0, 1.0, 1.0], 1)]
    rows += [(600, [float("nan")] * 4, 0), (700, [float("inf")] * 4, 0), (800, [0.0] * 4, 3), (900, v(2), 0), (1000, v(2), 0), (1100, v(2), 1), (1200, v(1), 1), (-100, v(), 9), (1300, v(), -3)]
    check(spark, rows)


def test_long_numbers(spark, small):
    rows = [(50 * k, [float(2**20 + k), float(k % 5), 3.0], k % 2) for k in range(12)]
    check(spark, rows)


def test_numbers_beyond_64_bits_take_no_part(spark, small):
    rows = [(100, [1.0, 1.0], 1), (1, [1.0, 1.0], 1), (2, [0.9, 1.0], 2)]
    assert check(spark, rows) == sorted(map(tuple, H.digest_query(frame(spark, rows + [(200, [1e30, 0.0], 1), (3, [3e38, 0.0], 2)])).collect()), key=str)


def test_other_windows(spark, small):
    store.tune(spark)
    r = np.random.default_rng(5)
    rows = [(k, (1 + r.normal(size=6)).tolist(), k % 4) for k in range(200)]
    out = H.mine(frame(spark, rows), H.F.col("vec_id") % 10 == 0, positives=3, negatives=2, window=(50, 95))
    assert sorted(map(tuple, out.collect()), key=str) == plain(rows, lambda i: i % 10 == 0, 3, 2, (50, 95))


def test_empty(spark):
    assert check(spark, []) == []


def test_heap_goes_down_and_misses_nothing():
    r = np.random.default_rng(6)
    x = r.normal(size=(400, 6))
    h = H.Halves(x, 7)
    (i, j), far = h.code(x)
    np.add.at(h.counts, (i, j), 1)
    for k in (0, 1):
        np.maximum.at(h.radii[k], (i, j)[k], far[k])
    first, second = (b[0] for b in h.bounds(x[:1]))
    seen = list(h.visits(first, second))
    assert [b for b, _, _ in seen] == sorted((b for b, _, _ in seen), reverse=True) and sum(n for _, _, n in seen) == 400
    bound = {cell: b for b, cell, _ in seen}
    assert all(s <= bound[c] for s, c in zip((x @ x[0]).tolist(), (i * h.counts.shape[1] + j).tolist()))
