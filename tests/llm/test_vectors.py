"""Whitening and hard negatives against brute force: nulls, ties, repeated rows, odd vectors, equal eigenvalues."""

from __future__ import annotations

import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from markloom.llm import hard_negatives, whitening

from ..conftest import SF_DIR

SCHEMA = "vec_id long, embedding array<double>, label int, n int, window string, score string, rid string"
COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def vectors(spark, rows):
    return spark.createDataFrame([(*r, 1, "w", "s", "r") for r in rows], SCHEMA)


def awkward(seed=1, size=160, dim=6):
    rng = random.Random(seed)
    made = [(i, [rng.choice([-0.5, -0.25, 0.0, 0.25, 0.5]) for _ in range(dim)], rng.randrange(3)) for i in range(size)]
    odd = [
        (200, None, 1), (201, [], 1), (202, [None] * dim, 1), (203, [float("nan")] * dim, 1), (204, [float("inf")] + [0.1] * (dim - 1), 0),
        (205, [0.5] * dim, None), (None, [0.5] * dim, 2), (250, [0.0] * dim, 0), (100, made[100][1], made[100][2]), (3, made[3][1], made[3][2]),
    ]
    return made + odd


def usable(v):
    return bool(v) and all(x is not None and math.isfinite(x) for x in v)


def expected_negatives(rows):
    some = []
    for i, v, label in rows:
        if label is not None and usable(v):
            moved = (label + 1) % 10 if i is not None and i % 7 == 0 else label
            some.append((i, [math.floor(256 * x) for x in v], moved))
    out = []
    score = lambda a, b: sum(x * y for x, y in zip(a, b))
    for at, (a, va, la) in enumerate(some):
        if a is None or a % 50:
            continue
        order = lambda c: (-c[0], c[1] is None, c[1] or 0)
        others = sorted(((score(va, v), i, label) for k, (i, v, label) in enumerate(some) if k != at), key=order)
        for s, p, _ in [o for o in others if o[2] == la][:5]:
            fits = [o for o in others if o[2] != la and 50 * s <= 100 * o[0] <= 95 * s][:3]
            out += [(a, p, k + 1, o[1], s, o[0]) for k, o in enumerate(fits)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", [1 << 23, 120])
def test_hard_negatives_match_brute_force(spark, monkeypatch, block):
    """One block, and many."""
    monkeypatch.setattr(hard_negatives, "BLOCK_VALUES", block)
    for seed in (1, 2):
        rows = awkward(seed)
        got = hard_negatives.hard_negative_rows(vectors(spark, rows))
        assert sorted((tuple(r) for r in got.select(*COLUMNS).collect()), key=repr) == expected_negatives(rows)


def test_hard_negatives_match_sql(spark):
    table = f"{SF_DIR}/embeddings.parquet"
    got = hard_negatives.hard_negative_rows(spark.read.parquet(table)).select(*COLUMNS).collect()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{table}'")
    assert got and sorted(map(tuple, got)) == sorted(con.execute(hard_negatives.SQL).fetchall())


def test_scores_beyond_double_precision(spark):
    big = 2.0**22
    rows = [(0, [big, 1.0], 1), (1, [big, 1.0], 1), (2, [big, 0.5], 2), (3, [big * 0.9, 2.0], 2), (4, [big * 0.9, 1.0], 2)]
    got = hard_negatives.hard_negative_rows(vectors(spark, rows)).select(*COLUMNS).collect()
    assert sorted(map(tuple, got)) == expected_negatives([(i, v, (c - 1) % 10 if i % 7 == 0 else c) for i, v, c in rows]) or sorted(
        map(tuple, got)
    ) == expected_negatives(rows)


def test_a_hot_vector_fills_windows_in_order(spark):
    rows = [(i, [0.5, 0.5], 1) for i in range(3000)] + [(i, [0.25, 0.5], 2) for i in range(3000, 6000)]
    got = hard_negatives.mine(vectors(spark, rows), "vec_id = 50").collect()
    assert len(got) == 15
    assert {r.positive_id for r in got} == {0, 1, 2, 3, 4} and {(r.rank, r.negative_id) for r in got} == {(1, 3000), (2, 3001), (3, 3002)}


def whitened(rows, components=16):
    """Independent version: distinct vectors, exact mean, numpy's double-precision solver."""
    size = max(len(v) for _, v, _ in rows if usable(v))
    kept = [(i, [math.floor(64 * x) + 1_000_000 for x in v]) for i, v, _ in rows if usable(v) and len(v) == size]
    fit = sorted({tuple(x) for _, x in kept})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    d = np.array([[(n * x - s) / n for x, s in zip(v, sums)] for v in fit])
    value, axes = np.linalg.eigh(d.T @ d / n)
    value, axes = value[::-1], axes[:, ::-1]
    out = {}
    for i, x in kept:
        centred = [n * a - s for a, s in zip(x, sums)]
        y = np.array(centred) / n @ axes[:, :components] / np.sqrt(value[:components])
        out[i, tuple(x)] = (sum(c * c for c in centred), y, n)
    return out, value / value.sum()


def test_whitening_matches_numpy(spark):
    rows = awkward(3, 190, 20)
    want, share = whitened(rows)
    got = whitening.whitened_rows(vectors(spark, rows)).collect()
    by_row = {}
    for r in got:
        by_row.setdefault(r.vec_id, []).append(r)
        assert r.identity_error < 1e-10 and r.explained == pytest.approx(share[r.component - 1], rel=1e-9)
    assert len(got) == 16 * sum(1 for _, v, _ in rows if usable(v))
    for (i, _), (deviation, y, n) in want.items():
        for r in by_row[i]:
            assert (r.deviation, r.n) == (deviation, n)
            assert abs(r.whitened) == pytest.approx(abs(y[r.component - 1]), abs=1e-8)


@pytest.mark.parametrize("gap", [0.0, 1e-3, 1e-7, 1e-11, 1e-14])
def test_clustered_eigenvalues(gap):
    rng = np.random.default_rng(5)
    q = np.linalg.qr(rng.normal(size=(24, 24)))[0]
    value = np.sort(np.concatenate([3 + gap * np.arange(8), 1 + gap * np.arange(8), rng.uniform(0.1, 0.9, 8)]))[::-1]
    a = (q * value) @ q.T
    found, axes = whitening.refined((a + a.T) / 2)
    assert np.abs(axes.T @ axes - np.eye(24)).max() < 1e-15 * 24
    assert np.abs(found - value).max() < 1e-14
    assert np.abs(axes.T @ a @ axes - np.diag(found)).max() < 2e-14


def test_float32_vectors_alone_are_not_enough():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(500, 32))
    a = x.T @ x / 500
    rough = np.linalg.eigh(a.astype(np.float32))[1].astype(float)
    axes = whitening.refined(a)[1]
    error = lambda v: np.abs((p := v.T @ a @ v) - np.diag(np.diag(p))).max()
    assert error(axes) < 1e-14 < 1e-8 < error(rough)


def test_degenerate_tables(spark):
    none = vectors(spark, [])
    assert whitening.whitened_rows(none).count() == 0 and hard_negatives.hard_negative_rows(none).count() == 0
    unusable = vectors(spark, [(1, None, 1), (2, [], 2)])
    assert whitening.whitened_rows(unusable).count() == 0 and hard_negatives.hard_negative_rows(unusable).count() == 0
    one = whitening.whitened_rows(vectors(spark, [(1, [0.5, 0.5], 1), (1, [0.5, 0.5], 1), (2, [0.5], 1)])).collect()
    assert len(one) == 4
    assert {(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one} == {(1, 0, None, None, None)}
    flat = whitening.whitened_rows(vectors(spark, [(i, [i / 64.0, 0.5], 1) for i in range(4)])).collect()
    assert {r.whitened is None for r in flat if r.component == 2} == {True} and all(r.identity_error < 1e-12 for r in flat)
    kept = whitening.whiten(vectors(spark, awkward()), whitening.fit(vectors(spark, awkward())), out="score")
    assert kept.count() == len(awkward()) and kept.where(F.col("vec_id") == 200).first().score is None
