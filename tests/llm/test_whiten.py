"""Whitening against numpy's eigenvectors and exact integers."""

from __future__ import annotations

import math

import numpy as np
import pytest

from millrace.llm import whiten

SCHEMA = "vec_id long, embedding array<float>, component string, n string"


def brute(rows, components=16, scale=64):
    held = []
    for i, v in rows:
        if v is not None and all(x is not None and math.isfinite(x) for x in v):
            held.append((i, tuple(math.floor(scale * float(np.float32(x))) + 1_000_000 for x in v)))
    fit = sorted({x for _, x in held})
    n = len(fit)
    sums = [sum(c) for c in zip(*fit)]
    centred = np.array([[(n * a - s) / n for a, s in zip(x, sums)] for x in fit])
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    out = {}
    for i, x in held:
        deviation = sum((n * a - s) ** 2 for a, s in zip(x, sums))
        y = np.array([(n * a - s) / n for a, s in zip(x, sums)])
        for c in range(min(components, len(values))):
            if values[c] > 1e-9 * values[0]:
                out.setdefault((i, c + 1), []).append((n, deviation, float(y @ vectors[:, c]) / math.sqrt(values[c]), values[c] / covariance.trace()))
    return out


def check(spark, rows, components=16):
    frame = spark.createDataFrame([(i, v, "", "") for i, v in rows], SCHEMA)
    got = {}
    for r in whiten.whiten(frame, components=components).collect():
        got.setdefault((r.vec_id, r.component), []).append(r)
    want = brute(rows, components)
    assert got.keys() == want.keys()
    signs = {}
    for key, found in got.items():
        assert len(found) == len(want[key])
        for r, (n, deviation, value, share) in zip(sorted(found, key=lambda r: r.deviation), sorted(want[key], key=lambda w: w[1])):
            assert (r.n, r.deviation) == (n, deviation)
            assert r.explained == pytest.approx(share, rel=1e-9)
            assert r.identity_error < 1e-8
            sign = signs.setdefault(key[1], 1 if r.whitened * value >= 0 else -1) if abs(value) > 1e-6 else signs.get(key[1], 1)
            assert r.whitened == pytest.approx(sign * value, abs=1e-6)


def test_spread_vectors(spark):
    rnd = np.random.default_rng(1)
    mix = rnd.normal(size=(6, 6)) * [8, 4, 2, 1, 0.5, 0.25]
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(rnd.normal(size=(700, 6)) @ mix.T)]
    rows += [(1000 + i, rows[0][1]) for i in range(300)]  # a third are copies
    check(spark, rows)
    check(spark, rows, components=2)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0, 3.0]), (0, [1.0, 2.0, 3.0]), (None, [2.0, -1.0, 0.5]), (3, [5.0, 5.0, 5.5]), (4, None), (5, [nan, 1.0, 1.0])]
    rows += [(6, [1.0, inf, 1.0]), (7, [1.0, None, 1.0]), (8, [-4.0, 1000.0, 2.0])]
    check(spark, rows)
    frame = spark.createDataFrame([(i, v, "", "") for i, v in [*rows, (9, [1.0]), (10, []), (11, [1e30, 1.0, 1.0])]], SCHEMA)
    plain = spark.createDataFrame([(i, v, "", "") for i, v in rows], SCHEMA)
    first, second = (sorted(map(str, whiten.whiten(f).select("vec_id", "component", "n", "deviation").collect())) for f in (frame, plain))
    assert first == second


def test_nothing_to_whiten(spark):
    for rows in ([], [(1, [1.0, 2.0])], [(1, [1.0, 2.0])] * 5, [(1, [])], [(1, None)]):
        frame = spark.createDataFrame([(i, v, "", "") for i, v in rows], SCHEMA)
        found = whiten.whiten(frame)
        assert found.collect() == []
        assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_flat_directions_are_left_out(spark):
    rnd = np.random.default_rng(3)
    rows = [(i, [float(a), float(b), float(a), 7.0]) for i, (a, b) in enumerate(rnd.integers(-50, 50, size=(200, 2)))]
    check(spark, rows)


def test_large_numbers_stay_exact(spark):
    rows = [(i, [float(i * 4096), float((i % 7) * 2**16)]) for i in range(40)]
    check(spark, rows)


def test_jacobi_keeps_small_eigenvalues():
    # a graded matrix: the small eigenvalue is right to nearly all its digits
    d = np.diag([1.0, 1e-6, 1e-12])
    core = np.array([[1.0, 0.5, 0.2], [0.5, 1.0, 0.3], [0.2, 0.3, 1.0]])
    values, vectors = whiten.one_sided_jacobi(whiten.pivoted_cholesky(d @ core @ d))
    assert np.prod(values) == pytest.approx(np.linalg.det(core) * 1e-36, rel=1e-9)
    assert np.abs(vectors.T @ vectors - np.eye(3)).max() < 1e-9


def test_the_spread_of_rows_does_not_matter(spark):
    rnd = np.random.default_rng(5)
    rows = [(i, [float(x) for x in v], "", "") for i, v in enumerate(rnd.normal(size=(300, 5)))]
    frame = spark.createDataFrame(rows, SCHEMA)
    first, second = (whiten.fit(whiten.quantise(frame.repartition(k))) for k in (1, 7))
    assert (first.vectors == second.vectors).all() and (first.values == second.values).all()
