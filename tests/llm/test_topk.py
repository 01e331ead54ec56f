"""Threshold search against brute force."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import topk


def brute(rows, k=5):
    held = [
        (i, tuple(math.floor(float(np.float32(x)) * 256) for x in v)) for i, v, *_ in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for n, (i, v) in enumerate(held):
        if i % 50 == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w)), j) for m, (j, w) in enumerate(held) if m != n)
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scores[:k])]
    return sorted(out)


def searched(spark, rows, schema="vec_id long, embedding array<float>, score string, rank int"):
    frame = spark.createDataFrame([(i, v, "", 0) for i, v, *_ in rows], schema)
    return sorted(tuple(r) for r in topk.top_k(frame, F.col("vec_id") % 50 == 0).collect())


@pytest.mark.parametrize("blocks", [(8192, 2048), (64, 3)])
def test_random_vectors(spark, blocks, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATES", blocks[0])
    monkeypatch.setattr(topk, "QUERIES", blocks[1])
    rnd = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rnd.normal(size=8)]) for i in range(400)]
    rows += [(400 + i, rows[0][1]) for i in range(60)] + [(1000 + i, [0.0] * 8) for i in range(60)]
    assert searched(spark, rows) == brute(rows)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, -1.0]), (50, [0.5, 0.25]), (50, [0.5, 0.25]), (1, [nan, 1.0]), (2, [inf, 1.0]), (3, None), (4, [None, 1.0]),
        (None, [9.0, 9.0]), (5, [1.0, -1.0]), (6, [1.0, -1.0]), (-7, [1.0, -1.0]), (8, []), (100, [3.0]), (9, [3e38, -3e38]),
    ]
    want = [r for r in brute([x for x in rows if x[0] != 9])]
    got = searched(spark, [x for x in rows if x[0] != 9])
    assert got == want
    big = searched(spark, rows)
    assert [r for r in big if r[0] == 0][0] == (0, 1, 9, 2**63 - 1)
    assert searched(spark, []) == [] and searched(spark, [(1, [1.0])]) == [] and searched(spark, [(50, [1.0])]) == []


def test_repeated_rows(spark):
    """Copies of a row are candidates one by one, also for one another."""
    rows = [(1, [2.0, 1.0]), (1, [2.0, 1.0]), (0, [1.0, 0.0]), (0, [1.0, 0.0]), (50, [1.0, 1.0]), (50, [3.0, 1.0]), *[(7, [9.0, 9.0])] * 20]
    assert searched(spark, rows) == brute(rows)
    assert searched(spark, rows[:3]) == [(0, 1, 1, 131072), (0, 2, 1, 131072)]


def test_it_stops_before_reading_everything():
    rnd = np.random.default_rng(4)
    vectors = np.floor(rnd.pareto(1.2, size=(4000, 3)) * 10)
    ids, order = np.arange(4000), np.argsort(vectors.T, axis=1, kind="stable")
    query = np.array([3.0, 1.0, 2.0])
    scores, found, scored = topk.threshold_search(ids, vectors, ids < 0, query, order, 5)
    want = sorted((-float(v @ query), i) for i, v in enumerate(vectors))[:5]
    assert [(-s, i) for s, i in zip(scores, found)] == want
    assert scored < 1000
