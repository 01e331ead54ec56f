"""SimHash components against brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import components, simhash


def brute(prints: dict, distance: int = 3) -> dict:
    ids = sorted(prints)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if ((prints[a] ^ prints[b]) & (2**64 - 1)).bit_count() <= distance:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def slow_print(text, shingle=3):
    import xxhash

    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprint_is_the_majority_of_spark_hashes(spark):
    texts = ["A b  C d\te", "one", "", None, "x y", "É à ü " * 50, "a b c " * 999]
    for t in texts:
        assert simhash.fingerprint_of(t) % 2**64 == slow_print(t)
    hashed = spark.sql("select xxhash64('a b c') h").first().h
    assert simhash.fingerprint_of("A b c") == hashed


def test_small_documents(spark):
    rnd = random.Random(5)
    base = [" ".join(rnd.choice("abcdefghij") * rnd.randint(1, 3) for _ in range(200)) for _ in range(30)]
    texts = []
    for t in base:
        texts.append(t)
        for _ in range(rnd.randint(0, 4)):
            words = t.split()
            words[rnd.randrange(200)] = "zz"
            texts.append(" ".join(words))
    texts += ["", None, " \n ", texts[0], texts[0].upper()]
    rows = [(i, t, 1) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp int")
    got = {r.doc_id: (r.fingerprint % 2**64, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    prints = {i: slow_print(t) for i, t, _ in rows}
    want = brute(prints)
    assert got == {i: (prints[i], want[i]) for i in prints}
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == set(want.values())


@pytest.mark.parametrize("tile", [16, 8192])
def test_dense_and_chained_groups(spark, tile):
    rnd = np.random.default_rng(3)
    near = [0x123456789ABCDEF0 ^ sum(1 << int(b) for b in rnd.choice(64, 3, replace=False)) for _ in range(200)]
    chain = [(1 << (3 * k)) - 1 for k in range(21)]
    far = [int(x) for x in rnd.integers(0, 2**63, 100)]
    values = sorted({simhash._signed(v) for v in near + chain + far})
    prints = spark.createDataFrame([(v,) for v in values], "fp long")
    got = {r.node: r.root for r in components.connected(simhash.links(prints, 3, tile)).collect()}
    want = {k: v for k, v in brute({v: v for v in values}).items()}
    assert {v: got.get(v, v) for v in values} == want


@pytest.mark.parametrize("parts", [1, 2, 3, 4])
def test_every_plan_finds_all_links(spark, parts, monkeypatch):
    rnd = np.random.default_rng(parts)
    base = rnd.integers(0, 2**63, 40)
    values = sorted({int(b) ^ sum(1 << int(x) for x in rnd.choice(62, k, replace=False)) for b in base for k in range(4)})
    if parts == 1:
        values = values[:30]
    sizes = {1: [3], 2: [1, 1], 3: [0, 1, 0], 4: [0, 0, 0, 0]}[parts]
    sample = np.array(values, dtype=np.int64).view(np.uint64)
    chosen = [simhash.Partition(g, t) for g, t in zip(simhash.group_bits(sample, parts), sizes)]
    monkeypatch.setattr(simhash, "plan", lambda *a: chosen)
    prints = spark.createDataFrame([(v,) for v in values], "fp long")
    got = {r.node: r.root for r in components.connected(simhash.links(prints)).collect()}
    assert {v: got.get(v, v) for v in values} == brute({v: v for v in values})


def test_plan_grows_with_the_rows():
    sample = np.random.default_rng(1).integers(0, 2**63, 500).astype(np.uint64)
    few = simhash.plan(sample, 10_000, 3)
    many = simhash.plan(sample, 10**9, 3)
    assert len(few) > len(many) and min(len(p.bits) for p in many) > max(len(p.bits) for p in few)
    cost = [{-1: 0, 0: 5, 1: 50}, {-1: 0, 0: 1, 1: 2}, {-1: 0, 0: 9, 1: 90}]
    assert simhash.allocate(cost, 0) == (7.0, [0, 1, -1])


def test_odd_rows(spark):
    schema = "doc_id long, text string, root string, digest string"
    assert simhash.near_duplicates(spark.createDataFrame([], schema)).count() == 0
    assert simhash.keep_one(spark.createDataFrame([], schema)).count() == 0
    docs = spark.createDataFrame(
        [(None, None, "r", None), (None, "a b c d", None, "d"), (7, "a b c d", "", ""), (7, "a b c d", "", ""), (9, "q " * 100_000, "", "")],
        schema,
    )
    got = sorted(((r.doc_id, r.component_id) for r in simhash.near_duplicates(docs).collect()), key=str)
    assert got == sorted([(None, None), (None, 7), (7, 7), (7, 7), (9, 9)], key=str)
    assert sorted(simhash.keep_one(docs).select("doc_id").collect(), key=str) == [(7,), (9,), (None,)]


def test_links_to_oneself_and_repeats(spark):
    edges = spark.createDataFrame([(1, 1), (2, 1), (1, 2), (5, 4), (4, 3), (None, 9)], "u long, v long")
    got = {(r.node, r.root) for r in components.connected(edges).collect()}
    assert got == {(1, 1), (2, 1), (3, 3), (4, 3), (5, 3)}
    assert components.connected(edges.where(F.lit(False))).count() == 0
