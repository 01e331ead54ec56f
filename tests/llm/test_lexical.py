"""Lexical search against brute force."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from millrace.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
DOCS = "doc_id long, text string, rank int, score string, item_id int"
ITEMS = "item_id long, text string, score int, doc_id int"


def brute(docs, items, k=10):
    held = [(i, Counter(TERM.findall(t.translate(LOWER)))) for i, t in docs if t]
    held = [(i, c) for i, c in held if c]
    n_docs, n_terms = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        terms = set(TERM.findall((text or "").translate(LOWER)))
        weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) for t in terms}
        scored = []
        for i, c in held:
            m = 10 + 90 * sum(c.values()) * n_docs // n_terms
            score = sum(weight[t] * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t in terms if t in c)
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, r + 1, s[3], -s[0]) for r, s in enumerate(sorted(scored)[:k])]
    return sorted(map(str, out))


def check(spark, docs, items, k=10):
    left = spark.createDataFrame([(i, t, 0, "", 0) for i, t in docs], DOCS).repartition(3)
    right = spark.createDataFrame([(i, t, 0, 0) for i, t in items], ITEMS)
    found = lexical.search(left, right, k)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(str(tuple(r)) for r in found.collect()) == brute(docs, items, k)


def corpus(rnd, size, vocabulary):
    words = [f"w{n}" for n in range(vocabulary)]
    share = [1 / (n + 1) for n in range(vocabulary)]
    return [(n, " ".join(rnd.choices(words, share, k=rnd.randint(1, 60)))) for n in range(size)]


@pytest.mark.parametrize("seed,block,batch", [(1, 4 << 20, 1 << 20), (2, 900, 200), (3, 1, 60)])
def test_random_documents(spark, monkeypatch, seed, block, batch):
    monkeypatch.setattr(lexical, "BLOCK_BYTES", block)
    monkeypatch.setattr(lexical, "BATCH_BYTES", batch)
    rnd = random.Random(seed)
    docs = corpus(rnd, 300, 80)
    docs += [(1000 + n, docs[5][1]) for n in range(40)]  # copies tie
    items = [(n, rnd.choice(docs)[1]) for n in range(12)]
    check(spark, docs, items)
    check(spark, docs, items, k=3)


def test_odd_rows(spark):
    docs = [(1, "Alpha beta, ALPHA;gamma_delta"), (2, None), (3, ""), (4, "?! -"), (None, "alpha"), (5, "ñandú Ñandú é1"), (6, "alpha")]
    docs += [(6, "alpha"), (-3, "alpha"), (7, "beta\x00beta\x7fbeta"), (8, "x " * 200_000 + "alpha")]
    items = [(1, "alpha"), (1, "alpha"), (2, "gamma zzz"), (3, None), (4, ""), (None, "ÑANDÚ ñandú"), (5, "delta ALPHA beta beta é1"), (6, "nothing"), (1, "beta")]
    check(spark, docs, items)
    check(spark, docs, [])
    check(spark, [], items)
    check(spark, [(1, None)], items)
    check(spark, [(1, "same words")], [(1, "same words")])


def test_pairs_skip_more_than_terms(spark):
    """Two words that never meet: their pair bounds a document by the larger of both."""
    rnd = np.random.default_rng(1)
    docs = [(n, ("red " if n % 2 else "blue ") + " ".join(f"z{x}" for x in rnd.integers(0, 50, 20))) for n in range(400)]
    row = dict(zip(lexical._INDEX.names, lexical._index_row([n for n, _ in docs], [t for _, t in docs])))
    queries = lexical.Queries([1], [1], [b"red", b"blue"], [np.array([0, 1])])
    queries.weigh({0: 200, 1: 200}, 400)
    lists = {w: (np.arange(1 - w, 400, 2), np.arange(1, 201)) for w in (0, 1)}
    joint = lexical._pair_maxima(lists, queries.pairs, 400)
    assert joint.tolist() == [0]
    block = lexical.Block({
        "n_docs": 400, "ids": row["ids"], "words": lexical._pack(np.array([0, 1])), "counts": lexical._pack(np.array([200, 200])),
        "docs": lexical._pack(np.concatenate([d for d, _ in lists.values()])), "impacts": lexical._pack(np.concatenate([v for _, v in lists.values()])),
        "joint": lexical._pack(joint),
    }, 2)
    best = lexical._Best(1)
    best.add(np.array([250]), np.array([-1]), np.array([False]))
    assert block.most.sum() == 400  # the terms alone could reach 250
    assert block.search(queries.terms[0], queries.pairs_of[0], best) == 0
    assert block.search(queries.terms[0], queries.pairs_of[0][:0], best) > 0


def test_packing():
    for values in ([], [0, 255], [256], [2**33, 1]):
        assert lexical._unpack(lexical._pack(np.array(values, np.int64))).tolist() == values
    ids, nulls = lexical._ids(lexical._index_row([5, None, -2], ["a", "b", "c"])[0], 3)
    assert ids.tolist() == [5, 0, -2] and nulls.tolist() == [False, True, False]
