"""The automaton's scores against a model written out with dictionaries."""

from __future__ import annotations

import math
import zlib
from collections import Counter

import pytest

from millrace.llm import lm, queries


def brute(rows):
    """{row number: (n_tokens, n_known, N, base, score)} from counts over plain strings."""
    texts = [["", *("".join(c.lower() if "A" <= c <= "Z" else c for c in t or "").encode().split()), ""] for _, t, _ in rows]
    words, pairs = Counter(), Counter()
    for tokens, (_, _, train) in zip(texts, rows):
        if train:
            words.update(tokens[1:])
            pairs.update(zip(tokens, tokens[1:]))
    n, types = sum(words.values()), len(words)
    once, twice = (sum(v == k for v in words.values()) for k in (1, 2))
    discount = once / (once + 2 * twice) if once else 0.5

    def root(w):
        return max(words[w] - discount, 0) / n + discount * types / n / (types + 1) if n else 1.0

    out = []
    for tokens in texts:
        base = sum(math.log10((words[w] + 1) / (n + types + 1)) for w in tokens[1:])
        total = 0.0
        for v, w in zip(tokens, tokens[1:]):
            trust = lm.TRUST * words[v] / (words[v] + lm.DOUBT)
            own = trust * pairs[v, w] / words[v] if pairs[v, w] else 0.0
            total += math.log10(own + (1 - trust) * root(w))
        out.append((len(tokens) - 1, sum(words[w] > 0 for w in tokens[1:]), n, base, total))
    return out


def compare(got, want):
    assert got[:3] == want[:3]
    assert got[3:] == pytest.approx(want[3:], rel=1e-9, abs=1e-9)


@pytest.mark.parametrize("block", [1, 300, 8 << 20])
def test_small_texts(spark, block, monkeypatch):
    monkeypatch.setattr(lm, "BLOCK_BYTES", block)
    texts = ["a b a b c", "A  B\tc", "", None, " \n", "x y z", "é É ß", "a b " * 400, "new words here", "a b a b c"]
    rows = [(i, t, i % 3 != 2) for i, t in enumerate(texts)] + [(None, "a b", True), (2**62 + 1, "c", False)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, learn boolean, train string")
    if block == 1:  # the patch does not reach the workers; many partitions make many blocks
        docs = docs.repartition(5, "doc_id").sortWithinPartitions("doc_id")
    got = {r.doc_id: r for r in lm.score(docs, docs["learn"]).collect()}
    assert len(got) == len(rows)
    for row, want in zip(rows, brute(rows)):
        r = got[row[0]]
        assert r.train == row[2]
        compare((r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score), want)


def test_nothing_learned_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id int, text string")
    from pyspark.sql import functions as F

    for r in lm.score(docs, F.lit(False)).collect():
        assert (r.train_tokens, r.n_known, r.base_score, r.score) == (0, 0, 0.0, 0.0)
    assert lm.score(docs.limit(0), F.lit(True)).count() == 0


def test_documents(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    rows = [(d.doc_id, d.text, zlib.crc32(str(d.doc_id).encode()) % 7 != 2) for d in docs]
    got = {r.doc_id: r for r in queries.QUERIES["op3_lm"](spark, folder).collect()}
    assert len(got) == len(rows)
    better = base = 0.0
    for row, want in zip(rows, brute(rows)):
        r = got[row[0]]
        assert r.held_out == (not row[2])
        compare((r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score), want)
        if r.held_out:
            better, base = better + r.score, base + r.base_score
    assert better > base


def test_probabilities_add_up():
    import numpy as np

    texts = ["a b a c", "b b a", "d"]
    block = lm._Block(texts)
    words, pairs = block.counts(np.array([True, True, False]))
    n, types = int(words.sum()), int((words > 0).sum())
    model = lm.Automaton(block, words, pairs, n, types, 0.6)
    known = [t for t in range(block.size) if model.counts[t]]
    unknown = next(t for t in range(block.size) if not model.counts[t])
    for state in range(block.size):
        total = 0.0
        for token in [*known, unknown]:
            place = np.flatnonzero(block.pairs == state * block.size + token)
            weight = model.arcs[place[0]] if len(place) else None
            total += 10 ** (model.failure[state] + model.root[token] if weight is None else weight)
        assert total == pytest.approx(1.0)
