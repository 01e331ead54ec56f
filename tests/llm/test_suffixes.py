"""Repeated strings against brute force."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from millrace.llm import suffixes

SCHEMA = "doc_id long, text string, kept int, removed int, rank int"


def brute(texts, length):
    data = [(t or "").encode() for t in texts]
    seen: dict[bytes, int] = {}
    for d in data:
        for i in range(len(d) - length + 1):
            seen[d[i : i + length]] = seen.get(d[i : i + length], 0) + 1
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(d), sum(gone), runs, bytes(b for b, g in zip(d, gone) if not g)))
    return out


def found(spark, texts, length):
    frame = spark.createDataFrame([(n, t, 0, 0, 0) for n, t in enumerate(texts)], SCHEMA).repartition(3)
    rows = suffixes.remove_repeats(frame, length=length).select(
        "doc_id", "n_bytes", F.expr("aggregate(removed, 0L, (a, r) -> a + r.end - r.start)").alias("gone"), F.size("removed").alias("runs"), "kept"
    ).collect()
    return [(r.n_bytes, r.gone, r.runs, bytes(r.kept)) for r in sorted(rows, key=lambda r: r.doc_id)]


def check(spark, texts, length):
    assert found(spark, texts, length) == brute(texts, length)


def corpus(rnd, letters, texts, size):
    """Texts with passages in common, copies, changed copies and stutters."""
    def words(n):
        return "".join(rnd.choice(letters) for _ in range(n))

    shared = [words(rnd.randint(size // 4, size)) for _ in range(6)]
    out: list = []
    for _ in range(texts):
        kind = rnd.random()
        if kind < 0.2 and out:
            out.append(rnd.choice(out))
        elif kind < 0.5 and out:
            base = list(rnd.choice(out))
            for _ in range(rnd.randint(1, 3)):
                if base:
                    base[rnd.randrange(len(base))] = rnd.choice(letters)
            out.append("".join(base))
        else:
            parts = [words(rnd.randint(0, size)) for _ in range(rnd.randint(0, 3))]
            for _ in range(rnd.randint(0, 2)):
                part = rnd.choice(shared)
                at = rnd.randrange(len(part))
                parts.insert(rnd.randint(0, len(parts)), part[at : at + rnd.randint(1, size)])
            out.append("".join(parts))
    return out


@pytest.mark.parametrize("length,letters,seed", [(16, "ab", 1), (20, "abc", 2), (40, "abcdefgh ñé", 3), (400, "abcdefghijkl mnop", 4), (600, "ab", 5)])
def test_random_texts(spark, length, letters, seed):
    rnd = random.Random(seed)
    check(spark, corpus(rnd, letters, 60, 4 * length), length)


def test_periods_and_edges(spark):
    length = 20
    texts = ["a" * 19, "a" * 20, "a" * 21, "b" * 20, "ab" * 30, "abc" * 9, "x" + "q" * 40 + "y", "0123456789" * 2, "z0123456789" * 2]
    check(spark, texts, length)
    check(spark, ["a" * 5000], length)
    check(spark, ["é" * 11, "é" * 9 + "xx"], length)  # strings may begin and end inside a character


def test_edge_of_a_repeat(spark):
    # the repeat is exactly as long as asked for, one byte longer, one byte shorter
    rnd = random.Random(7)
    for size in (39, 40, 41):
        middle = "".join(rnd.choice("abcdef") for _ in range(size))
        check(spark, ["1" * 70 + middle + "2" * 3, "3" * 9 + middle + "4" * 80, middle], 40)


def test_odd_rows(spark):
    long = "".join(random.Random(1).choice("abcdefghij ") for _ in range(300_000))
    check(spark, [None, "", " ", None, "", long, long[1000:1500], "short"], 400)
    check(spark, [], 400)
    assert found(spark, ["same text of some length"] * 50, 16) == [(24, 24, 1, b"")] * 50
    frame = spark.createDataFrame([(None, "a" * 50), (None, "a" * 50), (None, None)], "kept string, text string")
    rows = suffixes.remove_repeats(frame, keep=["kept"], length=16).collect()
    assert rows[0].asDict().keys() == {"kept", "n_bytes", "removed", "kept_1"}
    assert sorted(r.n_bytes for r in rows) == [0, 50, 50]
    with pytest.raises(ValueError):
        suffixes.remove_repeats(frame, keep=["kept"], length=4)


def test_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "BLOCK_BYTES", 300)
    rnd = random.Random(11)
    check(spark, corpus(rnd, "abcdef", 80, 120), 32)
