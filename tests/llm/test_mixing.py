"""Targets against the iterated rule, copies, reruns and odd rows."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from millrace.llm import mixing


def iterated(sizes, weights, limit=3):
    total, full = sum(sizes.values()), {}
    while True:
        rest = {s: w for s, w in weights.items() if s not in full}
        left = total - sum(full.values())
        target = {s: left * w / sum(rest.values()) for s, w in rest.items()}
        over = [s for s in rest if target[s] > limit * sizes[s]]
        if not over:
            return full | target
        full |= {s: limit * sizes[s] for s in over}


@pytest.mark.parametrize("seed", range(6))
def test_targets(spark, seed):
    rnd = random.Random(seed)
    names = [f"s{i}" for i in range(rnd.randint(1, 12))] + [None] * (seed % 2)
    sizes = {n: rnd.choice([0, 1, 5, 40, 1000, 100_000]) for n in names}
    order = sorted(names, key=lambda n: (n is None, n))
    weights = {n: i % 3 + 1 for i, n in enumerate(order)}
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(frame, mixing.cycled_weight()).collect()}
    assert got == pytest.approx(iterated(sizes, weights))


def test_copies_follow_the_rates(spark):
    docs = spark.range(6000).select(
        F.col("id").alias("doc_id"),
        F.concat(F.lit("a"), F.repeat(F.lit(" b"), (F.col("id") % 5).cast("int"))).alias("text"),
        F.when(F.col("id") < 4000, "big").when(F.col("id") < 5500, "mid").otherwise("tiny").alias("source"),
        F.lit(1).alias("mix_size"),
    )
    planned = mixing.plan_mix(docs)
    assert planned.columns[-4:] == ["mix_size_1", "mix_source_size", "mix_target", "mix_copies"]
    rows = planned.collect()
    assert rows == mixing.plan_mix(docs.repartition(7)).orderBy("doc_id").collect() or sorted(rows) == sorted(
        mixing.plan_mix(docs.repartition(7)).collect()
    )
    for source in ("big", "mid", "tiny"):
        own = [r for r in rows if r.source == source]
        taken = sum(r.mix_copies * r.mix_size_1 for r in own)
        assert taken == pytest.approx(own[0].mix_target, rel=0.08)
        rate = own[0].mix_target / own[0].mix_source_size
        assert {r.mix_copies for r in own} <= {int(rate), int(rate) + 1} and max(r.mix_copies for r in own) <= 3
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(r.mix_copies for r in rows)


def test_rows_without_ids_and_equal_rows_are_drawn_one_by_one(spark):
    rows = [(None, f"a b {n} c d e f g h i", "x", "") for n in range(2000)]  # no ids
    rows += [(7, "q r s t u v w x y z", "y", "")] * 2000  # one row, repeated
    rows += [(n, f"{n} m n o p q r s t u", "z", "") for n in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, mix_digest string").repartition(5)
    found = mixing.plan_mix(docs).collect()
    for source in "xyz":
        own = [r for r in found if r.source == source]
        assert len(own) == 2000
        assert sum(r.mix_size * r.mix_copies for r in own) == pytest.approx(own[0].mix_target, rel=0.1)
    again = mixing.plan_mix(docs.repartition(3)).collect()
    assert sorted(map(str, again)) == sorted(map(str, found))


def test_odd_rows(spark):
    schema = "doc_id long, text string, source string, mix_target string"
    docs = spark.createDataFrame([(None, None, None, None), (1, "", "a", ""), (1, "x y", "a", ""), (1, "x y", "a", ""), (2, " \n", None, "")], schema)
    rows = mixing.plan_mix(docs).collect()
    assert len(rows) == 5
    assert all(r.mix_copies == 0 for r in rows if r.source is None)
    assert [r.mix_copies for r in rows if r.text == "x y"] == [1, 1]
    assert mixing.plan_mix(docs.limit(0)).count() == 0 and mixing.mix(docs.limit(0)).count() == 0
    empty = spark.createDataFrame([(1, None, "a", "")], schema)
    assert [r.mix_copies for r in mixing.plan_mix(empty).collect()] == [0]
