"""Folding branches one by one equals the cross product of all of them."""

from __future__ import annotations

import itertools
import json
import random

from pyspark.sql import functions as F

from millrace.functions import nested, text

SCHEMA = (
    "struct<a:array<struct<k:string,v:string,c:array<struct<x:string>>>>,b:array<struct<k:string,v:string>>>"
)


def outer(array):
    return array or [{}]


def product(doc):
    """Brute force: every combination of elements, then MAX and a distinct set."""
    rows = []
    for a, b in itertools.product(outer(doc.get("a")), outer(doc.get("b"))):
        for c in outer(a.get("c")):
            rows.append(
                (
                    a.get("v") if a.get("k") == "p" else "",
                    a.get("v") if a.get("k") == "p" else None,
                    b.get("v") if b.get("k") == "q" else " ",
                    c.get("x"),
                    None if a.get("k") is None or c.get("x") is None else a["k"] + ":" + c["x"],
                )
            )
    columns = list(zip(*rows))

    def top(values):
        known = [v for v in values if v is not None]
        return max(known) if known else None

    listed = "||".join(sorted({v for v in columns[4] if v is not None}))
    return (*[top(c) for c in columns[:4]], listed)


def random_doc(rng):
    def value(letters):
        return rng.choice([*letters, None])

    def element(keys):
        return {k: v for k, v in (("k", value(keys)), ("v", value("uvw"))) if v is not None}

    doc = {}
    for name, keys in (("a", "pr"), ("b", "qs")):
        size = rng.choice([None, 0, 1, 2, 3])
        if size is not None:
            doc[name] = [element(keys) for _ in range(size)]
    for e in doc.get("a", []):
        size = rng.choice([None, 0, 1, 2])
        if size is not None:
            e["c"] = [{"x": v} if v else {} for v in (value("xyz") for _ in range(size))]
    return doc


def test_branches_equal_cross_product(spark):
    rng = random.Random(7)
    docs = [random_doc(rng) for _ in range(400)]
    rows = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)], "i int, doc string")
    parsed = rows.select("i", F.from_json("doc", SCHEMA).alias("doc"))
    both = nested.pairs("doc.a", "o", "o.c", "c", nested.packed(k="o.k", x="c.x"))
    out = parsed.withColumn("both", F.expr(both)).select(
        "i",
        F.expr(nested.tagged(nested.elements("doc.a"), "e.k = 'p'", "e.v", "")),
        F.expr(nested.tagged(nested.elements("doc.a"), "e.k = 'p'", "e.v")),
        F.expr(nested.tagged(nested.elements("doc.b"), "e.k = 'q'", "e.v", " ")),
        F.expr(nested.best("both", "e.x")),
        F.expr(nested.joined_set("transform(both, e -> concat(e.k, ':', e.x))", "||")),
    )
    got = {r[0]: tuple(r)[1:] for r in out.collect()}
    for i, doc in enumerate(docs):
        assert got[i] == product(doc), doc


def test_lone_match_without_value_stays_null(spark):
    rows = spark.sql("""select from_json('{"a":[{"k":"p"}]}', 'a array<struct<k:string,v:string>>') as doc""")
    value = rows.select(F.expr(nested.tagged(nested.elements("doc.a"), "e.k = 'p'", "e.v", ""))).first()[0]
    assert value is None


def test_text_traps(spark):
    row = spark.range(1).select(
        F.array_join(text.tokens(F.lit("a||b|c"), "||"), ",").alias("tokens"),
        F.array_join(text.literal_split(F.lit("a||b|c"), "||"), ",").alias("literal"),
        text.joined_set(F.array().cast("array<string>"), ",").alias("empty"),
        text.segment(F.lit("a/b"), 5).alias("beyond"),
        text.segment(F.lit(None).cast("string"), 1).alias("missing"),
        text.active_flag(F.lit("2024-01-01").cast("date"), F.lit(None).cast("date"), F.lit("2025-01-01").cast("date")).alias("open"),
        text.bool_flag(F.lit("maybe")).alias("maybe"),
        text.squeeze(F.lit("a   b")).alias("squeezed"),
        text.strip_blanks(F.lit(" a  b ")).alias("stripped"),
    ).first()
    assert tuple(row) == ("a,b,c", "a,b|c", "", "", None, "T", None, "a b", "ab")


def test_quoted(spark):
    for value in ("it's", "a\\b", "line\nbreak", ""):
        assert spark.range(1).select(F.expr(nested.quoted(value))).first()[0] == value


def test_tail_is_the_last_piece_of_any_text(spark):
    texts = ["", "/", "a", "a/", "/a", "a//b", "é/ü", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").selectExpr(
        f"{nested.tail('t')} as found", "split_part(t, '/', -1) as wanted"
    )
    assert [r.found for r in rows.collect()] == [r.wanted for r in rows.collect()]
    assert "split" not in nested.tail("t")  # which makes an array of all pieces for every element of every document
