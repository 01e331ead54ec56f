"""License scans: planted notices, held-out paragraphs, odd rows."""

from __future__ import annotations

import re
import textwrap
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import licenses, queries

SCHEMA = "doc_id long, text string, words int, family string"


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_documents(spark, folder):
    rows = queries.QUERIES["op2_licenses"](spark, folder).where("confirmed").collect()
    got = sorted((r.doc_id, r.paragraph, r.family) for r in rows)
    notices = {
        "Licensed under CC BY-NC 4.0.": "cc-nc", "Licensed under the Apache License, Version 2.0.": "apache", "All rights reserved.": "reserved",
        "This work is licensed under the GNU General Public License, version 3.": "gpl", "Released under the MIT License.": "mit",
    }
    want = [
        (d.doc_id, n, notices[line])
        for d in spark.read.parquet(f"{folder}/documents.parquet").collect()
        for n, line in enumerate(d.text.split("\n")) if line in notices
    ]
    assert want and set(want) <= set(got)
    assert len(got) <= 1.02 * len(want) + 1


def test_variants_and_plain_text(spark):
    plain = [f"the quick brown fox {i} jumps over all the lazy dogs and permits no other version of the works" for i in range(300)]
    planted = {
        500: ("RELEASED UNDER THE MIT LICENSE", "mit"),
        501: ("(c) 2020: Redistribution and use in source and binary forms, with or without modification, are permitted", "bsd"),
        502: ("This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License!", "cc-nc"),
        503: ("This program is free software: you can redistribute it and modify it under the terms of the GNU General Public License "
              "as published by the Free Software Foundation", "gpl"),
    }
    rows = [(i, t, 1, "x") for i, t in enumerate(plain)] + [(i, f"intro words here\n{t}\nmore words", 1, "x") for i, (t, _) in planted.items()]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = {r.doc_id: (r.paragraph, r.family) for r in licenses.scan(docs).where("confirmed").collect()}
    assert got == {i: (1, f) for i, (_, f) in planted.items()}


def test_wrapped_headers(spark):
    plain = [f"the quick brown fox {i} jumps over all the lazy dogs and permits no other version of the works" for i in range(300)]
    rows = [(i, t, 1, "x") for i, t in enumerate(plain)]
    headers = {
        "mit": licenses.TEMPLATES["mit"][2] + ", including without limitation the rights to use, copy, modify, merge, publish",
        "bsd": licenses.TEMPLATES["bsd"][1] + ":", "gpl": licenses.TEMPLATES["gpl"][1],
    }
    want = {}
    for family, header in headers.items():
        for mark in ("", " * ", "# "):
            want[1000 + len(want)] = (2, family)
            body = "\n".join(mark + x for x in textwrap.wrap(header, 72))
            rows.append((999 + len(want), f"intro words here\n\n{body}\n\nmore words", 1, "x"))
    got = licenses.scan(spark.createDataFrame(rows, SCHEMA)).where("confirmed").collect()
    assert {r.doc_id: (r.paragraph, r.family) for r in got} == want and len(got) == len(want)


PAIRS = {f: [set(p) for p in pairs] for f, pairs in licenses._template_pairs().items()}


def brute(text):
    """For each family the largest share of a template's word pairs."""
    w = re.findall(r"[^\W_]+", text.lower())
    held = {f"{a} {b}" for a, b in zip(w, w[1:])}
    return {f: max(len(held & t) / len(t) for t in templates) for f, templates in PAIRS.items()}


def test_likeness(spark):
    some = ["All rights reserved", "all rights", "x", "", "Released under the MIT License", "released under the GNU License"]
    some += [t for templates in licenses.TEMPLATES.values() for t in templates]
    frame = spark.createDataFrame([(t,) for t in some], "t string").select("t", licenses._words(F.col("t")).alias("words"))
    for r in frame.select("t", licenses.likeness(F.col("words")).alias("best"), licenses.compared(F.col("words"), F.lit("mit")).alias("mit")).collect():
        want = brute(r.t)
        assert r.best == pytest.approx(max(want.values()))
        assert r.mit.similarity == pytest.approx(want["mit"])
        assert r.mit.other == pytest.approx(max(v for f, v in want.items() if f != "mit"))


PLAIN = [f"the quick brown fox {i} jumps over all the lazy dogs and permits no other version of the works" for i in range(300)]


def test_every_notice_has_its_family_or_none(spark):
    """Each template on a line of its own, wrapped, and behind comment marks: right, or not confirmed."""
    rows, want = [(i, t, 1, "x") for i, t in enumerate(PLAIN)], {}
    for family, templates in licenses.TEMPLATES.items():
        for t in templates:
            for body in (t, "\n".join("// " + x for x in textwrap.wrap(t, 72))):
                want[1000 + len(want)] = family
                rows.append((999 + len(want), f"intro words here\n\n{body}\n\nmore words", 1, "x"))
    got = {}
    for r in licenses.scan(spark.createDataFrame(rows, SCHEMA)).where("confirmed").collect():
        got.setdefault(r.doc_id, set()).add(r.family)
    assert all(f == {want.get(i)} for i, f in got.items())
    missed = {want[i] for i in want if i not in got}
    assert len(got) >= 0.95 * len(want), missed


def test_close_families(spark):
    """Changed headers of families that differ by a word are never confirmed as the other family."""
    rows, want = [(i, t, 1, "x") for i, t in enumerate(PLAIN)], {}
    header = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {}General Public License as published by the Free Software Foundation, either version {} of the License, or (at your option) any later version."
    for name, family in (("", "gpl"), ("Lesser ", "lgpl"), ("Affero ", "agpl")):
        for version in ("2", "3", "3.0"):
            want[1000 + len(want)] = family
            rows.append((999 + len(want), header.format(name, version), 1, "x"))
    for name, family in (("", "cc"), ("-SA", "cc"), ("-NC", "cc-nc"), ("-NC-SA", "cc-nc"), ("-ND", "cc-nd"), ("-NC-ND", "cc-nc-nd")):
        for version in ("3.0", "4.0"):
            want[1000 + len(want)] = family
            rows.append((999 + len(want), f"Licensed under CC BY{name} {version}.", 1, "x"))
    got = licenses.scan(spark.createDataFrame(rows, SCHEMA)).where("confirmed").collect()
    assert all(want.get(r.doc_id) == r.family for r in got)
    assert {r.family for r in got} == set(want.values())


def test_findings_match_brute_force(spark):
    """similarity and confirmed of every finding worked out again from the text."""
    folder = "/root/testdata/sf0.01"
    texts = {d.doc_id: d.text.split("\n") for d in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = queries.QUERIES["op2_licenses"](spark, folder).collect()
    assert rows
    for r in rows:
        lines = texts[r.doc_id][r.paragraph :]
        tries = [brute(" ".join(lines[:n])) for n in range(1, min(len(lines), 12) + 1)]  # wrapped notices are joined
        assert any(
            r.similarity == pytest.approx(t[r.family])
            and r.confirmed == (t[r.family] >= licenses.CONFIRMED and all(t[r.family] > v for f, v in t.items() if f != r.family))
            for t in tries
        )


def test_odd_rows(spark):
    odd = [(None, None, 1, None), (1, "", 1, ""), (1, " \n\n?!", 1, ""), (2, "w " * 200_000, 1, ""), (3, "All rights reserved.", 1, ""), (3, "All rights reserved.", 1, "")]
    got = licenses.scan(spark.createDataFrame(odd, SCHEMA)).where("confirmed").collect()
    assert [(r.doc_id, r.family) for r in got] == [(3, "reserved")] * 2
    assert licenses.scan(spark.createDataFrame([], SCHEMA)).count() == 0


def test_every_paragraph_is_learned_from(spark, monkeypatch):
    """The unknown class holds each distinct paragraph once, however many there are, all of them with a bounded weight."""
    some = ["the work", "the software and", "or the", "nothing known", "in any version of the work"]
    lines = [f"{some[i % 5]} x{i}" for i in range(9000)]
    rows = [(i, "\n".join(lines[10 * i : 10 * i + 10]), 1, "x") for i in range(900)]
    rows += [(1000, lines[7], 1, "x"), (1001, "All rights reserved.\n!?\n" + lines[8], 1, "x"), (1002, None, 1, "x")]
    seen, learn = [], licenses.LogisticRegression.fit

    def fit(self, examples, *more):
        weight = F.col("weight") if "weight" in examples.columns else F.lit(1.0)
        found = examples.where(F.col("label") == licenses.FAMILIES.index(licenses.UNKNOWN)).select("features", weight.alias("weight"))
        seen.extend((tuple(r.features.indices), r.weight) for r in found.collect())
        return learn(self, examples, *more)

    monkeypatch.setattr(licenses.LogisticRegression, "fit", fit)
    assert licenses.scan(spark.createDataFrame(rows, SCHEMA)).where("confirmed").count() == 1
    got = Counter()
    for features, weight in seen:
        got[features] += weight
    assert len(got) == 5 and len(set(map(round, got.values()))) == 1  # 1800 distinct paragraphs each
    assert sum(got.values()) == pytest.approx(licenses.UNKNOWN_WEIGHT)


@pytest.mark.parametrize("total", [1, 2, 999, 1001, 5000, 40_000])
def test_threshold_of_all_paragraphs(spark, total):
    random = np.random.default_rng(total)
    values = random.choice(random.beta(0.2, 2, 500), total)
    counts = Counter(v for v in values.tolist() if v >= licenses.LEAST_SURE)
    seen = spark.createDataFrame(sorted(counts.items()), "value double, n long")
    want = np.quantile(np.where(values >= licenses.LEAST_SURE, values, licenses.LEAST_SURE), 1 - licenses.FALSE_SHARE)
    assert licenses._threshold(seen, total) == pytest.approx(max(licenses.LEAST_SURE, want))


def test_half_like(spark):
    """The comparison that leaves most paragraphs out agrees with the whole one."""
    texts = [t for templates in licenses.TEMPLATES.values() for t in templates]
    words = [re.findall(r"[a-z0-9]+", t.lower()) for t in texts]
    some = [" ".join(w[a : a + len(w) * n // 8]) for w in words for n in (2, 3, 4, 5, 8) for a in (0, len(w) // 3)]
    frame = spark.createDataFrame([(t,) for t in some], "t string").select("t", licenses._pairs(licenses._words(F.col("t"))).alias("pairs"))
    for r in frame.select("t", licenses._half_like(F.col("pairs")).alias("half")).collect():
        assert r.half == (max(brute(r.t).values()) >= 0.5), r.t
