"""Quality rules: brute-force statistics, boilerplate lines, odd rows."""

from __future__ import annotations

import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.llm import quality
from millrace.llm.text import word_count, words

SCHEMA = "doc_id long, text string, source string, digest string, cut int, removed_id int"


def brute(text):
    text = text or ""
    found = re.findall(r"[^\x20\x09-\x0D]+", text)
    places = {}
    for i in range(len(found) - 7):
        places.setdefault(tuple(found[i : i + 8]), []).append(i)
    covered = {j for group in places.values() if len(group) > 1 for i in group for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(found) < 20 or 100 * len(covered) > 30 * len(found)
    return (
        len(found), sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed
    )


def judged(spark, texts):
    docs = spark.createDataFrame([(i, t, "s", "", 0, 0) for i, t in enumerate(texts)], SCHEMA)
    columns = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    return [tuple(r) for r in quality.judge(docs).orderBy("doc_id").select(columns).collect()]


def test_random_texts(spark):
    rnd = random.Random(1)
    texts = [None, "", " \n\x0b", " ", "a" * 300_000, "w " * 40_000, "é|ß #\n\n#\n#", "x y\x85z"]
    for size in (7, 8, 9, 16, 17, 30, 200):
        for letters in (1, 2, 3, 9):
            texts.append("".join(rnd.choice("abcdefghi"[:letters]) + rnd.choice([" ", " ", "\n", "\t "]) for _ in range(size)))
    base = " ".join(f"w{i}" for i in range(100))
    texts += [base + " " + base, base + "\n" + " ".join(f"w{i}" for i in range(50, 57)), base + " w1 w2 w3 w4 w5 w6 w7 w8"]
    assert judged(spark, texts) == [brute(t) for t in texts]


def test_boilerplate_is_cut_and_depleted_documents_go(spark):
    def story(n, size):
        rnd = random.Random(n)
        return " ".join("".join(rnd.choice("abcdefgh") for _ in range(6)) for _ in range(size))

    menu = "Home | About us | 2024 | Contact and many other links that all pages of the site share 1"
    rows = [(n, f"{story(n, 60)}\n{menu}{n}\n", "a", "", 0, 0) for n in range(30)]
    rows += [(100 + n, f"{menu.upper()}7\n{menu}\n{menu}\n{story(500 + n, 5)}", "a", "", 0, 0) for n in range(3)]
    rows += [(200 + n, f"{story(900 + n, 30)}\n{menu}", "b", "", 0, 0) for n in range(5)]  # rare on this host
    rows += [(300 + n, "\n".join(story(7000 + k, 20) for k in range(12)), None, "", 0, 0) for n in range(40)]  # copies count once
    docs = spark.createDataFrame(rows, SCHEMA)
    lines = quality.frequent_lines(quality.line_table(docs)).collect()
    assert [r.host for r in lines] == ["a"]
    got = {r.doc_id: r for r in quality.judge(docs).collect()}
    assert {k for k, r in got.items() if not r.kept} == {100, 101, 102}
    assert got[0].removed_words == len(menu.split()) and got[200].removed_words == 0 and got[300].removed_words == 0
    clean = {r.doc_id: r.text for r in quality.clean(docs).collect()}
    assert set(clean) == {k for k, r in got.items() if r.kept}
    assert clean[0] == story(0, 60) + "\n" and clean[200].endswith(menu)
    assert quality.clean(docs).columns == docs.columns


def own_words(n, size):
    rnd = random.Random(repr(n))
    return " ".join("".join(rnd.choice("abcdefgh") for _ in range(6)) for _ in range(size))


def test_menus_are_cut_whatever_their_length(spark):
    """Every line of a menu on all pages of a host goes, however little else the pages have; bare pages are depleted."""
    rows, want, bare = [], set(), set()
    for size, own in ((10, 10), (30, 30), (100, 100), (30, 6), (10, 6), (30, 40), (100, 1)):
        host = f"h{size}x{own}"
        menu = [f"{x} {host}" for x in own_words((host, "menu"), size).split()]
        for i in range(60):
            if own < 0.25 * (own + 2 * size):
                bare.add(len(rows))
            rows.append((len(rows), "\n".join([*menu, own_words((host, i), own)]), host, "", 0, 0))
        want |= {(host, len(set(menu)))}
    docs = spark.createDataFrame(rows, SCHEMA)
    lines = quality.frequent_lines(quality.line_table(docs)).groupBy("host").count().collect()
    assert {(r.host, r["count"]) for r in lines} == want
    cleaned = quality.clean(docs).collect()
    assert {r.doc_id for r in cleaned} == {i for i in range(len(rows)) if i not in bare and len(rows[i][1].split()) >= 20}
    assert all("\n" not in r.text for r in cleaned)
    copies = spark.createDataFrame([(i, rows[0][1], "c", "", 0, 0) for i in range(60)], SCHEMA)
    assert quality.frequent_lines(quality.line_table(copies)).count() == 0


def test_the_limit_is_the_same_on_a_large_host(spark):
    line = "the same short notice under a few of very many pages"
    rows = [(n, own_words(n, 30) + (f"\n{line}" if n < 21 else ""), "big", "", 0, 0) for n in range(5000)]
    rows += [(9000 + n, own_words(-n, 30) + (f"\n{line}" if n < 20 else ""), "small", "", 0, 0) for n in range(20)]
    got = quality.judge(spark.createDataFrame(rows, SCHEMA)).where("removed_words > 0").collect()
    assert {r.doc_id for r in got} == set(range(21))


def test_long_texts_with_many_boilerplate_lines(spark):
    shared = [f"menu {own_words(('shared', n), 3)}" for n in range(8000)]
    rows = []
    for n in range(24):
        mixed = [x for k, line in enumerate(shared) for x in ((line, own_words((n, k), 1)) if k % 2 else (line,))]
        rows.append((n, "\n".join(["", *mixed, ""]), "s", "", 0, 0))
    docs = spark.createDataFrame(rows, SCHEMA).repartition(8)
    got = {r.doc_id: r.text for r in quality.clean(docs, min_left=0.0).collect()}
    assert got == {n: "\n".join(["", *[own_words((n, k), 1) for k in range(1, 8000, 2)], ""]) for n in range(24)}


def test_odd_rows(spark):
    docs = spark.createDataFrame([(None, None, None, None, None, None), (1, "", "s", "", 1, 1), (2, "w " * 30, "s", "", 1, 1), (2, "w " * 30, "s", "", 1, 1)], SCHEMA)
    got = quality.judge(docs).collect()
    assert len(got) == 4 and not any(r.kept for r in got)
    assert quality.judge(docs.limit(0)).count() == 0 and quality.clean(docs.limit(0)).count() == 0
    good = " ".join(f"w{i}" for i in range(30))
    twice = spark.createDataFrame([(None, good, None, None, None, None)] * 2, SCHEMA)
    assert [r.kept for r in quality.judge(twice).collect()] == [True, True]
    assert quality.clean(twice).count() == 2


@settings(max_examples=20, deadline=None)
@given(st.lists(st.text(alphabet=" \t\n\x0b\x0c\rab\x85　|", max_size=30), min_size=1, max_size=30))
def test_word_counts(spark, texts):
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    got = rows.select(word_count(F.col("t")), F.size(words(F.col("t")))).collect()
    assert [tuple(r) for r in got] == [(len(re.findall(r"[^\x20\x09-\x0D]+", t)),) * 2 for t in texts]
