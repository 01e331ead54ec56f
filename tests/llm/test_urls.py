"""URL parts, prefix rules and mined rules against brute force."""

from __future__ import annotations

from itertools import combinations

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.llm import queries, urls

RULES = [urls.PrefixRule.parse(x) for x in ("allow org/", "allow com/fr/", "block com/de/", "block example.org/es/", "block example.org/en/1")]


def slow_parts(url):
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    cut = min((i for i, c in enumerate(rest) if c in "/?#"), default=len(rest))
    tail = rest[cut:]
    end = min((i for i, c in enumerate(tail) if c in "?#"), default=len(tail))
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut]), tail[:end]


def slow_rule(host, path):
    fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: (len(r.text), r.text), default=None)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aE.:/?#=&1\n", max_size=14)), min_size=20, max_size=60))
def test_parts(spark, some):
    frame = spark.createDataFrame([(u,) for u in some], "u string")
    got = [tuple(r) for r in frame.select(urls.host_of(F.col("u")), urls.path_of(F.col("u"))).collect()]
    assert got == [slow_parts(u) for u in some]


def test_prefix_rules(spark):
    some = [
        "http://example.org/es/1", "http://a.example.org/en/12", "http://a.example.org/en/21", "http://xexample.org/es/", "http://ORG/",
        "http://org", "https://x.com/fr/2", "https://x.com/FR/2", "https://x.com/de", "https://x.com/de/", "ftp://net/a", None, "x", "://", "a://b.org?c",
    ]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(some)], "page_id long, url string, host string")
    for r in urls.judge(pages, RULES).collect():
        want = slow_rule(*slow_parts(some[r.page_id]))
        assert (r.host, r.path) == slow_parts(some[r.page_id])
        assert r.rule == (want.text if want else None)
        assert r.verdict == want.verdict if want else r.verdict in ("allow", "block")


def test_mined_rules(spark):
    rows = []
    for i in range(400):
        kind = ["en", "fr", "spam"][i % 3]
        rows.append((f"http://h{i % 5}.x/{kind}/{i}", "block" if kind == "spam" or (kind == "fr" and i % 5 == 0) else "allow"))
    frame = spark.createDataFrame(rows, "url string, verdict string")
    frame = frame.select("*", urls.url_tokens(urls.host_of(F.col("url")), urls.path_of(F.col("url")), F.col("url")).alias("tokens"))
    found = urls.mine(frame, 0.02, 0.9)
    baskets = [(frozenset(r.tokens), r.verdict) for r in frame.collect()]
    want = {}
    for size in (1, 2, 3, 4):
        for tokens, _ in set(baskets):
            for part in map(frozenset, combinations(sorted(tokens), size)):
                for verdict in ("allow", "block"):
                    both = sum(part <= t and v == verdict for t, v in baskets)
                    if both >= 0.02 * len(baskets) and both >= 0.9 * sum(part <= t for t, _ in baskets):
                        want[part, verdict] = both / sum(part <= t for t, _ in baskets)
    common = {t for t in baskets[0][0] if all(t in held for held, _ in baskets)}
    least = {
        k: v for k, v in want.items()
        if not k[0] & common and not any(o[0] < k[0] and o[1] == k[1] and want[o] >= v for o in want if o[0])
    }
    got = {(frozenset(t), v): c for t, v, c, _ in found.expanded()}
    assert got == least
    judged = frame.select("url", "tokens", urls.mined_verdict(F.col("tokens"), found).alias("m")).collect()
    for r in judged:
        hits = [(want[k], v) for k in least for v in [k[1]] if k[0] <= set(r.tokens)]
        assert r.m.verdict == (max(hits)[1] if hits else found.default) or len({v for _, v in hits}) > 1


def test_many_common_tokens_leave_the_other_rules(spark):
    rows = [("allow", [f"key:{k}" for k in range(14)])] * 20  # 16,383 combinations that are as sure as their tokens
    rows += [("block" if i % 20 else "allow", ["path0:spam", f"host0:{i % 7}"]) for i in range(400)]
    rows += [("allow", ["path0:en", f"host0:{i % 7}"]) for i in range(580)]
    frame = spark.createDataFrame([(f"http://u/{i}", t, v) for i, (v, t) in enumerate(rows)], "url string, tokens array<string>, verdict string")
    found = {(t, v): c for t, v, c, _ in urls.mine(frame).expanded()}
    assert found[("path0:spam",), "block"] == 0.95
    assert {t for t, v in found if any(x.startswith("key:") for x in t)} == {(f"key:{k}",) for k in range(14)}
    copies = frame.unionByName(frame.where("verdict = 'block'").selectExpr("url", "tokens", "verdict", "explode(sequence(1, 50))").drop("col"))
    assert {(t, v): c for t, v, c, _ in urls.mine(copies).expanded()} == found


def test_tokens_that_occur_together_are_mined_as_one(spark):
    """25 shared keys cost no more than one, and any of them satisfies a rule; pairs with another token stay."""
    keys = [f"key:{k}" for k in range(25)]
    rows = [("block" if i % 2 else "allow", [*keys, "path0:en" if i % 2 else "path0:fr"]) for i in range(200)]
    rows += [("allow", ["path0:en", f"path1:{i}"]) for i in range(200)] + [("block", ["path0:fr", f"path1:{i}"]) for i in range(200)]
    frame = spark.createDataFrame([(f"http://u/{i}", t, v) for i, (v, t) in enumerate(rows)], "url string, tokens array<string>, verdict string")
    found = urls.mine(frame)
    expanded = {(t, v) for t, v, *_ in found.expanded()}
    assert {((k, "path0:en"), "block") for k in keys} | {((k, "path0:fr"), "allow") for k in keys} <= expanded
    assert len(found.rules) < 10
    some = spark.createDataFrame([(["key:7", "path0:en"],), (["key:7", "key:9", "path0:fr"],), (["path0:en"],)], "tokens array<string>")
    got = [tuple(r.m) for r in some.select(urls.mined_verdict(F.col("tokens"), found).alias("m")).collect()]
    assert got[0] == ("block", "key:7 path0:en") and got[1] == ("allow", "key:9 path0:fr")


def test_odd_rows(spark):
    schema = "page_id long, url string, verdict string, tokens string"
    pages = spark.createDataFrame([(None, None, None, ""), (1, "", "", ""), (1, "http://a.org/" + "x/" * 50_000, "", ""), (1, "http://q.net/", "", "")], schema)
    got = sorted((r.page_id is None, r.rule, r.verdict) for r in urls.judge(pages, RULES).collect() if r.rule) 
    assert got == [(False, "org/", "allow")]
    assert urls.judge(pages, RULES).count() == 4 and urls.judge(pages.limit(0), RULES).count() == 0
    kept = urls.allowed(pages, RULES)
    assert kept.columns == pages.columns and kept.count() == 4
    assert urls.judge(pages, []).where("verdict <> 'allow'").count() == 0


def test_pages(spark):
    folder = "/root/testdata/sf0.01"
    rows = {r.page_id: r for r in queries.QUERIES["op4_urls"](spark, folder).collect()}
    pages = spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url").collect()
    assert len(rows) == len(pages)
    for page in pages:
        r, want = rows[page.page_id], slow_rule(*slow_parts(page.url))
        assert (r.host, r.path, r.rule) == (*slow_parts(page.url), want.text if want else None)
        if want:
            assert r.verdict == want.verdict
    assert {r.verdict for r in rows.values() if r.rule is None} == {"allow", "block"}
    assert any(r.matched for r in rows.values())
