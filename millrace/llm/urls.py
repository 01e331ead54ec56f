"""URL filters: prefix rules, and association rules mined from the urls that those label.

FP-growth finds token combinations of labelled urls; rules `combination -> verdict` are pruned by
support and confidence, and by simpler rules that are at least as sure. A url is matched through an
inverted index from each rule's rarest token to the rules.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import product

import pandas as pd
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace import session
from millrace.llm.text import free_name

ALLOW, BLOCK = "allow", "block"
SUPPORT = 0.01  # least share of the labelled urls that hold a combination and its label
CONFIDENCE = 0.9  # least share of a combination's urls that have the label
LEARN_URLS = 500_000  # distinct labelled urls that are mined, about; picked by a hash of the url
LABEL = "label="


@dataclass(frozen=True)
class PrefixRule:
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path

    @classmethod
    def parse(cls, line: str) -> PrefixRule:
        """`allow org/` or `block example.org/es/`."""
        verdict, _, place = line.strip().partition(" ")
        host, slash, path = place.partition("/")
        if verdict not in (ALLOW, BLOCK) or not host:
            raise ValueError(f"not a rule: {line}")
        return cls(host.lower(), slash + path, verdict)


def host_of(url: Column) -> Column:
    """Host after the first `://` up to `/`, `?`, `#` or the end, A-Z lowered; empty without `://` or for NULL."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """Path after the host up to `?`, `#` or the end; empty without `://` or for NULL."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def prefix_rule(host: Column, path: Column, rules: list[PrefixRule]) -> Column:
    """The longest fitting rule as struct (size, rule, verdict), NULL if none fits.

    A rule fits its host and all subdomains if the path starts with the rule's. Among rules of one
    length the greater text wins.
    """
    fits = [
        F.when(
            ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path),
            F.struct(F.lit(len(r.text)).alias("size"), F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict")),
        )
        for r in rules
    ]
    return F.array_max(F.array_compact(F.array(*fits))) if fits else F.lit(None).cast(
        "struct<size:int,rule:string,verdict:string>"
    )


def url_tokens(host: Column, path: Column, url: Column) -> Column:
    """Distinct tokens: the host's names by place, each path step with digits folded, keys of the query."""
    names = F.filter(F.split(host, r"\."), lambda x: x != "")
    placed = F.transform(
        F.reverse(names), lambda x, i: F.concat(F.lit("host"), F.least(i, F.lit(3)).cast("string"), F.lit(":"), x)
    )
    steps = F.transform(
        F.filter(F.split(F.lower(path), "/"), lambda x: x != ""),
        lambda x, i: F.concat(F.lit("path"), F.least(i, F.lit(3)).cast("string"), F.lit(":"), F.regexp_replace(x, "[0-9]+", "0")),
    )
    asked = F.regexp_extract(F.coalesce(url, F.lit("")), r"\?([^#]*)", 1)
    keys = F.transform(
        F.filter(F.split(asked, "&"), lambda x: x != ""), lambda x: F.concat(F.lit("key:"), F.substring_index(x, "=", 1))
    )
    return F.array_distinct(F.concat(placed, steps, keys))


@dataclass
class Rules:
    """Mined rules (tokens, verdict, confidence, support) and the verdict where none matches.

    `same` maps tokens to the one that stands for them in the rules: in all labelled urls they occur
    together, so a rule holds with any of them in its place.
    """

    rules: list[tuple[tuple[str, ...], str, float, float]]
    default: str
    same: dict[str, str] = field(default_factory=dict)

    def expanded(self) -> list[tuple[tuple[str, ...], str, float, float]]:
        """The rules with every token that may stand in them."""
        members: dict[str, list[str]] = {}
        for token, name in self.same.items():
            members.setdefault(name, [name]).append(token)
        return [
            (tuple(sorted(tokens)), *rest) for names, *rest in self.rules for tokens in product(*[members.get(n, [n]) for n in names])
        ]

    def index(self) -> dict[str, list[tuple[frozenset, tuple]]]:
        """Rules by the token that the fewest rules have; the order to choose by comes with each."""
        spread: dict[str, int] = {}
        for tokens, *_ in self.rules:
            for t in tokens:
                spread[t] = spread.get(t, 0) + 1
        out: dict[str, list[tuple[frozenset, tuple]]] = {}
        for tokens, verdict, confidence, support in self.rules:
            first = min(tokens, key=lambda t: (spread[t], t))
            out.setdefault(first, []).append((frozenset(tokens), (confidence, support, len(tokens), verdict, tokens)))
        return out


def mine(
    labelled: DataFrame, support: float = SUPPORT, confidence: float = CONFIDENCE, learn_urls: int = LEARN_URLS,
) -> Rules:
    """Rules from `labelled` (url, tokens, verdict). NULL verdicts are left out; an empty table allows everything.

    Copies of a url count once. Tokens that occur in exactly the same labelled urls are mined as one
    (`Rules.same`), so work does not double with each of them. Every rule without a shorter one that is as sure is kept; they travel
    with the tasks.
    """
    labelled = labelled.where(F.col("verdict").isin(ALLOW, BLOCK))
    labelled = labelled.withColumn("digest", F.xxhash64("url", F.lit(4)))
    sizes = (
        labelled.groupBy("verdict", "digest").agg(F.count("*").alias("rows"))
        .groupBy("verdict").agg(F.sum("rows").alias("rows"), F.count("*").alias("urls")).collect()
    )
    if not sizes:
        return Rules([], ALLOW)
    default = max(sorted(sizes, key=lambda r: r.verdict), key=lambda r: r.rows).verdict
    share = min(10**6, -(-learn_urls * 10**6 // sum(r.urls for r in sizes)))
    picked = labelled.where(F.pmod("digest", F.lit(10**6)) < share).dropDuplicates(["verdict", "digest"])
    picked = session.settle(picked.select("tokens", "verdict", "digest"), "labelled-urls")
    # a token that every url has tells nothing and would double every combination
    counts = (
        picked.select(F.explode("tokens").alias("token"), "digest").groupBy("token")
        .agg(F.count("*").alias("urls"), F.sum(F.xxhash64("digest").cast("decimal(38,0)")).alias("one"), F.bit_xor(F.xxhash64(F.lit(1), "digest")).alias("other"))
    )
    rows = picked.count()
    # at most 1 / support times the tokens of a url
    frequent = counts.where((F.col("urls") >= support * rows) & (F.col("urls") < rows)).collect()
    together: dict[tuple, list[str]] = {}
    for r in frequent:
        together.setdefault((r.urls, r.one, r.other), []).append(r.token)
    names = {t: min(tokens) for tokens in together.values() for t in tokens}
    # tokens that always occur together go as one: their combinations would double with each of them
    label = F.array(F.concat(F.lit(LABEL), "verdict"))
    if names:
        named = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
        held = F.array_compact(F.transform("tokens", lambda t: F.try_element_at(named, t)))
        baskets = picked.select(F.concat(F.array_distinct(held), label).alias("items"))
    else:
        baskets = picked.select(label.alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=confidence).fit(baskets)
    found = (
        model.associationRules.where(F.col("consequent")[0].startswith(LABEL))
        .where(~F.exists("antecedent", lambda t: t.startswith(LABEL)))
        .select(
            F.array_sort("antecedent").alias("tokens"),
            F.expr(f"substring(consequent[0], {len(LABEL) + 1})").alias("verdict"),
            "confidence", "support", F.size("antecedent").alias("size"),
        )
    )
    found = session.settle(found, "url-rules")
    kept: list[tuple[tuple[str, ...], str, float, float]] = []
    for size in sorted(r["size"] for r in found.select("size").distinct().collect()):
        rows = found.where(F.col("size") == size)
        if kept:
            rows = rows.where(~_implied(F.col("tokens"), F.col("verdict"), F.col("confidence"), Rules(kept, default)))
        kept += [(tuple(r.tokens), r.verdict, r.confidence, r.support) for r in rows.collect()]
    used = {t for tokens, *_ in kept for t in tokens}
    return Rules(kept, default, {t: name for t, name in names.items() if name in used and t != name})


def _implied(tokens: Column, verdict: Column, confidence: Column, shorter: Rules) -> Column:
    """Whether a shorter rule with a part of the tokens is as sure of the verdict."""
    index = shorter.index()

    @F.pandas_udf("boolean")
    def implied(held: pd.Series, verdicts: pd.Series, sure: pd.Series) -> pd.Series:
        out = []
        for all_tokens, label, least in zip(held, verdicts, sure):
            whole = frozenset(all_tokens)
            out.append(any(
                rank[3] == label and rank[0] >= least and needed <= whole
                for t in whole for needed, rank in index.get(t, ())
            ))
        return pd.Series(out, dtype=bool)

    return implied(tokens, verdict, confidence)


def mined_verdict(tokens: Column, rules: Rules) -> Column:
    """Struct (verdict, matched): the surest matching rule's verdict and tokens, else the default and NULL."""
    index, default, same = rules.index(), rules.default, rules.same

    @F.pandas_udf("verdict string, matched string")
    def matched(values: pd.Series) -> pd.DataFrame:
        out = []
        for tokens in values:
            held: dict[str, str] = {}  # the token that stands for others: the last of them the url has
            for t in sorted(tokens):
                held[same.get(t, t)] = t
            hits = [rank for t in held for needed, rank in index.get(t, ()) if needed <= held.keys()]
            ranks = [(*rank[:4], tuple(sorted(held[t] for t in rank[4]))) for rank in hits]
            best = max(ranks, default=None)
            out.append((best[3], " ".join(best[4])) if best else (default, None))
        return pd.DataFrame(out, columns=["verdict", "matched"])

    return matched(tokens)


def judge(
    pages: DataFrame, prefix_rules: list[PrefixRule], url: str = "url", page_id: str = "page_id",
    support: float = SUPPORT, confidence: float = CONFIDENCE,
) -> DataFrame:
    """(page_id, host, path, rule, verdict, matched) for each row of `pages`.

    Prefix rules come first, the longest that fits; their verdicts are also the labels that token
    rules are mined from. The other urls get the verdict of the surest mined rule, then of the one
    with more support; without any, the commoner label. NULL urls and urls without `://` have an
    empty host and path, fit no rule and get the default. Urls of any length are judged whole. Repeated rows are judged alike; an empty
    table gives an empty result; other columns are not read.
    """
    parts = pages.select(
        F.col(page_id).alias("page_id"),
        F.col(url).alias("url"),
        host_of(F.col(url)).alias("host"),
        path_of(F.col(url)).alias("path"),
    )
    parts = parts.select(
        "*", prefix_rule(F.col("host"), F.col("path"), prefix_rules).alias("fit"),
        url_tokens(F.col("host"), F.col("path"), F.col("url")).alias("tokens"),
    )
    rules = mine(parts.select("url", "tokens", F.col("fit.verdict").alias("verdict")), support, confidence)
    found = parts.select("*", mined_verdict(F.col("tokens"), rules).alias("mined"))
    return found.select(
        "page_id", "host", "path", F.col("fit.rule").alias("rule"),
        F.coalesce("fit.verdict", "mined.verdict").alias("verdict"),
        F.when(F.col("fit").isNull(), F.col("mined.matched")).alias("matched"),
    )


def allowed(pages: DataFrame, prefix_rules: list[PrefixRule], url: str = "url") -> DataFrame:
    """The rows of `pages` whose url is allowed; same columns. Urls are judged once each."""
    judged = judge(pages.select(F.col(url).alias("url")).distinct().withColumn("page_id", F.col("url")), prefix_rules)
    at, verdict = free_name(pages.columns, "judged_url"), free_name(pages.columns, "verdict")
    kept = judged.select(F.col("page_id").alias(at), F.col("verdict").alias(verdict)).where(F.col(verdict) == ALLOW)
    return pages.join(kept, F.col(url).eqNullSafe(F.col(at)), "left_semi")
