"""Token counts: an exact histogram of encoded lengths and what its suffix sums answer."""

from __future__ import annotations

import base64
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace import session

BLOCK = 128  # lengths that share a block of the two-step suffix sums


@lru_cache(maxsize=2)
def _encoding(ranks: str, pattern: str):
    import tiktoken

    table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line.strip())}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})


class _Shared:
    def __init__(self, *values: str):
        self.values = values


def read_ranks(path: str | None = None) -> str:
    """Content of a rank file; without a path, of the installed public `byte_bpe_50k.tiktoken`."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    with open(path, encoding="ascii") as file:
        return file.read()


def encoded_length(text: Column, ranks: str | None = None, pattern: str | None = None) -> Column:
    """Tokens of every whole text; 0 for NULL. Special tokens' names are ordinary text."""
    if pattern is None:
        import public_tokenizers

        pattern = public_tokenizers.PATTERN
    shared = _Shared(ranks or read_ranks(), pattern)

    @F.pandas_udf("long")
    def lengths(texts: pd.Series) -> pd.Series:
        encode = _encoding(*shared.values).encode_ordinary
        return pd.Series([len(encode(t)) if t else 0 for t in texts], dtype="int64")

    return lengths(text)


def length_histogram(docs: DataFrame, length: Column) -> DataFrame:
    """(length, docs): how many rows have each length; combined before the shuffle."""
    return docs.select(length.alias("length")).groupBy("length").agg(F.count("*").alias("docs"))


def suffix_sums(histogram: DataFrame) -> DataFrame:
    """`histogram` (length, docs) with docs_at_least, tokens_at_least and truncated_tokens for each length.

    docs_at_least and tokens_at_least count the documents of that length or more. truncated_tokens
    is the total if every document is cut at that length: the shorter ones whole, the others cut.
    The sums run over blocks of BLOCK lengths, then over the blocks' totals, so that no task has to
    hold more than the lengths of one block or one row for each block.
    """
    rows = histogram.withColumn("block", F.floor(F.col("length") / BLOCK)).withColumn(
        "tokens", F.col("docs") * F.col("length")
    )
    within = Window.partitionBy("block").orderBy(F.col("length").desc())
    above = Window.orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.groupBy("block").agg(F.sum("docs").alias("d"), F.sum("tokens").alias("t"))
    everything = Window.partitionBy()
    blocks = blocks.select(
        F.col("block").alias("at"),
        F.coalesce(F.sum("d").over(above), F.lit(0)).alias("docs_above"),
        F.coalesce(F.sum("t").over(above), F.lit(0)).alias("tokens_above"),
        F.sum("t").over(everything).alias("all_tokens"),
        F.sum("d").over(everything).alias("all_docs"),
    )
    summed = rows.join(blocks, F.col("block") == F.col("at")).select(
        "length",
        "docs",
        (F.sum("docs").over(within) + F.col("docs_above")).alias("docs_at_least"),
        (F.sum("tokens").over(within) + F.col("tokens_above")).alias("tokens_at_least"),
        "all_tokens",
        "all_docs",
    )
    cut = F.col("all_tokens") - F.col("tokens_at_least") + F.col("length") * F.col("docs_at_least")
    return summed.select("length", "docs", "docs_at_least", "tokens_at_least", cut.alias("truncated_tokens"), "all_docs", "all_tokens")


def at_limits(sums: DataFrame, limits: list[int]) -> DataFrame:
    """For each context limit (limit, docs_over, truncated_tokens, lost_tokens), limits between lengths included."""
    over = [F.col("length") > F.lit(limit) for limit in limits]
    first = sums.agg(
        F.max("all_tokens").alias("all_tokens"),
        *[F.max(F.when(o, F.col("docs_at_least"))).alias(f"d{i}") for i, o in enumerate(over)],
        *[F.max(F.when(o, F.col("tokens_at_least"))).alias(f"t{i}") for i, o in enumerate(over)],
    )
    rows = F.array(*[
        F.struct(
            F.lit(limit).cast("long").alias("limit"),
            F.coalesce(F.col(f"d{i}"), F.lit(0)).alias("docs_over"),
            (
                F.coalesce("all_tokens", F.lit(0)) - F.coalesce(F.col(f"t{i}"), F.lit(0))
                + F.lit(limit) * F.coalesce(F.col(f"d{i}"), F.lit(0))
            ).alias("truncated_tokens"),
            (F.coalesce(F.col(f"t{i}"), F.lit(0)) - F.lit(limit) * F.coalesce(F.col(f"d{i}"), F.lit(0))).alias("lost_tokens"),
        )
        for i, limit in enumerate(limits)
    ])
    return first.select(F.inline(rows))


def quantiles(sums: DataFrame, shares: list[float]) -> DataFrame:
    """(share, length): the least length that at least that share of the documents does not exceed."""
    within = F.col("all_docs") - F.col("docs_at_least") + F.col("docs")
    found = sums.agg(*[F.min(F.when(within >= F.col("all_docs") * s, F.col("length"))).alias(f"q{i}") for i, s in enumerate(shares)])
    return found.select(F.inline(F.array(*[
        F.struct(F.lit(float(s)).alias("share"), F.col(f"q{i}").alias("length")) for i, s in enumerate(shares)
    ])))


def token_counts(docs: DataFrame, text: str = "text", ranks: str | None = None) -> DataFrame:
    """The histogram of encoded lengths with its suffix sums.

    NULL and empty texts have length 0; texts of any length are encoded whole; repeated rows count;
    other columns are not read; an empty table gives an empty result.
    """
    histogram = length_histogram(docs, encoded_length(F.col(text), ranks))
    return suffix_sums(session.settle(histogram, "lengths"))  # the sums read it twice
