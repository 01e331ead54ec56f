"""Quality rules: text statistics and cross-document line frequency, all in SQL functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace import session
from millrace.llm.text import BLANK_RUN, BLANKS, bind, free_name, word_count, words

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 20  # shorter documents fail
MAX_REPEAT_PERCENT = 30  # of words in repeated windows; above, the document fails
WINDOW = 8  # words in a repeated window

#: A line is boilerplate on its host if more than so many distinct texts there have it, however large the host is.
LINE_DOCS = 20
#: A document is depleted if fewer than this share of its words is left.
MIN_LEFT = 0.25


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _has_word(line: Column) -> Column:
    return F.length(F.translate(line, BLANKS, "")) > 0


def line_key(line: Column) -> Column:
    """60 bits of the MD5 of a line, without regard to case, digits and spacing."""
    plain = F.trim(F.regexp_replace(F.lower(line), BLANK_RUN, " "))
    return F.conv(F.substring(F.md5(F.regexp_replace(plain, "[0-9]+", "0").cast("binary")), 1, 15), 16, 10).cast("long")


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    return bind(F.filter(_lines(text), _has_word), lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def repeated_words(found: Column, window: int = WINDOW) -> Column:
    """Words inside any run of `window` words that the text has twice or more, the first included."""

    def covered(hashes: Column) -> Column:
        placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def starts(rows: Column) -> Column:
            twin = F.filter(
                rows,
                lambda x, n: (F.get(rows, n - 1)["h"] == x["h"]) | F.coalesce(F.get(rows, n + 1)["h"] == x["h"], F.lit(False)),
            )
            return F.sort_array(F.transform(twin, lambda x: x["i"]))

        return F.aggregate(
            bind(placed, starts),
            F.struct(F.lit(-window).alias("last"), F.lit(0).alias("total")),
            lambda a, i: F.struct(i.alias("last"), (a["total"] + F.least(F.lit(window), i - a["last"])).alias("total")),
            lambda a: a["total"],
        )

    def windows(ids: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(1), F.size(ids) - window + 1), lambda i: F.xxhash64(F.slice(ids, i, window))
        )

    def count(hashes: Column) -> Column:
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(covered(hashes))

    ids = F.transform(found, lambda w: F.xxhash64(w))
    return F.when(F.size(found) <= window, 0).otherwise(bind(bind(ids, windows), count)).cast("long")


def line_table(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", host: str = "source") -> DataFrame:
    """One row for each line with a word: (removed_id, removed_digest, host, place, line, words).

    place counts the lines of the text from 0. Written once, as counting and cutting both read it.
    """
    numbered = F.filter(
        F.transform(
            _lines(F.col(text)),
            lambda line, i: F.struct(i.alias("place"), line_key(line).alias("line"), word_count(line).alias("words")),
        ),
        lambda x: x["words"] > 0,
    )
    held = docs.select(
        F.col(doc_id).alias("removed_id"),
        F.xxhash64(F.col(text)).alias("removed_digest"),
        F.col(host).alias("host"),
        numbered.alias("found"),
    )
    # outer, as the optimizer would compute the lines twice to keep empty arrays from an inner one
    rows = held.select("removed_id", "removed_digest", "host", F.inline_outer("found"))
    return session.settle(rows.where("line is not null"), "lines")


def frequent_lines(lines: DataFrame, line_docs: int = LINE_DOCS) -> DataFrame:
    """Boilerplate lines (host, line): those that more than `line_docs` distinct documents of their host have.

    Documents are told apart by their whole text, so exact copies count once. A NULL host is a host
    of its own. Both counts are combined before their shuffle.
    """
    once = lines.groupBy("host", "line", "removed_digest").agg(F.lit(1).alias("one"))
    counted = once.groupBy("host", "line").agg(F.count("*").alias("docs"))
    return counted.where(F.col("docs") > line_docs).select("host", "line")


def _removed(docs: DataFrame, text: str, doc_id: str, host: str, line_docs: int) -> DataFrame:
    """(removed_id, removed_digest, cut): for documents with boilerplate the (place, words) of each such line.

    A set, so that rows that repeat a document do not count its lines twice; in order of place.
    """
    lines = line_table(docs, text, doc_id, host)
    # written, so that the join stands between two exchanges and a hot line is split
    often = session.settle(frequent_lines(lines, line_docs).toDF("at", "often"), "frequent-lines")
    return (
        lines.join(often, F.col("host").eqNullSafe(F.col("at")) & (F.col("line") == F.col("often")))
        .groupBy("removed_id", "removed_digest")
        .agg(F.sort_array(F.collect_set(F.struct("place", "words"))).alias("cut"))
    )


def _without(lines: Column, gone: Column) -> Column:
    """The lines whose places (ascending) are not in `gone`: the stretches between them, each copied once."""

    def stretch(place: Column, n: Column) -> Column:
        start = F.coalesce(F.get(gone, n - 1), F.lit(-1)) + 1
        return F.slice(lines, start + 1, place - start)

    ends = F.concat(gone, F.array(F.size(lines)))
    return F.flatten(F.transform(ends, stretch))


def judge(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    host: str = "source",
    line_docs: int = LINE_DOCS,
    min_left: float = MIN_LEFT,
) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, removed_words, base_failed, kept) per row.

    base_failed: under MIN_WORDS words, or over MAX_REPEAT_PERCENT of them inside repeated windows.
    kept: not base_failed, and at least `min_left` of the words stand outside boilerplate lines
    (`frequent_lines`). NULL and blank texts have no words and fail. Texts of any length are read
    whole. Repeated rows are judged alike and come back repeated; an empty table gives an empty
    result; other columns are not read.
    """
    key, digest = F.col(doc_id), F.xxhash64(F.col(text))
    rows = _statistics(docs.select(key.alias("doc_id"), F.col(text).alias("text"), digest.alias("digest")))
    cut = _removed(docs, text, doc_id, host, line_docs).select(
        "removed_id", "removed_digest", F.aggregate("cut", F.lit(0).cast("long"), lambda a, x: a + x["words"]).alias("cut")
    )
    joined = rows.join(
        cut, F.col("doc_id").eqNullSafe(F.col("removed_id")) & (F.col("digest") == F.col("removed_digest")), "left"
    ).withColumn("removed_words", F.coalesce("cut", F.lit(0)))
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
    left = F.col("n_words") - F.col("removed_words")
    return joined.withColumn("base_failed", failed).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "removed_words", "base_failed",
        (~F.col("base_failed") & (left >= F.col("n_words") * min_left)).alias("kept"),
    )


def _statistics(rows: DataFrame) -> DataFrame:
    """`rows` (doc_id, text, digest) with the statistics instead of the text."""
    held = F.coalesce("text", F.lit(""))
    pair = bind(words(F.col("text")), lambda w: F.struct(F.size(w).cast("long").alias("n"), repeated_words(w).alias("r")))
    return rows.select(
        "doc_id",
        "digest",
        pair.alias("pair"),
        F.length(F.translate(held, BLANKS, "")).cast("long").alias("word_chars"),
        (F.length(held) - F.length(F.translate(held, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        duplicate_lines(F.col("text")).alias("n_dup_lines"),
    ).select("*", F.col("pair.n").alias("n_words"), F.col("pair.r").alias("n_repeat_words")).drop("pair")


def clean(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    host: str = "source",
    line_docs: int = LINE_DOCS,
    min_left: float = MIN_LEFT,
) -> DataFrame:
    """The documents that `judge` keeps, their boilerplate lines taken out of the text; same columns.

    Work grows with a text's length, not with its lines times those taken out. For NULL, empty and
    very long texts, repeated rows and empty tables see `judge`; columns with any other names stay.
    """
    names = {x: free_name(docs.columns, x) for x in ("digest", "cut", "pair", "removed_id", "removed_digest")}
    cut = _removed(docs, text, doc_id, host, line_docs).withColumnsRenamed(names)
    body, gone = F.col(text), F.col(names["cut"])
    pair = F.col(names["pair"])
    held = bind(F.struct(_lines(body).alias("lines"), F.transform(gone, lambda x: x["place"]).alias("gone")),
                lambda x: F.array_join(_without(x["lines"], x["gone"]), "\n"))
    lost = F.coalesce(F.aggregate(gone, F.lit(0).cast("long"), lambda a, x: a + x["words"]), F.lit(0))
    return (
        docs.withColumn(names["digest"], F.xxhash64(body))
        .withColumn(
            names["pair"],
            bind(words(body), lambda w: F.struct(F.size(w).cast("long").alias("n"), repeated_words(w).alias("r"))),
        )
        .where((pair["n"] >= MIN_WORDS) & (pair["r"] * 100 <= pair["n"] * MAX_REPEAT_PERCENT))
        .join(
            cut,
            F.col(doc_id).eqNullSafe(F.col(names["removed_id"]))
            & (F.col(names["digest"]) == F.col(names["removed_digest"])),
            "left",
        )
        .where(pair["n"] - lost >= pair["n"] * min_left)
        .select(*[
            F.when(gone.isNull(), body).otherwise(held).alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns
        ])
    )
