"""Words and row identities shared by the operators of this package."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space that parts words: space, tab, line feed, vertical tab, form feed, carriage return.
# Python's bytes.split() without an argument splits on the same six.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """The words of a text; none for NULL."""
    inner = F.btrim(text, F.lit(BLANKS))
    return F.when(F.length(inner) > 0, F.split(inner, BLANK_RUN)).otherwise(F.array().cast("array<string>"))


def word_count(text: Column) -> Column:
    """How many words a text has, without building them: a word ends before a blank or the end."""
    squeezed = F.regexp_replace(F.coalesce(text, F.lit("")), BLANK_RUN, " ")
    return F.when(squeezed.isin("", " "), 0).otherwise(
        F.length(F.trim(squeezed)) - F.length(F.translate(squeezed, " ", "")) + 1
    ).cast("long")


def bind(value: Column, use) -> Column:
    """`use(value)` with `value` computed once, however often `use` mentions it."""
    return F.transform(F.array(value), use)[0]


def id_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo `modulus`; a NULL id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def free_name(taken, wish: str) -> str:
    """`wish`, or the first of wish_1, wish_2 … that no column has (case does not tell names apart)."""
    low = {t.lower() for t in taken}
    name, n = wish, 0
    while name.lower() in low:
        n += 1
        name = f"{wish}_{n}"
    return name
