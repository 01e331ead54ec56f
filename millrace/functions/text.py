"""Text expressions used across the pipelines."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def segment(col: Column, position: int, separator: str = "/") -> Column:
    """The n-th piece of a delimited text; negative positions count from the end.

    A position beyond the last piece gives `''`, NULL stays NULL.
    """
    return F.split_part(col, F.lit(separator), F.lit(position))


def tail(col: Column, separator: str = "/") -> Column:
    """Last piece of a delimited text, e.g. the record id of a reference."""
    return segment(col, -1, separator)


def pieces(col: Column, separator: str, names: Sequence[str], width: int | None = None) -> list[Column]:
    """The first `len(names)` pieces as separate columns, cut to `width`."""
    out = []
    for position, name in enumerate(names, start=1):
        piece = segment(col, position, separator)
        if width is not None:
            piece = F.substring(piece, 1, width)
        out.append(piece.alias(name))
    return out


def tokens(col: Column, delimiters: str) -> Column:
    """Split on any of the delimiter *characters*; empty tokens vanish."""
    one_of = "[" + re.escape(delimiters) + "]"
    return F.filter(F.split(col, one_of), lambda token: token != "")


def literal_split(col: Column, separator: str) -> Column:
    """Split on a literal separator (Spark's `split` takes a pattern)."""
    return F.split(col, re.escape(separator))


def joined_set(values: Column, separator: str) -> Column:
    """Distinct non-NULL elements, sorted, joined; nothing gives `''`."""
    return F.array_join(F.sort_array(F.array_distinct(F.array_compact(values))), separator)


def squeeze(col: Column) -> Column:
    """Runs of blanks become one blank."""
    return F.regexp_replace(col, " +", " ")


def strip_blanks(col: Column) -> Column:
    """Removes every blank."""
    return F.replace(col, F.lit(" "), F.lit(""))


def filled(col: Column) -> Column:
    """True for a value that is neither NULL nor blank."""
    return F.length(F.trim(col)) > 0


def flag(condition: Column, yes: str, no: str | None = None) -> Column:
    """`yes` where the condition holds, else `no` (also for an unknown condition)."""
    return F.when(condition, F.lit(yes)).otherwise(F.lit(no))


def active_flag(day: Column, first: Column, last: Column) -> Column:
    """'A' while `day` lies in the period, else 'T'; an open bound counts as 'T'."""
    return flag(day.between(first, last), "A", "T")


def bool_flag(col: Column) -> Column:
    """Text 'true' / 'false' as 'Y' / 'N'; anything else is NULL."""
    return F.when(col == "false", F.lit("N")).when(col == "true", F.lit("Y"))
