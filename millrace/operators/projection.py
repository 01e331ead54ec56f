"""Layouts, renames and optional filters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def padded_layout(frame: DataFrame, layout: Sequence[str], fills: Mapping[str, str | None]) -> DataFrame:
    """All columns of `layout`, in order; the ones the frame lacks come from `fills`."""
    have = set(frame.columns)
    return frame.select(
        *[
            F.col(name) if name in have else F.lit(fills.get(name)).cast("string").alias(name)
            for name in layout
        ]
    )


def dictionary_aliases(columns: Sequence[str], dictionary: Mapping[str, str]) -> list[tuple[str, str]]:
    """(column, new name) in the given order; columns without an entry keep their name."""
    return [(c, dictionary.get(c) or c) for c in columns]


def renamed_extract(frame: DataFrame, dictionary: Mapping[str, str]) -> DataFrame:
    """Every column under its dictionary name, in ordinal order: one projection."""
    return frame.select(
        *[F.col(f"`{old}`").alias(new) for old, new in dictionary_aliases(frame.columns, dictionary)]
    )


def search_filter(
    rows: DataFrame,
    contains: Mapping[str, str | None] | None = None,
    members: Mapping[str, Sequence[str] | None] | None = None,
) -> DataFrame:
    """Case-insensitive containment and membership; empty criteria are skipped."""
    for name, needle in (contains or {}).items():
        if needle:
            rows = rows.where(F.lower(F.col(name)).contains(needle.lower()))
    for name, allowed in (members or {}).items():
        if allowed:
            rows = rows.where(F.col(name).isin(list(allowed)))
    return rows


def conditional_update(frame: DataFrame, column: str, value: Column, where: Column) -> DataFrame:
    """`column` set to `value` on the rows where the condition is true."""
    changed = F.when(where, value).otherwise(F.col(column))
    return frame.withColumn(column, changed.cast(frame.schema[column].dataType))
