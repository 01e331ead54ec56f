"""Turning nested arrays into rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import text


def flatten_outer(rows: DataFrame, array: Column, name: str, position: str | None = None) -> DataFrame:
    """One row per element; a row without elements is kept with a NULL element."""
    if position is None:
        return rows.withColumn(name, F.explode_outer(array))
    return rows.select("*", F.posexplode_outer(array).alias(position, name))


def flatten_parsed(rows: DataFrame, array: str) -> DataFrame:
    """One row per element of the array column, in its place; rows without elements drop.

    For arrays that are costly to compute: whether there are elements is seen on what the array gave,
    while a plain explode tests the array ahead of it, where it would be computed (and its document
    parsed) a second time.
    """
    others = [c for c in rows.columns if c != array]
    return rows.select(*others, F.posexplode_outer(array).alias("_at", array)).where(F.col("_at").isNotNull()).drop("_at")


def flatten_first(rows: DataFrame, array: Column, name: str, last_index: int) -> DataFrame:
    """Elements up to `last_index`; rows without elements drop.

    The slice is taken before the explode, so longer arrays are never unfolded.
    """
    return rows.withColumn(name, F.explode(F.slice(array, 1, last_index + 1)))


def flatten_matching(rows: DataFrame, array: Column, name: str, match) -> DataFrame:
    """Elements that match; rows without a match drop. Filtered before the explode."""
    return rows.withColumn(name, F.explode(F.filter(array, match)))


def flatten_chain(rows: DataFrame, steps: dict[str, Column]) -> DataFrame:
    """Nested levels, each step reading what the previous one produced."""
    for name, array in steps.items():
        rows = flatten_outer(rows, array, name)
    return rows


def flatten_set(rows: DataFrame, values: Column, name: str) -> DataFrame:
    """One row per distinct non-NULL value; none at all gives one row holding `''`.

    Equals joining the sorted set to a text and splitting it again, without the
    round trip.
    """
    kept = F.sort_array(F.array_distinct(F.array_compact(values)))
    return rows.withColumn(
        name, F.explode(F.when(F.size(kept) > 0, kept).otherwise(F.array(F.lit(""))))
    )


def flatten_tokens(rows: DataFrame, col: Column, delimiters: str, name: str) -> DataFrame:
    """One row per non-empty token."""
    return rows.withColumn(name, F.explode(text.tokens(col, delimiters)))
