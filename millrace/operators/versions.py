"""Choosing rows by version, key or slice, and replacing keyed rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_versions(
    rows: DataFrame, keys: Sequence[str], clock: str, within: DataFrame | None = None
) -> DataFrame:
    """Rows of `within` carrying the newest clock their key has anywhere in `rows`.

    Ties stay. The newest clock comes from a narrow aggregate that combines on
    the map side, and the wide rows are filtered by a semi join on key *and*
    clock, so a key with very many versions spreads over its clock values
    instead of landing in one window partition. The narrow side is hashed: wide
    rows meet it unsorted, so none of them is spilled.
    """
    newest = rows.groupBy(*keys).agg(F.max(clock).alias(clock))
    return (rows if within is None else within).join(newest.hint("shuffle_hash"), [*keys, clock], "left_semi")


KEY_BITS = 24  # length of the bitmap of repeated keys as a power of two: 2 MB, however many keys there are
LINE = 1024  # its bits in one row while it is made


def _place(keys: Sequence[str]) -> Column:
    """Bit of a key in the bitmap, by its hash."""
    return F.xxhash64(*keys).bitwiseAND((1 << KEY_BITS) - 1)


def repeated_keys(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row with a bitmap, as an array of 64-bit words, that has a bit for every key of more than one of `rows`."""
    seen = rows.groupBy(*keys).agg(F.count("*").alias("_n")).where("_n > 1").select(_place(keys).alias("_place"))
    masks = [F.expr(f"bit_or(if(_place % {LINE} div 64 = {i}, shiftleft(1L, cast(_place % 64 as int)), 0L))") for i in range(LINE // 64)]
    lines = seen.groupBy(F.expr(f"_place div {LINE}").alias("_line")).agg(F.array(*masks).alias("_words"))
    empty = rows.sparkSession.range(0, (1 << KEY_BITS) // LINE, 1, 1).select(
        F.col("id").alias("_line"), F.array_repeat(F.lit(0).cast("bigint"), LINE // 64).alias("_words")
    )
    both = lines.withColumn("_set", F.lit(True)).unionAll(empty.withColumn("_set", F.lit(False)))
    whole = both.groupBy("_line").agg(F.max_by("_words", "_set").alias("_words"))
    return whole.agg(F.sort_array(F.collect_list(F.struct("_line", "_words"))).alias("_all")).select(
        F.flatten(F.col("_all._words")).alias("bitmap")
    )


def has_bit(bitmap: DataFrame, keys: Sequence[str]) -> Column:
    """Whether the bit of a row's key is set. As a filter this reaches the scan, below whatever the rows are made with."""
    place = _place(keys)
    word = F.get(bitmap.scalar(), F.shiftright(place, 6).cast("int"))
    return F.getbit(word, place.bitwiseAND(63).cast("int")) == 1


def latest_marked(
    rows: DataFrame, keys: Sequence[str], clock: str, within: DataFrame | None = None, name: str = "alone"
) -> DataFrame:
    """`latest_versions` with a column `name`: true where no other row of the key carries that clock.

    A key that occurs once has its newest row there: such rows stay where they are. Only rows whose key
    may occur again, by a bitmap of bounded size, are moved to be compared; a bit that two keys share
    costs a comparison and changes nothing.
    """
    repeated = has_bit(repeated_keys(rows, keys), keys)
    within = rows if within is None else within
    single = within.where(~repeated).dropna(subset=[*keys, clock]).withColumn(name, F.lit(True))
    counted = rows.where(repeated).groupBy(*keys, clock).agg(F.count("*").alias("_tied"))
    newest = counted.groupBy(*keys).agg(F.max(clock).alias(clock), (F.max_by("_tied", clock) == 1).alias(name))
    several = within.where(repeated).join(newest.hint("shuffle_hash"), [*keys, clock])
    return several.unionByName(single)


def tie_break(rows: DataFrame, used: Sequence[str]) -> list[Column]:
    """Ascending order on every column not in `used`; makes a ranking repeatable."""
    return [F.col(f"`{c}`").asc_nulls_last() for c in rows.columns if c not in used]


def top_n_per_key(
    rows: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, rank: str = "slot"
) -> DataFrame:
    """First `n` rows per key with their rank.

    Spark trims every map task to `n` rows per key before the shuffle, so a hot
    key sends at most n rows per task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= n)


def newest_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first in `order`, remaining ties broken by all columns."""
    full = [*order, *tie_break(rows, keys)]
    return top_n_per_key(rows, keys, full, 1, "_rank").drop("_rank")


def version_order(version: Column, as_text: bool = False) -> list[Column]:
    """Newest version first: as a number where it is one, then as text.

    `as_text` orders by text only, under which '9' is newer than '10'.
    """
    text = version.desc_nulls_first()
    return [text] if as_text else [version.try_cast("bigint").desc_nulls_first(), text]


def new_slices(source: DataFrame, target: DataFrame, slice_col: str) -> DataFrame:
    """Slices present in `source` and not in `target`; NULL equals NULL here."""
    return source.select(slice_col).distinct().subtract(target.select(slice_col).distinct())


def gate_new_slices(source: DataFrame, target: DataFrame, slice_col: str) -> DataFrame:
    """Rows of the source slices that the target does not hold yet."""
    return source.join(new_slices(source, target, slice_col), slice_col, "left_semi")


def without_keys(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose trimmed key does not occur in the batch (NULL keys stay)."""
    gone = batch.select(*[F.trim(F.col(k)).alias(f"_gone_{k}") for k in keys]).distinct()
    same = [F.trim(target[k]) == gone[f"_gone_{k}"] for k in keys]
    return target.join(gone, same, "left_anti")


def keyed_replace(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The target after its rows with a key of the batch gave way to the batch."""
    return without_keys(target, batch, keys).unionByName(batch)
