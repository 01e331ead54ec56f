"""Aggregates: rollups over nested grains, ratios, slots, ordered sets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOTAL = "TOTAL"


def attribute_pivot(rows: DataFrame, keys: Sequence[str], columns: Mapping[str, Column]) -> DataFrame:
    """Tall tags to one wide row per key: MAX of each conditional value."""
    return rows.groupBy(*keys).agg(*[F.max(c).alias(n) for n, c in columns.items()])


def slots_pivot(
    rows: DataFrame, keys: Sequence[str], slot: str, value: Column, names: Sequence[str]
) -> DataFrame:
    """Ranked rows side by side: slot i goes to the i-th name."""
    return attribute_pivot(
        rows, keys, {name: F.when(F.col(slot) == i, value) for i, name in enumerate(names, start=1)}
    )


def joined_set_per_key(
    rows: DataFrame, keys: Sequence[str], value: Column, separator: str, name: str
) -> DataFrame:
    """Sorted distinct values per key as one text; a key without values gets `''`.

    Duplicates go in a first aggregate spread over (key, value), so a hot key
    reaches its final group only with its distinct values.
    """
    distinct = rows.select(*keys, value.alias("_value")).distinct()
    return distinct.groupBy(*keys).agg(
        F.array_join(F.sort_array(F.collect_list("_value")), separator).alias(name)
    )


def objects_per_key(
    rows: DataFrame, keys: Sequence[str], fields: Sequence[str], order: Sequence[str], name: str
) -> DataFrame:
    """Distinct rows per key as a JSON array of objects sorted by `order`, then all fields.

    NULL fields are left out of the objects and sort last.
    """
    first = [part for c in order for part in (F.col(c).isNull().alias(f"_no_{c}"), F.col(c).alias(f"_by_{c}"))]
    packed = F.struct(*first, F.struct(*fields).alias("_object"))
    arrays = (
        rows.select(*keys, *fields)
        .distinct()
        .groupBy(*keys)
        .agg(F.sort_array(F.collect_list(packed)).alias("_objects"))
    )
    return arrays.select(
        *keys, F.to_json(F.transform("_objects", lambda o: o["_object"])).alias(name)
    )


def grouping_levels(
    rows: DataFrame,
    base: Sequence[str],
    dims: Sequence[str],
    grains: Sequence[Sequence[str]],
    measures: Mapping[str, tuple[str, Column]],
) -> DataFrame:
    """Several grains in one scan.

    `base` columns belong to every grain, each grain adds some of `dims`.
    `measures` maps a name to (`sum` | `max` | `min`, input). All of them can be
    re-aggregated, so the finest grain is built first and only its few rows are
    expanded once per grain. A collapsed dimension is NULL and has `_off_<dim>`
    equal to 1, which keeps it apart from a real NULL member.
    """
    fold = {"sum": F.sum, "max": F.max, "min": F.min}
    used = [d for d in dims if any(d in g for g in grains)]
    finest = rows.groupBy(*base, *used).agg(
        *[fold[how](value).alias(name) for name, (how, value) in measures.items()]
    )
    sets = [[F.col(c) for c in (*base, *grain)] for grain in grains]
    return finest.groupingSets(sets, *[F.col(c) for c in (*base, *used)]).agg(
        *[fold[how](F.col(name)).alias(name) for name, (how, _) in measures.items()],
        *[F.grouping(F.col(d)).cast("int").alias(f"_off_{d}") for d in used],
    )


def labelled(dim: str, label: str = TOTAL) -> Column:
    """A dimension of `grouping_levels` with its collapsed rows labelled."""
    return F.when(F.col(f"_off_{dim}") == 1, F.lit(label)).otherwise(F.col(dim).cast("string")).alias(dim)


def multi_grain_rollup(
    rows: DataFrame,
    base: Sequence[str],
    dims: Sequence[str],
    grains: Sequence[Sequence[str]],
    measures: Mapping[str, tuple[str, Column]],
    outputs: Mapping[str, Column],
    label: str = TOTAL,
) -> DataFrame:
    """The same measures at several grains, collapsed dimensions labelled.

    Rows that become equal after labelling merge, as in a deduplicating union
    of one query per grain.
    """
    levels = grouping_levels(rows, base, dims, grains, measures)
    return levels.select(
        *base,
        *[labelled(d, label) for d in dims],
        *[c.alias(n) for n, c in outputs.items()],
    ).distinct()


def matched_units(
    costs: DataFrame,
    units: DataFrame,
    base: Sequence[str],
    shared: Sequence[str],
) -> DataFrame:
    """Join two `grouping_levels` results at equal grain over the shared dimensions.

    A collapsed dimension matches only a collapsed one; a real NULL member
    matches nothing, as in an inner join on that column.
    """
    def keyed(frame: DataFrame, prefix: str) -> DataFrame:
        for d in shared:
            frame = frame.withColumn(f"{prefix}{d}", F.when(F.col(f"_off_{d}") == 1, "").otherwise(F.col(d).cast("string")))
            frame = frame.withColumn(f"{prefix}off_{d}", F.col(f"_off_{d}"))
        return frame

    left = keyed(costs, "_k_")
    joining = [f"_k_{d}" for d in shared] + [f"_k_off_{d}" for d in shared]
    right = keyed(units, "_k_").drop(*shared, *[f"_off_{d}" for d in shared])
    return left.join(right, [*base, *joining]).drop(*joining)


def union_distinct(*frames: DataFrame) -> DataFrame:
    """Deduplicating union by position; the first frame names the columns."""
    names = frames[0].columns
    merged = frames[0]
    for frame in frames[1:]:
        merged = merged.union(frame.toDF(*names))
    return merged.distinct()
