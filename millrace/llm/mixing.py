"""Mixing sources to target weights by repetition rates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace import session
from millrace.llm.text import free_name, word_count

MAX_REPEATS = 3


def source_targets(sizes: DataFrame, weight: Column, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """`sizes` (source, source_size) with `weight` and `target`, the words each source gives to the mix.

    All sizes are shared out by weight. A target stops at `max_repeats` times its source's size and
    the excess is reshared by weight among the others, until none is above. In order of the weight
    at which a source reaches its limit the full ones come first, so one running sum finds them.
    The table has one short row for each source, which is what the sorted windows hold.
    """
    ranked = sizes.withColumn("weight", weight).withColumn("cap", F.col("source_size") * max_repeats)
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_first())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    ranked = (
        ranked.withColumn("total", F.sum("source_size").over(everything))
        .withColumn("weights", F.sum("weight").over(everything))
        .withColumn("full", F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("spent", F.coalesce(F.sum("weight").over(before), F.lit(0)))
    )
    # the share of one weight unit if exactly the sources before this one are full
    unit = (F.col("total") - F.col("full")) / (F.col("weights") - F.col("spent"))
    ranked = ranked.withColumn("unit", F.when(unit * F.col("weight") <= F.col("cap"), unit))
    # the first source that is not full sets the unit for itself and all after it
    ranked = ranked.withColumn("unit", F.first("unit", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return ranked.select(
        "source", "source_size", "weight",
        F.when(F.col("unit").isNull(), F.col("cap").cast("double")).otherwise(F.col("unit") * F.col("weight")).alias("target"),
    )


def cycled_weight(source: str = "source", cycle: int = 3) -> Column:
    """1, 2 … `cycle`, 1, 2 … over the sources in code point order, NULL last."""
    return (F.row_number().over(Window.orderBy(F.col(source).asc_nulls_last())) - 1) % cycle + 1


def draw(key: Column, digest: Column, number: Column, seed: int = 0) -> Column:
    """A number in [0, 1) that depends on the id, the text's digest, the number among equal rows and the seed alone.

    A NULL id counts as empty text.
    """
    text = F.concat_ws(":", F.lit(str(seed)), F.coalesce(key.cast("string"), F.lit("")), digest, number.cast("string"))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long") / F.lit(2.0**32)


def plan_mix(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    source: str = "source",
    max_repeats: int = MAX_REPEATS,
    seed: int = 0,
) -> DataFrame:
    """`docs` with mix_size, mix_source_size, mix_target and mix_copies (names free of clashes, see below).

    A source's rate is target / size; a document is taken floor(rate) times and once more with the
    fraction as probability, drawn from its id, its text's digest and its number among the rows that
    have both and the source in common. So reruns agree and rows without ids, or with one id, are
    drawn one by one. Only rows that do repeat others are numbered, in a sorted stretch of their
    own. Sizes are added up per source before the shuffle, and the source table, of one row for
    each source, is joined by plain equality, so a hot source can be split or broadcast. Empty and
    NULL texts have size 0; a source of size 0 has target 0 and its documents are not taken. A NULL
    source is one source, the last. Texts of any length count whole; an empty table gives an empty
    result. The four columns are the last four of the result; where the table has one of the names,
    a number is added.
    """
    size, of, target, copies, at, digest, number, *same = (
        free_name(docs.columns, x)
        for x in ("mix_size", "mix_source_size", "mix_target", "mix_copies", "mix_source", "mix_digest", "mix_number", "mix_a", "mix_b", "mix_c")
    )
    keys = [F.col(doc_id), F.col(digest), F.col(source)]
    held = docs.withColumn(digest, F.md5(F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")))
    counted = held.groupBy(*keys).agg(F.count("*").alias(number)).where(F.col(number) > 1)
    repeated = session.settle(counted.select(*[k.alias(n) for k, n in zip(keys, same)]), "repeated-documents")
    if repeated.isEmpty():
        numbered = held.withColumn(number, F.lit(1))
    else:
        equal = reduce(lambda x, y: x & y, [k.eqNullSafe(F.col(n)) for k, n in zip(keys, same)])
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.lit(0)))
        numbered = held.join(repeated, equal, "left_anti").withColumn(number, F.lit(1)).unionByName(
            held.join(repeated, equal, "left_semi").withColumn(number, place)
        )
    sized = numbered.withColumn(size, word_count(F.col(text)))
    sums = (
        docs.select(F.col(source).alias("source"), word_count(F.col(text)).alias("n"))
        .groupBy("source").agg(F.sum("n").alias("source_size"))
    )
    # stored, so that the size of its file decides whether it is broadcast, before any text is shuffled
    targets = session.settle(source_targets(sums, cycled_weight(), max_repeats), "source-targets").select(
        F.col("source").alias(at), F.col("source_size").alias(of), F.col("target").alias(target)
    )
    rate = F.when(F.col(of) > 0, F.least(F.col(target) / F.col(of), F.lit(float(max_repeats)))).otherwise(0.0)
    whole = F.floor(rate)
    return (
        sized.join(targets, F.col(source).eqNullSafe(F.col(at)), "left")
        .withColumn(copies, (whole + (draw(F.col(doc_id), F.col(digest), F.col(number), seed) < rate - whole).cast("long")).cast("long"))
        .select(*[F.col(f"`{c}`") for c in docs.columns], size, of, target, copies)
    )


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each document as often as `plan_mix` takes it; the columns stay as they are."""
    planned = plan_mix(docs, **options)
    copies = planned.columns[-1]
    again = free_name(planned.columns, "again")
    return (
        planned.where(F.col(copies) > 0)
        .select(*[F.col(f"`{c}`") for c in docs.columns], F.explode(F.sequence(F.lit(1), F.col(copies))).alias(again))
        .select(*[F.col(f"`{c}`") for c in docs.columns])
    )
