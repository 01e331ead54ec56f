"""Literal one-query-per-step plans of four registered queries, to measure the planned ones against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import aggregates, documents, marts
from checks.registry import table


def multi_grain_rollup(spark: SparkSession, folder: str) -> DataFrame:
    """One scan and aggregate per grain, then a union."""
    facts = aggregates.order_facts(spark, folder)

    def grain(*keys: str) -> DataFrame:
        labels = [
            F.col(k).alias(k) if k in keys else F.lit("TOTAL").alias(k) for k in ("c_mktsegment", "n_name")
        ]
        price = F.sum(aggregates.money("o_totalprice")).alias("sum_price")
        return facts.groupBy(*keys).agg(F.count("*").alias("n_orders"), price).select(*labels, "n_orders", "sum_price")

    return grain("c_mktsegment", "n_name").union(grain("c_mktsegment")).union(grain()).distinct()


def cost_pmpm_mart(spark: SparkSession, folder: str) -> DataFrame:
    """One denominator, join and aggregate per grain, then a union."""
    from millrace.plans import marts as plan

    costs, members = marts.costs(spark, folder), marts.members(spark, folder)

    def grain(keys: list[str]) -> DataFrame:
        shared = [*plan.BASE, *[k for k in keys if k in ("mbr_grp", "master_pcp")]]
        months = members.groupBy(*shared).agg(F.sum("ry_mm").alias("mm"))
        joined = costs.join(months, shared)
        out = joined.groupBy(*plan.BASE, *keys).agg(F.sum("ry_allowed_amt").alias("amt"), F.max("mm").alias("mm"))
        dims = ["svc_cat", "svc_sub_cat", "master_pcp", "mbr_grp"]
        return out.select(
            *plan.BASE, *[F.col(d) if d in keys else F.lit("TOTAL").alias(d) for d in dims], "amt", "mm"
        )

    merged = grain(plan.COST_GRAINS[0])
    for keys in plan.COST_GRAINS[1:]:
        merged = merged.union(grain(keys))
    return merged.distinct()


def flatten_siblings(spark: SparkSession, folder: str) -> DataFrame:
    """All arrays exploded side by side, folded by MAX afterwards."""
    rows = documents.parsed_orders(spark, folder)
    for name, array in (
        ("i", "doc.identifier"),
        ("c", "i.type.coding"),
        ("line", "doc.line"),
        ("site", "doc.site"),
    ):
        rows = rows.withColumn(name, F.explode_outer(array))
    return rows.groupBy("o_orderkey").agg(
        F.max(F.when(F.col("c.code") == "PRI", F.col("i.value")).otherwise("")).alias("priority"),
        F.max(F.when(F.col("c.code") == "CUST", F.col("i.value")).otherwise("")).alias("customer"),
        F.max("line.ref").alias("max_ref"),
        F.max("line.no").alias("max_no"),
        F.array_join(F.sort_array(F.collect_set("site")), "||").alias("sites"),
    )


def profile_lineitem(spark: SparkSession, folder: str) -> DataFrame:
    """One query per column."""
    lines = table(spark, folder, "lineitem")
    parts = [
        lines.agg(
            F.lit(c).alias("column_name"),
            F.count("*").alias("total_rows"),
            F.count_if(F.col(c).isNull() | (F.length(F.trim(F.col(c).cast("string"))) == 0)).alias("null_count"),
            F.count_distinct(c).alias("distinct_count"),
            F.min(c).cast("string").alias("min_value"),
            F.max(c).cast("string").alias("max_value"),
        )
        for c in lines.columns
    ]
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.union(part)
    return merged


NAIVE = {
    "multi_grain_rollup": multi_grain_rollup,
    "cost_pmpm_mart": cost_pmpm_mart,
    "flatten_siblings": flatten_siblings,
    "profile_lineitem": profile_lineitem,
}
