"""The two marts: member demographics and cost per member per month.

Each input is scanned once. The finest grain is aggregated first (combining on
the map side, so a member group holding a third of all rows is no hot spot) and
only its rows are expanded to the coarser grains.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import measures
from millrace.operators import aggregate
from millrace.streaming import partials

BASE = ["chi_data_point", "chi_data_point_ref", "align_as_of_dt"]
PERIODS = ["ytd", "ry"]
# Which members take which risk score.
SELF_FUNDED = "Self Funded"
IN_HOUSE = "IH"


def _amount(frame: DataFrame, col: Column) -> Column:
    """A value to add up with all its digits: decimals as they are, whole numbers widened.

    Binary fractions stay binary. Only results are rounded.
    """
    kind = frame.select(col).schema[0].dataType
    return col if isinstance(kind, (T.DecimalType, T.FractionalType)) else col.cast("decimal(20,0)")


def _weighted(frame: DataFrame, value: Column, weight: Column) -> Column:
    """Product of two decimals as a decimal, whatever digits the columns declare, so that sums do not depend on row order.

    Values of up to 19 and weights of up to 18 digits multiply without loss. Where a row has more,
    the product is rounded to the digits that 38 leave, and one that does not fit is an error.
    Binary fractions stay binary.
    """
    kinds = [frame.select(c).schema[0].dataType for c in (value, weight)]
    if not all(isinstance(k, T.DecimalType) for k in kinds):
        return value.cast("double") * weight.cast("double")
    left, right = (k.scale for k in kinds)
    if kinds[0].precision + kinds[1].precision < 38 or left > 19 or right > 18:
        return value * weight
    narrow = value.try_cast(f"decimal(19,{left})") * weight.try_cast(f"decimal(18,{right})")
    return F.coalesce(narrow, (value * weight).cast(f"decimal(38,{left + right})"))


def member_demographics(members: DataFrame, day: Column) -> DataFrame:
    """Counts, ages, gender shares and month-weighted risk at three nested grains."""
    member = F.concat("contract_id", "party_key")
    risk = F.when(
        (F.col("mbr_grp") != SELF_FUNDED) & (F.col("source_code") != IN_HOUSE), F.col("retro_risk")
    ).otherwise(F.col("dx_med_risk"))
    inputs: dict[str, tuple[str, Column]] = {
        "n_members": ("sum", member.isNotNull().cast("bigint")),
        "age_sum": ("sum", F.col("age").cast("bigint")),
        "age_n": ("sum", F.col("age").isNotNull().cast("bigint")),
        "males": ("sum", F.when(F.col("mbr_gender_cd") == "M", 1).otherwise(0).cast("bigint")),
        "females": ("sum", F.when(F.col("mbr_gender_cd") == "F", 1).otherwise(0).cast("bigint")),
    }
    outputs = {
        "cnt_of_memberid": F.col("n_members"),
        "avg_age": measures.mean_decimal(F.col("age_sum"), F.col("age_n")),
        "male_cnt": F.col("males"),
        "female_cnt": F.col("females"),
        "male_pct": measures.share_pct(F.col("males"), F.col("n_members")),
        "female_pct": measures.share_pct(F.col("females"), F.col("n_members")),
    }
    for period in PERIODS:
        months = _amount(members, F.col(f"{period}_mm"))
        inputs[f"{period}_months"] = ("sum", months)
        inputs[f"{period}_retro"] = ("sum", _weighted(members, _amount(members, risk), months))
        inputs[f"{period}_prosp"] = ("sum", _weighted(members, _amount(members, F.col("prosp_risk")), months))
        for kind in ("retro", "prosp"):
            outputs[f"{period}_adjusted_{kind}_risk"] = measures.ratio(
                F.col(f"{period}_{kind}"), F.col(f"{period}_months")
            ).cast("decimal(18,6)")
    dims = ["mbr_grp", "master_pcp", "master_clinic"]
    rollup = aggregate.multi_grain_rollup(
        members, BASE, dims, [dims, ["mbr_grp"], []], inputs, outputs
    )
    return rollup.withColumn("load_dt", day)


COST_GRAINS = [
    [],
    ["svc_cat"],
    ["svc_cat", "svc_sub_cat"],
    ["svc_cat", "mbr_grp"],
    ["svc_cat", "master_pcp"],
    ["svc_cat", "mbr_grp", "master_pcp"],
]
MONTH_GRAINS = [[], ["mbr_grp"], ["master_pcp"], ["mbr_grp", "master_pcp"]]


def cost_per_member_month(costs: DataFrame, members: DataFrame) -> DataFrame:
    """Allowed amounts over member months at six grains.

    The months of a grain ignore the service category, so costs and months are
    aggregated apart and meet at equal group and provider. Costs of a group
    without members, or of an unknown group at a group grain, drop.
    """
    months = aggregate.grouping_levels(
        members,
        BASE,
        ["mbr_grp", "master_pcp"],
        MONTH_GRAINS,
        {f"{p}_mm": ("sum", _amount(members, F.col(f"{p}_mm"))) for p in PERIODS},
    )
    allowed = aggregate.grouping_levels(
        costs,
        BASE,
        ["svc_cat", "svc_sub_cat", "mbr_grp", "master_pcp"],
        COST_GRAINS,
        {f"{p}_allowed_amt": ("sum", _amount(costs, F.col(f"{p}_allowed_amt"))) for p in PERIODS},
    )
    joined = aggregate.matched_units(allowed, months, BASE, ["mbr_grp", "master_pcp"])
    dims = ["svc_cat", "svc_sub_cat", "master_pcp", "mbr_grp"]
    columns = [
        "chi_data_point",
        "chi_data_point_ref",
        *[aggregate.labelled(d) for d in dims],
        "align_as_of_dt",
    ]
    for p in reversed(PERIODS):
        amount, mm = F.col(f"{p}_allowed_amt"), F.col(f"{p}_mm")
        columns += [amount, mm, measures.ratio(amount, mm).cast("decimal(18,6)").alias(f"{p}_pmpm")]
    return joined.select(*columns).distinct()


def refresh_changed(
    changed: DataFrame, sources: dict[str, DataFrame], compute, slice_col: str = "align_as_of_dt"
) -> DataFrame:
    """The mart recomputed for the changed slices only.

    `changed` holds the slice values, NULL included; every source is reduced to
    them before the mart is computed. Write the result with
    `sources.tables.replace_slices` and hand it `changed`, so that slices
    without rows are emptied. This reads all files of the slices again;
    `streaming.partials` adds them up from stored sums instead.
    """
    slices = changed.select(F.col(slice_col).alias("_changed")).distinct()
    same = F.col(slice_col).eqNullSafe(F.col("_changed"))
    return compute(**{n: s.join(slices, same, "left_semi") for n, s in sources.items()})


def refresh_cost_mart(
    spark: SparkSession, costs: str, costs_schema: T.StructType, members: str, members_schema: T.StructType, target: str, state: str,
    buckets: int | None = None,
) -> None:
    """Follow new and changed files of both sources: the cost mart from their stored sums (`streaming.partials`)."""

    def sums(root: str, schema: T.StructType, name: str, dims: list[str], amounts: list[str]) -> partials.PartialSums:
        frame = spark.createDataFrame([], schema)
        measures = {a: ("sum", _amount(frame, F.col(a))) for a in amounts}
        return partials.PartialSums(spark, root, schema, f"{state}/{name}", "align_as_of_dt", [*BASE, *dims], measures, buckets)

    sources = {
        "costs": sums(costs, costs_schema, "costs", ["svc_cat", "svc_sub_cat", "mbr_grp", "master_pcp"], [f"{p}_allowed_amt" for p in PERIODS]),
        "members": sums(members, members_schema, "members", ["mbr_grp", "master_pcp"], [f"{p}_mm" for p in PERIODS]),
    }
    partials.refresh(spark, sources, target, "align_as_of_dt", cost_per_member_month)
