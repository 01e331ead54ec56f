"""Marts and profiles: grains, nulls, labels, zero denominators."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from millrace.operators import aggregate, profile, quality
from millrace.plans import marts, profiling

DAY = dt.date(2024, 1, 1)
MEMBER = (
    "chi_data_point string, chi_data_point_ref string, mbr_grp string, master_pcp string, master_clinic string, "
    "contract_id string, party_key string, age int, mbr_gender_cd string, source_code string, retro_risk decimal(10,4), "
    "dx_med_risk decimal(10,4), prosp_risk decimal(10,4), ytd_mm decimal(10,2), ry_mm decimal(10,2), align_as_of_dt date"
)


def member(group, pcp="p", *, contract="c", gender="M", source="EX", months=1):
    return ("c", "r", group, pcp, "k", contract, "1", 30, gender, source, D(2), D(5), D(1), D(months), D(12), DAY)


def members(spark, *rows):
    return spark.createDataFrame(list(rows), MEMBER)


def demographics(spark, *rows):
    mart = marts.member_demographics(members(spark, *rows), F.lit(DAY))
    return {(r["mbr_grp"], r["master_pcp"], r["master_clinic"]): r for r in mart.collect()}


def test_null_group_stays_apart_from_the_total(spark):
    rows = demographics(spark, member("g"), member(None))
    assert rows[(None, "TOTAL", "TOTAL")]["cnt_of_memberid"] == 1
    assert rows[("TOTAL", "TOTAL", "TOTAL")]["cnt_of_memberid"] == 2


def test_group_named_total_merges_only_equal_rows(spark):
    rows = marts.member_demographics(members(spark, member("TOTAL")), F.lit(DAY)).collect()
    # the group grain and the overall grain are the same row, the fine grain is not
    assert len(rows) == 2


def test_risk_choice_counts_and_zero_months(spark):
    rows = demographics(
        spark, member("g"), member("Self Funded"), member(None), member("h", source="IH"),
        member("z", months=0, contract=None, gender=None),
    )
    risk = {g: rows[(g, "TOTAL", "TOTAL")]["ytd_adjusted_retro_risk"] for g in ("g", "Self Funded", None, "h", "z")}
    assert risk == {"g": D(2), "Self Funded": D(5), None: D(5), "h": D(5), "z": None}
    empty = rows[("z", "TOTAL", "TOTAL")]
    assert empty["cnt_of_memberid"] == 0 and empty["male_pct"] is None and empty["male_cnt"] == 0


COST = (
    "chi_data_point string, chi_data_point_ref string, svc_cat string, svc_sub_cat string, mbr_grp string, "
    "master_pcp string, align_as_of_dt date, ry_allowed_amt decimal(12,2), ytd_allowed_amt decimal(12,2)"
)


def test_costs_meet_months_of_the_same_grain(spark):
    costs = spark.createDataFrame(
        [
            ("c", "r", "ip", "a", "g", "p", DAY, D(120), D(10)),
            ("c", "r", "ip", "b", None, "p", DAY, D(60), D(20)),
            ("c", "r", "op", "a", "nobody", "p", DAY, D(36), D(30)),
            ("zz", "r", "op", "a", "g", "p", DAY, D(1), D(1)),
        ],
        COST,
    )
    mart = marts.cost_per_member_month(costs, members(spark, member("g"), member(None, months=2)))
    rows = {(r["svc_cat"], r["svc_sub_cat"], r["master_pcp"], r["mbr_grp"]): r for r in mart.collect()}
    assert rows[("TOTAL",) * 4]["ry_allowed_amt"] == 216 and rows[("TOTAL",) * 4]["ry_mm"] == 24
    assert rows[("ip", "TOTAL", "TOTAL", "TOTAL")]["ytd_pmpm"] == 10
    assert rows[("ip", "TOTAL", "TOTAL", "g")]["ry_pmpm"] == 10
    # an unknown group, a group without members and an unknown population have no months
    assert not [k for k in rows if k[3] in (None, "nobody")]
    assert {r["chi_data_point"] for r in rows.values()} == {"c"}


def test_levels_equal_one_query_per_grain(spark):
    rows = spark.range(5000).selectExpr(
        "if(id % 3 = 0, 'hot', cast(id % 17 as string)) as a", "if(id % 5 = 0, null, cast(id % 4 as string)) as b", "id as v"
    )
    levels = aggregate.grouping_levels(rows, [], ["a", "b"], [["a", "b"], ["a"], []], {"v": ("sum", F.col("v"))})
    got = sorted(map(str, (tuple(r) for r in levels.select("a", "b", "v", "_off_a", "_off_b").collect())))
    parts = [
        rows.groupBy("a", "b").agg(F.sum("v").alias("v")).selectExpr("a", "b", "v", "0", "0"),
        rows.groupBy("a").agg(F.sum("v").alias("v")).selectExpr("a", "null", "v", "0", "1"),
        rows.agg(F.sum("v").alias("v")).selectExpr("null", "null", "v", "1", "1"),
    ]
    assert got == sorted(str(tuple(r)) for p in parts for r in p.collect())


def test_profile_traps(spark):
    table = spark.createDataFrame(
        [("", None, 1.0, [1], True), ("  ", None, -0.0, [1], True), ("x", None, 0.0, None, False)],
        "blank string, nothing string, number double, list array<int>, yes boolean",
    )
    rows = {r["column_name"]: r for r in profile.profile_tables({"t": table}, run_id="r").collect()}
    assert (rows["blank"]["null_count"], rows["blank"]["distinct_count"]) == (2, 3)
    assert rows["blank"]["distinct_percentage"] == 300
    assert rows["nothing"]["null_percentage"] == 100 and rows["nothing"]["distinct_percentage"] is None
    assert rows["number"]["distinct_count"] == 2 and rows["yes"]["min_value"] == "false"
    assert rows["list"]["distinct_count"] == 1 and rows["list"]["min_value"] is None
    near = profile.profile_tables({"t": table}, run_id="r", approximate=True)
    assert {r["column_name"]: r["distinct_count"] for r in near.collect()}["number"] == 2
    strict = profile.profile_tables({"t": table}, run_id="r", blanks_are_null=False)
    assert {r["column_name"]: r["null_count"] for r in strict.collect()}["blank"] == 0


def test_empty_table_has_no_percentages(spark):
    row = profile.profile_tables({"t": spark.createDataFrame([], "a int")}, run_id="r").first()
    assert (row["total_rows"], row["null_percentage"], row["distinct_percentage"]) == (0, None, None)


def test_long_values_are_told_apart_by_their_end(spark):
    table = spark.range(50).selectExpr("concat(repeat('x', 5000), id) as long")
    assert profile.profile_tables({"t": table}, run_id="r").first()["distinct_count"] == 50


@pytest.mark.parametrize("threshold,expected", [(50, 1), (99, 1), (100, 0)])
def test_high_null_threshold(spark, threshold, expected):
    results = profiling.profile_run({"t": spark.createDataFrame([(1, None)], "a int, b string")}, run_id="r")
    assert quality.high_null_columns(results, threshold).count() == expected


def test_catalog_profile(spark):
    spark.sql("create schema if not exists profiled")
    spark.range(3).write.mode("overwrite").saveAsTable("profiled.numbers")
    try:
        named = profiling.catalog_tables(spark, "profiled")
        assert profiling.profile_run(named).first()["total_rows"] == 3
    finally:
        spark.sql("drop schema profiled cascade")


def test_risks_keep_all_their_digits(spark):
    """Inputs are not rounded; a share of a million and more fits."""
    from pyspark.sql import functions as F

    from millrace.functions import measures

    layout = (
        "chi_data_point string, chi_data_point_ref string, align_as_of_dt date, mbr_grp string, master_pcp string, master_clinic string, "
        "contract_id string, party_key string, age int, mbr_gender_cd string, source_code string, "
        "retro_risk decimal(18,8), dx_med_risk decimal(18,8), prosp_risk double, ytd_mm decimal(10,4), ry_mm decimal(10,4)"
    )
    from decimal import Decimal

    row = ("a", "b", None, "g", "p", "c", "1", "2", 3, "M", "x", Decimal("0.00000400"), Decimal(0), 0.000004, Decimal("0.0001"), Decimal("2.0000"))
    mart = marts.member_demographics(spark.createDataFrame([row], layout), F.current_date())
    got = mart.where("master_clinic = 'c'").first()
    assert got["ytd_adjusted_retro_risk"] == got["ry_adjusted_retro_risk"] == Decimal("0.000004")
    assert got["ytd_adjusted_prosp_risk"] == Decimal("0.000004")
    share = spark.range(1).select(measures.share_pct(F.lit(5_000_000_000), F.lit(10_000_000_000)).alias("s")).first().s
    assert share == Decimal("50.000")


def test_wide_decimals_stay_exact(spark):
    """Columns that declare 38 digits: no double, the same sum in any order of rows."""
    from decimal import Decimal

    layout = (
        "chi_data_point string, chi_data_point_ref string, align_as_of_dt date, mbr_grp string, master_pcp string, master_clinic string, "
        "contract_id string, party_key string, age int, mbr_gender_cd string, source_code string, "
        "retro_risk decimal(38,4), dx_med_risk decimal(38,4), prosp_risk decimal(38,4), ytd_mm decimal(18,2), ry_mm decimal(18,2)"
    )
    wide = Decimal("90071992547409.9301")  # beyond what a double tells apart
    rows = [("a", "b", None, "g", "p", "c", str(i), "2", 3, "M", "x", r, Decimal(0), r, Decimal("1.00"), Decimal("3.00")) for i, r in enumerate([wide, Decimal("0.0001"), -wide] * 50)]
    frame = spark.createDataFrame(rows, layout)
    product = marts._weighted(frame, F.col("retro_risk"), F.col("ytd_mm"))
    total = frame.agg(F.sum(product).alias("t")).first().t
    assert total == Decimal("0.0050") and isinstance(total, Decimal)
    big = spark.createDataFrame([(Decimal(10) ** 25, Decimal("2.00"))], "v decimal(38,4), w decimal(18,2)")
    assert big.select(marts._weighted(big, F.col("v"), F.col("w")).alias("p")).first().p == 2 * Decimal(10) ** 25
    mart = marts.member_demographics(frame, F.current_date()).where("master_clinic = 'c'").first()
    assert mart["ytd_adjusted_retro_risk"] == Decimal("0.000033")
