"""The two marts on members and costs derived from orders and order lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.registry import check, table
from millrace import session
from millrace.plans import marts

DAY = "2024-09-09"

# one member per order; both engines derive the same columns
MEMBER_COLUMNS = """
c_mktsegment as chi_data_point, o_orderstatus as chi_data_point_ref,
case o_orderpriority when '1-URGENT' then 'Self Funded' when '2-HIGH' then null else o_orderpriority end as mbr_grp,
concat('P', cast(c_nationkey % 5 as {text})) as master_pcp, concat('C', cast(c_nationkey as {text})) as master_clinic,
cast(o_orderkey as {text}) as contract_id,
case when o_orderpriority <> '5-LOW' then cast(o_custkey as {text}) end as party_key,
cast(floor(o_totalprice / 10000) as int) as age,
case when c_nationkey < 10 then 'M' when c_nationkey < 20 then 'F' end as mbr_gender_cd,
case when c_acctbal < 0 then 'IH' else 'EX' end as source_code,
cast(o_totalprice as decimal(18,2)) as retro_risk, cast(c_acctbal as decimal(18,2)) as dx_med_risk,
cast(o_totalprice as decimal(18,2)) - cast(c_acctbal as decimal(18,2)) as prosp_risk,
cast(case when o_orderstatus = 'O' and c_mktsegment = 'BUILDING' then 0 else 1 + c_nationkey % 6 end as decimal(10,2)) as ytd_mm,
cast(12 as decimal(10,2)) as ry_mm, cast(date_trunc('year', o_orderdate) as date) as align_as_of_dt
"""
COST_COLUMNS = """
c_mktsegment as chi_data_point, o_orderstatus as chi_data_point_ref,
case o_orderpriority when '1-URGENT' then 'Self Funded' when '2-HIGH' then null else o_orderpriority end as mbr_grp,
concat('P', cast(c_nationkey % 5 as {text})) as master_pcp, l_returnflag as svc_cat, l_linestatus as svc_sub_cat,
cast(l_extendedprice as decimal(18,2)) as ry_allowed_amt, cast(l_quantity as decimal(18,2)) as ytd_allowed_amt,
cast(date_trunc('year', o_orderdate) as date) as align_as_of_dt
"""
MEMBERS_SQL = f"select {MEMBER_COLUMNS.format(text='varchar')} from orders join customer on o_custkey = c_custkey"
COSTS_SQL = (
    f"select {COST_COLUMNS.format(text='varchar')} from lineitem join orders on l_orderkey = o_orderkey "
    "join customer on o_custkey = c_custkey"
)


def members(spark: SparkSession, folder: str) -> DataFrame:
    orders, customer = table(spark, folder, "orders"), table(spark, folder, "customer")
    joined = orders.join(customer, orders.o_custkey == customer.c_custkey)
    return joined.selectExpr(*columns(MEMBER_COLUMNS))


def costs(spark: SparkSession, folder: str) -> DataFrame:
    lines, orders = table(spark, folder, "lineitem"), table(spark, folder, "orders")
    customer = table(spark, folder, "customer")
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey).join(
        customer, orders.o_custkey == customer.c_custkey
    )
    return joined.selectExpr(*columns(COST_COLUMNS))


def columns(listing: str) -> list[str]:
    """The select list as single expressions (each ends in `as <name>`)."""
    out, part = [], ""
    for piece in listing.format(text="string").replace("\n", " ").split(","):
        part = f"{part},{piece}" if part else piece
        words = part.split()
        if len(words) > 2 and words[-2] == "as" and part.count("(") == part.count(")"):
            out.append(part.strip())
            part = ""
    return out


def exact(total: str, weight: str, digits: int, kind: str) -> str:
    """SQL: total / weight rounded half away from zero to `digits`, with integers (total has 4 digits, weight 2)."""
    num = f"cast({total} * 10000 as hugeint) * {10 ** digits}"
    den = f"cast({weight} * 10000 as hugeint)"
    rounded = f"sign({num}) * ((2 * abs({num}) + {den}) // (2 * {den}))"
    return f"case when {weight} <> 0 then cast(cast({rounded} as decimal(28,0)) / {10 ** digits} as {kind}) end"


DEMOGRAPHIC_SQL = f"""
with m as ({MEMBERS_SQL}),
g as (select chi_data_point, chi_data_point_ref, align_as_of_dt,
  case when grouping(mbr_grp) = 1 then 'TOTAL' else mbr_grp end as mbr_grp,
  case when grouping(master_pcp) = 1 then 'TOTAL' else master_pcp end as master_pcp,
  case when grouping(master_clinic) = 1 then 'TOTAL' else master_clinic end as master_clinic,
  count(contract_id || party_key) as n, sum(age) as ages, count(age) as age_n,
  count(*) filter (where mbr_gender_cd = 'M') as males, count(*) filter (where mbr_gender_cd = 'F') as females,
  sum(case when mbr_grp <> 'Self Funded' and source_code <> 'IH' then retro_risk else dx_med_risk end * ytd_mm) as yr,
  sum(prosp_risk * ytd_mm) as yp, sum(ytd_mm) as ym,
  sum(case when mbr_grp <> 'Self Funded' and source_code <> 'IH' then retro_risk else dx_med_risk end * ry_mm) as rr,
  sum(prosp_risk * ry_mm) as rp, sum(ry_mm) as rm
  from m group by grouping sets (
    (chi_data_point, chi_data_point_ref, align_as_of_dt, mbr_grp, master_pcp, master_clinic),
    (chi_data_point, chi_data_point_ref, align_as_of_dt, mbr_grp), (chi_data_point, chi_data_point_ref, align_as_of_dt)))
select distinct chi_data_point, chi_data_point_ref, align_as_of_dt, mbr_grp, master_pcp, master_clinic,
  n as cnt_of_memberid, {exact('ages', 'age_n', 3, 'decimal(6,3)')} as avg_age,
  males as male_cnt, females as female_cnt,
  {exact('males * 100', 'n', 3, 'decimal(6,3)')} as male_pct, {exact('females * 100', 'n', 3, 'decimal(6,3)')} as female_pct,
  {exact('yr', 'ym', 6, 'decimal(18,6)')} as ytd_adjusted_retro_risk, {exact('yp', 'ym', 6, 'decimal(18,6)')} as ytd_adjusted_prosp_risk,
  {exact('rr', 'rm', 6, 'decimal(18,6)')} as ry_adjusted_retro_risk, {exact('rp', 'rm', 6, 'decimal(18,6)')} as ry_adjusted_prosp_risk,
  date '{DAY}' as load_dt
from g
"""


@check("member_demographics_mart", DEMOGRAPHIC_SQL)
def member_demographics_mart(spark: SparkSession, folder: str) -> DataFrame:
    return marts.member_demographics(members(spark, folder), F.lit(DAY).cast("date"))


def grain(keys: list[str]) -> str:
    """SQL: one grain of the cost mart, joined to the member months of the same group and provider."""
    shared = [k for k in keys if k in ("mbr_grp", "master_pcp")]
    base = ["chi_data_point", "chi_data_point_ref", "align_as_of_dt"]
    months = ", ".join([*base, *shared])
    same = " and ".join(f"c.{k} = u.{k}" for k in (*base, *shared))
    labels = ", ".join(
        f"c.{d} as {d}" if d in keys else f"'TOTAL' as {d}" for d in ("svc_cat", "svc_sub_cat", "master_pcp", "mbr_grp")
    )
    group = ", ".join(f"c.{k}" for k in (*base, *keys))
    return f"""
select c.chi_data_point, c.chi_data_point_ref, {labels}, c.align_as_of_dt, sum(ry_allowed_amt) as ry_a, max(u.ry) as ry_m,
  sum(ytd_allowed_amt) as ytd_a, max(u.ytd) as ytd_m
from c join (select {months}, sum(ytd_mm) as ytd, sum(ry_mm) as ry from m group by {months}) u on {same} group by {group}"""


COST_SQL = f"""
with m as ({MEMBERS_SQL}), c as ({COSTS_SQL}),
cats as ({grain(['svc_cat'])}),
everything as (
select * from cats union {grain(['svc_cat', 'svc_sub_cat'])} union {grain(['svc_cat', 'mbr_grp'])}
union {grain(['svc_cat', 'master_pcp'])} union {grain(['svc_cat', 'mbr_grp', 'master_pcp'])}
union select chi_data_point, chi_data_point_ref, 'TOTAL', 'TOTAL', 'TOTAL', 'TOTAL', align_as_of_dt, sum(ry_a), max(ry_m),
  sum(ytd_a), max(ytd_m) from cats group by chi_data_point, chi_data_point_ref, align_as_of_dt)
select chi_data_point, chi_data_point_ref, svc_cat, svc_sub_cat, master_pcp, mbr_grp, align_as_of_dt,
  cast(ry_a as decimal(28,2)) as ry_allowed_amt, cast(ry_m as decimal(28,2)) as ry_mm, {exact('ry_a', 'ry_m', 6, 'decimal(18,6)')} as ry_pmpm,
  cast(ytd_a as decimal(28,2)) as ytd_allowed_amt, cast(ytd_m as decimal(28,2)) as ytd_mm, {exact('ytd_a', 'ytd_m', 6, 'decimal(18,6)')} as ytd_pmpm
from everything
"""


def two_digits(mart: DataFrame) -> DataFrame:
    amounts = ["ry_allowed_amt", "ry_mm", "ytd_allowed_amt", "ytd_mm"]
    return mart.withColumns({a: F.col(a).cast("decimal(28,2)") for a in amounts})


@check("cost_pmpm_mart", COST_SQL)
def cost_pmpm_mart(spark: SparkSession, folder: str) -> DataFrame:
    return two_digits(marts.cost_per_member_month(costs(spark, folder), members(spark, folder)))


@check("cost_pmpm_refresh", COST_SQL)
def cost_pmpm_refresh(spark: SparkSession, folder: str) -> DataFrame:
    """Late files touch some slices: the mart follows by the stored sums of both sources' files."""
    base, target = session.scratch_path(spark, "cost-files"), session.scratch_path(spark, "cost-mart")
    all_costs, all_members = costs(spark, folder), members(spark, folder)
    late = F.expr("align_as_of_dt >= date'1999-01-01' and svc_cat = 'R'")
    all_members.write.parquet(f"{base}/members")
    for rows in (all_costs.where(~late), all_costs.where(late)):
        rows.write.mode("append").parquet(f"{base}/costs")
        marts.refresh_cost_mart(spark, f"{base}/costs", all_costs.schema, f"{base}/members", all_members.schema, target, f"{base}/state", buckets=8)
    return two_digits(spark.read.parquet(target))
