"""Aggregations, rollups and ratios on the order tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.registry import check, table
from millrace.functions import measures, text
from millrace.operators import aggregate, flatten, versions

MONEY = "decimal(18,2)"


def money(name: str):
    return F.col(name).cast(MONEY)


def exact_mean(total: str, count: str) -> str:
    """SQL: a two-digit total over a count, rounded half up with integers only."""
    cents = f"cast({total} * 100 as hugeint)"
    return f"cast(cast((2 * {cents} + {count}) // (2 * {count}) as decimal(28,0)) / 100 as decimal(18,2))"


# --- rollups -------------------------------------------------------------------


def order_facts(spark: SparkSession, folder: str) -> DataFrame:
    customer = table(spark, folder, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nation = table(spark, folder, "nation").select("n_nationkey", "n_name")
    orders = table(spark, folder, "orders")
    return orders.join(customer, orders.o_custkey == customer.c_custkey).join(
        nation, F.col("c_nationkey") == nation.n_nationkey
    )


ROLLUP_SQL = f"""
with f as (
  select c_mktsegment, n_name, o_orderstatus, cast(o_totalprice as decimal(18,2)) price,
         cast(c_acctbal as decimal(18,2)) bal, o_orderkey
  from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey)
select case when grouping(c_mktsegment) = 1 then 'TOTAL' else c_mktsegment end as c_mktsegment,
       case when grouping(n_name) = 1 then 'TOTAL' else n_name end as n_name,
       count(*) as n_orders,
       count(*) filter (where o_orderstatus = 'F') as finished_cnt,
       cast(round(count(*) filter (where o_orderstatus = 'F') * 100.0 / count(*), 2) as decimal(6,2)) as finished_pct,
       {exact_mean('sum(price)', 'count(*)')} as avg_price,
       cast(sum(price) as decimal(28,2)) as sum_price
from f group by grouping sets ((c_mktsegment, n_name), (c_mktsegment), ())
"""


@check("multi_grain_rollup", ROLLUP_SQL)
def multi_grain_rollup(spark: SparkSession, folder: str) -> DataFrame:
    one = F.lit(1).cast("bigint")
    return aggregate.multi_grain_rollup(
        order_facts(spark, folder),
        [],
        ["c_mktsegment", "n_name"],
        [["c_mktsegment", "n_name"], ["c_mktsegment"], []],
        {
            "n": ("sum", one),
            "finished": ("sum", F.when(F.col("o_orderstatus") == "F", one).otherwise(0)),
            "price": ("sum", money("o_totalprice")),
        },
        {
            "n_orders": F.col("n"),
            "finished_cnt": F.col("finished"),
            "finished_pct": measures.percent_of(F.col("finished"), F.col("n")).cast("decimal(6,2)"),
            "avg_price": F.round(measures.ratio(F.col("price"), F.col("n").cast("decimal(20,0)")), 2).cast(MONEY),
            "sum_price": F.col("price").cast("decimal(28,2)"),
        },
    )


PER_UNIT_SQL = f"""
with units as (select c_nationkey, count(*) n from orders join customer on o_custkey = c_custkey group by 1),
cost as (select c_nationkey, p_brand, sum(cast(l_extendedprice as decimal(18,2))) amt
         from lineitem join part on l_partkey = p_partkey join orders on l_orderkey = o_orderkey
         join customer on o_custkey = c_custkey group by 1, 2)
select cost.c_nationkey, p_brand, cast(amt as decimal(28,2)) as amount, n as units,
       {exact_mean('amt', 'n')} as per_unit
from cost join units on cost.c_nationkey = units.c_nationkey
"""


def line_costs(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_extendedprice")
    part = table(spark, folder, "part").select("p_partkey", "p_brand", "p_type")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    customer = table(spark, folder, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    return (
        lines.join(part, lines.l_partkey == part.p_partkey)
        .join(orders, lines.l_orderkey == orders.o_orderkey)
        .join(customer, orders.o_custkey == customer.c_custkey)
    )


def order_units(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_custkey")
    customer = table(spark, folder, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    return orders.join(customer, orders.o_custkey == customer.c_custkey)


@check("per_unit_ratio", PER_UNIT_SQL)
def per_unit_ratio(spark: SparkSession, folder: str) -> DataFrame:
    units = order_units(spark, folder).groupBy("c_nationkey").agg(F.count("*").alias("units"))
    cost = line_costs(spark, folder).groupBy("c_nationkey", "p_brand").agg(
        F.sum(money("l_extendedprice")).cast("decimal(28,2)").alias("amount")
    )
    per_unit = measures.ratio(F.col("amount"), F.col("units").cast("decimal(20,0)"))
    return cost.join(units, "c_nationkey").withColumn("per_unit", F.round(per_unit, 2).cast(MONEY))


RATIO_MART_SQL = f"""
with u as (select c_nationkey, c_mktsegment, count(*) n from orders join customer on o_custkey = c_custkey group by 1, 2),
c as (select c_nationkey, c_mktsegment, p_brand, sum(cast(l_extendedprice as decimal(18,2))) amt
      from lineitem join part on l_partkey = p_partkey join orders on l_orderkey = o_orderkey
      join customer on o_custkey = c_custkey group by 1, 2, 3),
u0 as (select c_nationkey, sum(n) n from u group by 1),
brand as (select c.c_nationkey, p_brand, 'TOTAL' as c_mktsegment, sum(amt) amt, max(n) n
          from c join u0 on c.c_nationkey = u0.c_nationkey group by 1, 2),
brand_seg as (select c.c_nationkey, p_brand, c.c_mktsegment, sum(amt) amt, max(n) n
              from c join u on c.c_nationkey = u.c_nationkey and c.c_mktsegment = u.c_mktsegment group by 1, 2, 3),
overall as (select c_nationkey, 'TOTAL' as p_brand, 'TOTAL' as c_mktsegment, sum(amt) amt, max(n) n from brand group by 1),
a as (select * from brand union select * from brand_seg union select * from overall)
select c_nationkey, p_brand, c_mktsegment, cast(amt as decimal(28,2)) as amount, cast(n as bigint) as units,
       {exact_mean('amt', 'n')} as per_unit
from a
"""


@check("ratio_mart", RATIO_MART_SQL)
def ratio_mart(spark: SparkSession, folder: str) -> DataFrame:
    units = aggregate.grouping_levels(
        order_units(spark, folder),
        ["c_nationkey"],
        ["c_mktsegment"],
        [["c_mktsegment"], []],
        {"units": ("sum", F.lit(1).cast("bigint"))},
    )
    costs = aggregate.grouping_levels(
        line_costs(spark, folder),
        ["c_nationkey"],
        ["p_brand", "c_mktsegment"],
        [["p_brand"], ["p_brand", "c_mktsegment"], []],
        {"amount": ("sum", money("l_extendedprice"))},
    )
    joined = aggregate.matched_units(costs, units, ["c_nationkey"], ["c_mktsegment"])
    per_unit = measures.ratio(F.col("amount"), F.col("units").cast("decimal(20,0)"))
    return joined.select(
        "c_nationkey",
        aggregate.labelled("p_brand"),
        aggregate.labelled("c_mktsegment"),
        F.col("amount").cast("decimal(28,2)").alias("amount"),
        "units",
        F.round(per_unit, 2).cast(MONEY).alias("per_unit"),
    ).distinct()


AGG_OF_AGG_SQL = """
with m as (select o_custkey, date_trunc('month', o_orderdate) mon, sum(cast(o_totalprice as decimal(18,2))) s, count(*) n
           from orders group by 1, 2)
select o_custkey, cast(sum(s) as decimal(28,2)) as total, max(n) as busiest from m group by 1
"""


@check("agg_of_agg", AGG_OF_AGG_SQL)
def agg_of_agg(spark: SparkSession, folder: str) -> DataFrame:
    monthly = (
        table(spark, folder, "orders")
        .groupBy("o_custkey", F.trunc("o_orderdate", "month").alias("mon"))
        .agg(F.sum(money("o_totalprice")).alias("s"), F.count("*").alias("n"))
    )
    return monthly.groupBy("o_custkey").agg(
        F.sum("s").cast("decimal(28,2)").alias("total"), F.max("n").alias("busiest")
    )


# --- single aggregates ---------------------------------------------------------


@check(
    "attribute_pivot",
    """
select user_id,
  max(case when event_type = 'signup' then cast(value as decimal(18,2)) end) as signup,
  max(case when event_type = 'purchase' then cast(value as decimal(18,2)) end) as purchase,
  max(case when event_type = 'error' then cast(value as decimal(18,2)) end) as error,
  max(case when event_type = 'click' then cast(value as decimal(18,2)) end) as click,
  max(case when event_type = 'view' then cast(value as decimal(18,2)) end) as "view"
from events group by user_id
""",
)
def attribute_pivot(spark: SparkSession, folder: str) -> DataFrame:
    kinds = ["signup", "purchase", "error", "click", "view"]
    return aggregate.attribute_pivot(
        table(spark, folder, "events"),
        ["user_id"],
        {k: F.when(F.col("event_type") == k, money("value")) for k in kinds},
    )


PRIORITIES_SQL = """
select o_custkey, string_agg(distinct o_orderpriority, '||' order by o_orderpriority) as priorities
from orders group by 1
"""


@check("listagg_distinct", PRIORITIES_SQL)
def listagg_distinct(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    return aggregate.joined_set_per_key(orders, ["o_custkey"], F.col("o_orderpriority"), "||", "priorities")


@check(
    "listagg_ordered",
    """
select o_custkey, string_agg(distinct o_orderstatus, ', ' order by o_orderstatus) as statuses,
       count(distinct o_orderstatus) as n_statuses
from orders group by 1
""",
)
def listagg_ordered(spark: SparkSession, folder: str) -> DataFrame:
    distinct = table(spark, folder, "orders").select("o_custkey", "o_orderstatus").distinct()
    return distinct.groupBy("o_custkey").agg(
        F.array_join(F.sort_array(F.collect_list("o_orderstatus")), ", ").alias("statuses"),
        F.count("o_orderstatus").alias("n_statuses"),
    )


@check(
    "listagg_cleanup",
    """
select doc_id, regexp_replace(trim(text, ' '), ' +', ' ', 'g') as squeezed,
       replace(trim(text, ' '), ' ', '') as stripped from documents
""",
)
def listagg_cleanup(spark: SparkSession, folder: str) -> DataFrame:
    trimmed = F.trim(F.col("text"))
    return table(spark, folder, "documents").select(
        "doc_id", text.squeeze(trimmed).alias("squeezed"), text.strip_blanks(trimmed).alias("stripped")
    )


@check(
    "array_agg_objects",
    """
with d as (select distinct l_orderkey, l_linenumber, l_returnflag, l_linestatus from lineitem)
select l_orderkey,
  '[' || string_agg('{"l_linenumber":' || l_linenumber || ',"l_returnflag":"' || l_returnflag || '","l_linestatus":"'
         || l_linestatus || '"}', ',' order by l_returnflag, l_linenumber, l_linestatus) || ']' as items
from d group by 1
""",
)
def array_agg_objects(spark: SparkSession, folder: str) -> DataFrame:
    return aggregate.objects_per_key(
        table(spark, folder, "lineitem"),
        ["l_orderkey"],
        ["l_linenumber", "l_returnflag", "l_linestatus"],
        ["l_returnflag"],
        "items",
    )


@check(
    "array_agg",
    """
select l_orderkey, string_agg(l_returnflag || '|' || l_linenumber, ',' order by l_returnflag, l_linenumber) as tags
from lineitem group by 1
""",
)
def array_agg(spark: SparkSession, folder: str) -> DataFrame:
    # repetitions stay, but travel as counts until the last step
    tag = F.struct("l_returnflag", "l_linenumber")
    counted = table(spark, folder, "lineitem").groupBy("l_orderkey", tag.alias("tag")).agg(F.count("*").alias("n"))
    texts = F.transform(
        F.sort_array(F.collect_list(F.struct("tag", "n"))),
        lambda e: F.transform(
            F.sequence(F.lit(1).cast("bigint"), e["n"]),
            lambda _: F.concat_ws("|", e["tag"]["l_returnflag"], e["tag"]["l_linenumber"].cast("string")),
        ),
    )
    return counted.groupBy("l_orderkey").agg(F.array_join(F.flatten(texts), ",").alias("tags"))


def supplier_parts(spark: SparkSession, folder: str) -> DataFrame:
    return (
        table(spark, folder, "lineitem")
        .groupBy("l_suppkey", "l_partkey")
        .agg(F.sum("l_quantity").cast("bigint").alias("qty"))
    )


PIVOT_SLOTS_SQL = """
with q as (select l_suppkey, l_partkey, cast(sum(l_quantity) as bigint) qty from lineitem group by 1, 2),
r as (select *, row_number() over (partition by l_suppkey order by qty desc, l_partkey) rn from q)
select l_suppkey, max(case when rn = 1 then l_partkey end) as part_1, max(case when rn = 2 then l_partkey end) as part_2,
       max(case when rn = 3 then l_partkey end) as part_3, max(case when rn = 4 then l_partkey end) as part_4
from r where rn <= 4 group by 1
"""


@check("pivot_slots", PIVOT_SLOTS_SQL)
def pivot_slots(spark: SparkSession, folder: str) -> DataFrame:
    order = [F.col("qty").desc(), F.col("l_partkey").asc()]
    ranked = versions.top_n_per_key(supplier_parts(spark, folder), ["l_suppkey"], order, 4)
    names = [f"part_{i}" for i in range(1, 5)]
    return aggregate.slots_pivot(ranked, ["l_suppkey"], "slot", F.col("l_partkey"), names)


@check(
    "count_concat",
    """
select l_returnflag, count(l_linestatus || cast(nullif(l_linenumber, 7) as varchar)) as n
from lineitem group by 1
""",
)
def count_concat(spark: SparkSession, folder: str) -> DataFrame:
    label = F.concat("l_linestatus", F.nullif(F.col("l_linenumber"), F.lit(7)).cast("string"))
    return table(spark, folder, "lineitem").groupBy("l_returnflag").agg(F.count(label).alias("n"))


@check(
    "conditional_count_pct",
    """
select l_linestatus, count(*) filter (where l_returnflag = 'A') as a_cnt,
  cast(round(cast(count(*) filter (where l_returnflag = 'A') as decimal(18,4)) / count(*) * 100, 3) as decimal(6,3)) as a_pct
from lineitem group by 1
""",
)
def conditional_count_pct(spark: SparkSession, folder: str) -> DataFrame:
    flagged = F.count_if(F.col("l_returnflag") == "A")
    counted = table(spark, folder, "lineitem").groupBy("l_linestatus").agg(
        flagged.alias("a"), F.count("*").alias("n")
    )
    whole = F.col("n").cast("decimal(20,0)")
    pct = (measures.ratio(F.col("a").cast("decimal(18,4)"), whole) * 100).cast("decimal(6,3)")
    return counted.select("l_linestatus", F.col("a").alias("a_cnt"), pct.alias("a_pct"))


@check(
    "avg_decimal",
    """
select l_returnflag, cast(round(sum(cast(l_quantity as decimal(18,0))) / count(l_quantity), 3) as decimal(6,3)) as avg_qty
from lineitem group by 1
""",
)
def avg_decimal(spark: SparkSession, folder: str) -> DataFrame:
    sums = table(spark, folder, "lineitem").groupBy("l_returnflag").agg(
        F.sum(F.col("l_quantity").cast("bigint")).alias("s"), F.count("l_quantity").alias("n")
    )
    return sums.select("l_returnflag", measures.mean_decimal(F.col("s"), F.col("n")).alias("avg_qty"))


@check(
    "weighted_avg",
    """
select l_returnflag,
  cast(round(cast(sum(case when l_linestatus <> 'O' then cast(l_discount as decimal(18,4)) else cast(l_tax as decimal(18,4)) end
      * cast(l_extendedprice as decimal(18,2))) as double)
      / cast(sum(cast(l_extendedprice as decimal(18,2))) as double), 6) as decimal(18,6)) as rate
from lineitem group by 1
""",
)
def weighted_avg(spark: SparkSession, folder: str) -> DataFrame:
    rate = F.when(F.col("l_linestatus") != "O", F.col("l_discount")).otherwise(F.col("l_tax")).cast("decimal(18,4)")
    sums = table(spark, folder, "lineitem").groupBy("l_returnflag").agg(
        F.sum(rate * money("l_extendedprice")).alias("weighted"), F.sum(money("l_extendedprice")).alias("weight")
    )
    mean = measures.ratio(F.col("weighted"), F.col("weight"))
    return sums.select("l_returnflag", F.round(mean, 6).cast("decimal(18,6)").alias("rate"))


@check(
    "group_by_json",
    """select '{"k":' || cast(json_extract(props, '$.k') as varchar) || '}' as doc, count(*) as n from events group by 1""",
)
def group_by_json(spark: SparkSession, folder: str) -> DataFrame:
    canonical = F.to_json(F.try_parse_json("props"))
    return table(spark, folder, "events").groupBy(canonical.alias("doc")).agg(F.count("*").alias("n"))


@check("distinct_rows", "select distinct l_returnflag, l_linestatus, l_linenumber from lineitem")
def distinct_rows(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber").distinct()


@check(
    "count_distinct",
    """
select o_orderstatus, count(distinct o_custkey) as customers, count(distinct o_orderdate) as days
from orders group by 1
""",
)
def count_distinct(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").groupBy("o_orderstatus").agg(
        F.count_distinct("o_custkey").alias("customers"), F.count_distinct("o_orderdate").alias("days")
    )


# --- windows, limits, sets -----------------------------------------------------


@check(
    "dedupe_latest",
    """
select o_custkey, o_orderkey, o_orderstatus from orders
qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey) = 1
""",
)
def dedupe_latest(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_orderstatus")
    newest = versions.newest_per_key(orders, ["o_custkey"], [F.col("o_orderdate").desc_nulls_first()])
    return newest.select("o_custkey", "o_orderkey", "o_orderstatus")


@check(
    "dedupe_after_group",
    """
with m as (select o_custkey, cast(date_trunc('month', o_orderdate) as date) mon,
                  cast(sum(cast(o_totalprice as decimal(18,2))) as decimal(28,2)) total from orders group by 1, 2)
select * from m qualify row_number() over (partition by o_custkey order by mon desc) = 1
""",
)
def dedupe_after_group(spark: SparkSession, folder: str) -> DataFrame:
    monthly = (
        table(spark, folder, "orders")
        .groupBy("o_custkey", F.trunc("o_orderdate", "month").alias("mon"))
        .agg(F.sum(money("o_totalprice")).cast("decimal(28,2)").alias("total"))
    )
    return versions.newest_per_key(monthly, ["o_custkey"], [F.col("mon").desc()])


@check(
    "top_n_per_key",
    """
with q as (select l_suppkey, l_partkey, cast(sum(l_quantity) as bigint) qty from lineitem group by 1, 2)
select l_suppkey, l_partkey, qty from q
qualify row_number() over (partition by l_suppkey order by qty desc, l_partkey) <= 4
""",
)
def top_n_per_key(spark: SparkSession, folder: str) -> DataFrame:
    order = [F.col("qty").desc(), F.col("l_partkey").asc()]
    return versions.top_n_per_key(supplier_parts(spark, folder), ["l_suppkey"], order, 4).drop("slot")


@check(
    "rank_for_pivot",
    """
with c as (select distinct l_orderkey, l_returnflag, l_linenumber from lineitem)
select l_orderkey, l_returnflag, l_linenumber,
       cast(row_number() over (partition by l_orderkey order by l_returnflag desc, l_linenumber) as int) as slot
from c qualify slot <= 5
""",
)
def rank_for_pivot(spark: SparkSession, folder: str) -> DataFrame:
    codes = table(spark, folder, "lineitem").select("l_orderkey", "l_returnflag", "l_linenumber").distinct()
    order = [F.col("l_returnflag").desc_nulls_first(), F.col("l_linenumber").asc_nulls_last()]
    return versions.top_n_per_key(codes, ["l_orderkey"], order, 5)


@check(
    "top_k",
    """
select l_partkey, cast(sum(cast(l_extendedprice as decimal(18,2))) as decimal(28,2)) as revenue
from lineitem group by 1 order by revenue desc, l_partkey limit 10
""",
)
def top_k(spark: SparkSession, folder: str) -> DataFrame:
    revenue = F.sum(money("l_extendedprice")).cast("decimal(28,2)").alias("revenue")
    totals = table(spark, folder, "lineitem").groupBy("l_partkey").agg(revenue)
    return totals.orderBy(F.col("revenue").desc(), "l_partkey").limit(10)


@check(
    "sorted_output",
    "select n_name, n_nationkey, n_regionkey from nation order by n_regionkey, n_name",
)
def sorted_output(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "nation").orderBy("n_regionkey", "n_name")


@check(
    "union_distinct",
    "select c_nationkey as nationkey from customer union select s_nationkey from supplier",
)
def union_distinct(spark: SparkSession, folder: str) -> DataFrame:
    customers = table(spark, folder, "customer").select(F.col("c_nationkey").alias("nationkey"))
    return aggregate.union_distinct(customers, table(spark, folder, "supplier").select("s_nationkey"))


@check(
    "minus_distinct",
    """
select cast(date_trunc('month', o_orderdate) as date) as mon from orders
except select cast(date_trunc('month', o_orderdate) as date) from orders where o_orderdate < timestamp '1998-01-01'
""",
)
def minus_distinct(spark: SparkSession, folder: str) -> DataFrame:
    months = table(spark, folder, "orders").select("o_orderdate", F.trunc("o_orderdate", "month").alias("mon"))
    return versions.new_slices(months, months.where("o_orderdate < timestamp_ntz'1998-01-01'"), "mon")
