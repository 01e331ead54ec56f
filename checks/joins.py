"""Joins on the order tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.registry import check, table
from millrace.operators import joins, versions
from millrace.plans import extract


@check(
    "join_inner_multi",
    """
with a as (select l_partkey, l_suppkey, l_linenumber, count(*) as n_a from lineitem where l_returnflag <> 'N' group by 1, 2, 3),
b as (select l_partkey, l_suppkey, l_linenumber, count(*) as n_b from lineitem where l_returnflag = 'N' group by 1, 2, 3)
select * from a join b using (l_partkey, l_suppkey, l_linenumber)
""",
)
def join_inner_multi(spark: SparkSession, folder: str) -> DataFrame:
    keys = ["l_partkey", "l_suppkey", "l_linenumber"]
    lines = table(spark, folder, "lineitem")

    def counted(side: Column, name: str) -> DataFrame:
        return lines.where(side).groupBy(*keys).agg(F.count("*").alias(name))

    open_line = F.col("l_returnflag") == "N"
    return counted(~open_line, "n_a").join(counted(open_line, "n_b"), keys)


@check(
    "join_implicit",
    """
select l_orderkey, l_linenumber, o_orderstatus, l_partkey from lineitem, orders
where l_orderkey = o_orderkey and o_orderstatus = l_linestatus
""",
)
def join_implicit(spark: SparkSession, folder: str) -> DataFrame:
    lines, orders = table(spark, folder, "lineitem"), table(spark, folder, "orders")
    same = (lines.l_orderkey == orders.o_orderkey) & (orders.o_orderstatus == lines.l_linestatus)
    return lines.join(orders, same).select("l_orderkey", "l_linenumber", "o_orderstatus", "l_partkey")


@check(
    "join_latest",
    """
select o_custkey, o_orderkey, cast(o_orderdate as date) as day from orders
qualify o_orderdate = max(o_orderdate) over (partition by o_custkey)
""",
)
def join_latest(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    newest = versions.latest_versions(orders, ["o_custkey"], "o_orderdate")
    return newest.select("o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("day"))


@check(
    "join_star_left",
    """
select l_orderkey, l_linenumber, l_partkey, o_orderstatus, c_mktsegment, p_brand, s_name, n_name
from lineitem join orders on l_orderkey = o_orderkey
left join customer on o_custkey = c_custkey left join part on l_partkey = p_partkey
left join supplier on l_suppkey = s_suppkey left join nation on s_nationkey = n_nationkey
""",
)
def join_star_left(spark: SparkSession, folder: str) -> DataFrame:
    def dim(name: str, **columns: str) -> DataFrame:
        return table(spark, folder, name).select(*[F.col(old).alias(new) for new, old in columns.items()])

    fact = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    orders = dim("orders", l_orderkey="o_orderkey", o_custkey="o_custkey", o_orderstatus="o_orderstatus")
    wide = joins.star_left(
        fact.join(orders, "l_orderkey"),
        [
            (dim("customer", o_custkey="c_custkey", c_mktsegment="c_mktsegment"), ["o_custkey"]),
            (dim("part", l_partkey="p_partkey", p_brand="p_brand"), ["l_partkey"]),
            (dim("supplier", l_suppkey="s_suppkey", s_name="s_name", s_nationkey="s_nationkey"), ["l_suppkey"]),
            (dim("nation", s_nationkey="n_nationkey", n_name="n_name"), ["s_nationkey"]),
        ],
    )
    return wide.drop("o_custkey", "l_suppkey", "s_nationkey")


@check(
    "join_distinct_dim",
    """
select c_custkey, n.s_nationkey as supplied from customer
left join (select distinct s_nationkey from supplier) n on c_nationkey = n.s_nationkey
""",
)
def join_distinct_dim(spark: SparkSession, folder: str) -> DataFrame:
    customer = table(spark, folder, "customer")
    supplied = joins.distinct_dim(table(spark, folder, "supplier"), {"s_nationkey": "supplied"})
    return customer.join(supplied, customer.c_nationkey == supplied.supplied, "left").select("c_custkey", "supplied")


@check(
    "join_role_playing",
    """
select l_orderkey, l_linenumber, l_partkey, cn.n_name as customer_nation, sn.n_name as supplier_nation
from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
join supplier on l_suppkey = s_suppkey
left join nation cn on c_nationkey = cn.n_nationkey left join nation sn on s_nationkey = sn.n_nationkey
""",
)
def join_role_playing(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    customer = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    supplier = table(spark, folder, "supplier").select("s_suppkey", "s_nationkey")
    fact = (
        lines.join(orders, lines.l_orderkey == orders.o_orderkey)
        .join(customer, F.col("o_custkey") == customer.c_custkey)
        .join(supplier, F.col("l_suppkey") == supplier.s_suppkey)
    )
    named = joins.role_playing(
        fact,
        table(spark, folder, "nation"),
        "n_nationkey",
        "n_name",
        {"c_nationkey": "customer_nation", "s_nationkey": "supplier_nation"},
    )
    return named.select("l_orderkey", "l_linenumber", "l_partkey", "customer_nation", "supplier_nation")


@check(
    "join_expr_key",
    """
with p as (select distinct o_orderpriority, substr(o_orderpriority, 1, 1) as digit from orders)
select l_orderkey, l_linenumber, l_partkey, o_orderpriority from lineitem
left join p on cast(l_linenumber as varchar) = digit
""",
)
def join_expr_key(spark: SparkSession, folder: str) -> DataFrame:
    digit = F.substring("o_orderpriority", 1, 1).cast("int").alias("l_linenumber")
    priorities = table(spark, folder, "orders").select("o_orderpriority", digit).distinct()
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return lines.join(priorities, "l_linenumber", "left")


@check(
    "join_full_outer",
    """
with c as (select c_nationkey as nationkey, floor(c_acctbal / 100)::bigint as level, count(*) as customers from customer group by 1, 2),
s as (select s_nationkey as nationkey, floor(s_acctbal / 100)::bigint as level, count(*) as suppliers from supplier group by 1, 2)
select coalesce(c.nationkey, s.nationkey) as nationkey, coalesce(c.level, s.level) as level, customers, suppliers
from c full join s on c.nationkey = s.nationkey and c.level = s.level
""",
)
def join_full_outer(spark: SparkSession, folder: str) -> DataFrame:
    def counted(name: str, letter: str) -> DataFrame:
        keys = F.col(f"{letter}_nationkey").alias("nationkey"), F.floor(F.col(f"{letter}_acctbal") / 100).alias("level")
        return table(spark, folder, name).groupBy(*keys).agg(F.count("*").alias(f"{name}s"))

    return joins.full_merge(counted("customer", "c"), counted("supplier", "s"), ["nationkey", "level"])


@check(
    "semi_in_subquery",
    """
select o_orderkey, o_orderstatus from orders
where o_orderkey in (select l_orderkey from lineitem where l_returnflag = 'R')
""",
)
def semi_in_subquery(spark: SparkSession, folder: str) -> DataFrame:
    returned = table(spark, folder, "lineitem").where("l_returnflag = 'R'")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    return orders.join(returned, orders.o_orderkey == returned.l_orderkey, "left_semi")


GATE_SQL = """
with m as (select *, cast(date_trunc('month', o_orderdate) as date) as mon from orders)
select o_orderkey, mon from m
where mon in (select mon from m except select mon from m where o_orderstatus = 'F' and mon < date '2000-01-01')
"""


@check("gate_new_slices", GATE_SQL)
def gate_new_slices(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").withColumn("mon", F.trunc("o_orderdate", "month"))
    loaded = orders.where("o_orderstatus = 'F' and mon < date'2000-01-01'")
    return versions.gate_new_slices(orders, loaded, "mon").select("o_orderkey", "mon")


@check(
    "anti_by_key",
    """
select c_custkey, c_name from customer
where c_custkey not in (select o_custkey from orders where o_orderpriority = '1-URGENT')
""",
)
def anti_by_key(spark: SparkSession, folder: str) -> DataFrame:
    customer = table(spark, folder, "customer").select("c_custkey", "c_name")
    key = F.col("c_custkey").cast("string").alias("key")
    urgent = table(spark, folder, "orders").where("o_orderpriority = '1-URGENT'")
    batch = urgent.select(F.concat(F.lit(" "), F.col("o_custkey").cast("string")).alias("key"))
    return versions.without_keys(customer.select("*", key), batch, ["key"]).drop("key")


@check(
    "join_dictionary",
    """
with c(column_name, ordinal_position) as (values ('c_custkey', 1), ('c_name', 2), ('c_nationkey', 3), ('c_acctbal', 4),
  ('c_mktsegment', 5)),
d(column_name, field_desc) as (select 'c_mktsegment', max('Segment ' || c_mktsegment) from customer)
select 'customer' as table_name, c.column_name, c.ordinal_position, coalesce(d.field_desc, c.column_name) as column_alias
from c left join d on c.column_name = d.column_name
""",
)
def join_dictionary(spark: SparkSession, folder: str) -> DataFrame:
    customer = table(spark, folder, "customer")
    dictionary = customer.agg(F.max(F.concat(F.lit("Segment "), "c_mktsegment")).alias("field_desc")).select(
        F.lit("customer").alias("table_name"), F.lit("c_mktsegment").alias("extract_field_name"), "field_desc"
    )
    return extract.column_aliases(extract.column_list(spark, {"customer": customer}), dictionary)


@check(
    "join_hot_keys",
    """
with f as (
  select l_orderkey, l_linenumber, case when l_linenumber in (1, 2) then null when l_linenumber = 3 then 1 else l_suppkey end as s_suppkey
  from lineitem
)
select f.l_orderkey, f.l_linenumber, f.s_suppkey, s_name, n_name from f left join supplier using (s_suppkey)
join (select n_nationkey, n_name from nation union all select null, 'none') n on n.n_nationkey is not distinct from s_nationkey
""",
)
def join_hot_keys(spark: SparkSession, folder: str) -> DataFrame:
    """A third of the rows have no key and one supplier has a hot one; then the missing nations match a row of their own."""
    number = F.col("l_linenumber")
    key = F.when(number.isin(1, 2), None).when(number == 3, 1).otherwise(F.col("l_suppkey"))
    fact = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", key.alias("s_suppkey"))
    supplier = table(spark, folder, "supplier").select("s_suppkey", "s_name", F.col("s_nationkey").alias("n_nationkey"))
    nation = table(spark, folder, "nation").select("n_nationkey", "n_name")
    nation = nation.unionByName(spark.createDataFrame([(None, "none")], nation.schema))
    placed = joins.spread_join(fact, supplier, ["s_suppkey"])
    return joins.spread_join(placed, nation, ["n_nationkey"], "inner", null_safe=True).drop("n_nationkey")
