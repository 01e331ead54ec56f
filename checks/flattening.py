"""Nested arrays to rows, checked against the relational tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import documents
from checks.registry import check, table
from millrace.functions import nested, text
from millrace.operators import flatten

# SQL: number of lines of an order document (see checks.documents)
LINES = "case when o_orderstatus = 'O' then cast(substr(o_orderpriority, 1, 1) as int) else 0 end"


@check(
    "flatten_outer",
    f"""
select o_orderkey, cast(i - 1 as int) as pos, cast(i as int) as no, 'Part/' || (o_custkey + i) as ref
from (select *, unnest(range(1, {LINES} + 1)) as i from orders)
union all select o_orderkey, null, null, null from orders where {LINES} = 0
""",
)
def flatten_outer(spark: SparkSession, folder: str) -> DataFrame:
    rows = flatten.flatten_outer(documents.parsed_orders(spark, folder), F.col("doc.line"), "line", "pos")
    return rows.select("o_orderkey", "pos", "line.no", "line.ref")


@check(
    "flatten_chain",
    f"""
with l as (select o_orderkey, unnest(range(1, {LINES} + 1)) as i from orders),
t as (select o_orderkey, i, unnest(range(1, i + 1)) as t from l)
select o_orderkey, cast(i as int) as no, 't' || t as tag from t
union all select o_orderkey, null, null from orders where {LINES} = 0
""",
)
def flatten_chain(spark: SparkSession, folder: str) -> DataFrame:
    steps = {"line": F.col("doc.line"), "tag": F.col("line.tags")}
    return flatten.flatten_chain(documents.parsed_orders(spark, folder), steps).select("o_orderkey", "line.no", "tag")


@check(
    "flatten_siblings",
    f"""
with o as (select *, {LINES} as n, 1 + cast(substr(o_orderpriority, 1, 1) as int) // 3 as sites from orders)
select o_orderkey, o_orderpriority as priority, cast(o_custkey as varchar) as customer,
       case when n > 0 then 'Part/' || cast(list_max([cast(o_custkey + j as varchar) for j in range(1, n + 1)]) as varchar) end as max_ref,
       cast(case when n > 0 then n end as int) as max_no,
       list_aggregate([cast('s' || j as varchar) for j in range(1, sites + 1)], 'string_agg', '||') as sites
from o
""",
)
def flatten_siblings(spark: SparkSession, folder: str) -> DataFrame:
    """Three independent arrays folded one by one; side by side they would be a product."""
    ids = nested.pairs(
        "doc.identifier", "i", "i.type.coding", "c", nested.packed(code="c.code", value="i.value")
    )
    docs = documents.parsed_orders(spark, folder).withColumn("ids", F.expr(ids))
    lines = nested.elements("doc.line")
    columns = {
        "priority": nested.tagged("ids", "e.code = 'PRI'", "e.value", ""),
        "customer": nested.tagged("ids", "e.code = 'CUST'", "e.value", ""),
        "max_ref": nested.best(lines, "e.ref"),
        "max_no": nested.best(lines, "e.no"),
        "sites": nested.joined_set(nested.elements("doc.site"), "||"),
    }
    return docs.select("o_orderkey", *[F.expr(x).alias(n) for n, x in columns.items()])


@check(
    "flatten_bundle",
    """
with e as (select c_custkey, c_mktsegment, unnest(range(0, 1 + c_nationkey // 6)) as j from customer),
t as (select *, unnest(range(1, j + 2)) as t from e)
select c_custkey, 'r' || c_custkey || '-' || j as id, c_mktsegment as name, 'v' || t as tag from t
""",
)
def flatten_bundle(spark: SparkSession, folder: str) -> DataFrame:
    doc = """to_json(named_struct('resourceType', 'Bundle', 'entry', transform(sequence(0, c_nationkey div 6),
      j -> named_struct('resource', named_struct('id', concat('r', c_custkey, '-', j), 'name', c_mktsegment,
        'tags', transform(sequence(1, j + 1), t -> concat('v', t)))))))"""
    schema = "struct<entry:array<struct<resource:struct<id:string,name:string,tags:array<string>>>>>"
    bundles = table(spark, folder, "customer").select("c_custkey", F.from_json(F.expr(doc), schema).alias("doc"))
    entries = flatten.flatten_outer(bundles, F.col("doc.entry"), "entry")
    rows = flatten.flatten_outer(entries, F.col("entry.resource.tags"), "tag")
    return rows.select("c_custkey", "entry.resource.id", "entry.resource.name", "tag")


@check(
    "flatten_top_n",
    f"""
select o_orderkey, cast(i as int) as no from (select *, unnest(range(1, least({LINES}, 3) + 1)) as i from orders)
""",
)
def flatten_top_n(spark: SparkSession, folder: str) -> DataFrame:
    rows = flatten.flatten_first(documents.parsed_orders(spark, folder), F.col("doc.line"), "line", 2)
    return rows.select("o_orderkey", "line.no")


@check(
    "flatten_filter",
    "select o_orderkey, o_orderpriority as priority from orders where o_orderpriority <> '5-LOW'",
)
def flatten_filter(spark: SparkSession, folder: str) -> DataFrame:
    def wanted(e):
        return (F.get(e["type"]["coding"], F.lit(0))["code"] == "PRI") & (e["value"] != "5-LOW")

    docs = documents.parsed_orders(spark, folder)
    rows = flatten.flatten_matching(docs, F.col("doc.identifier"), "entry", wanted)
    return rows.select("o_orderkey", F.col("entry.value").alias("priority"))


@check(
    "flatten_split_string",
    f"""
with r as (select distinct o_orderkey, 'Part/' || (o_custkey + i) as ref
           from (select *, unnest(range(1, {LINES} + 1)) as i from orders))
select o_orderkey, ref from r union all select o_orderkey, '' from orders where {LINES} = 0
""",
)
def flatten_split_string(spark: SparkSession, folder: str) -> DataFrame:
    refs = F.transform(F.col("doc.line"), lambda line: line["ref"])
    docs = documents.parsed_orders(spark, folder)
    return flatten.flatten_set(docs, F.coalesce(refs, F.array().cast("array<string>")), "ref").select(
        "o_orderkey", "ref"
    )


@check(
    "flatten_aggregated",
    f"""
select o_orderkey, cast(i as varchar) as code, 't' || t as label from
 (select *, unnest(range(1, i + 1)) as t from (select *, unnest(range(1, {LINES} + 1)) as i from orders))
""",
)
def flatten_aggregated(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs packed as `code|label` and taken apart again, repetitions kept."""
    packed = F.flatten(
        F.transform(
            F.col("doc.line"),
            lambda line: F.transform(
                line["tags"], lambda t: F.concat(line["no"].cast("string"), F.lit("|"), t)
            ),
        )
    )
    rows = documents.parsed_orders(spark, folder).select("o_orderkey", F.explode(packed).alias("entry"))
    parts = text.literal_split(F.col("entry"), "|")
    return rows.select("o_orderkey", F.get(parts, F.lit(0)).alias("code"), F.get(parts, F.lit(1)).alias("label"))


@check(
    "strtok_explode",
    """
with t as (select p_partkey, unnest(string_split_regex(p_brand || '|:' || p_type || '::' || p_name, '[|:#]')) as token from part)
select distinct p_partkey, split_part(token, ' ', 1) as code, split_part(token, ' ', 2) as flag from t where token <> ''
""",
)
def strtok_explode(spark: SparkSession, folder: str) -> DataFrame:
    listed = F.concat("p_brand", F.lit("|:"), "p_type", F.lit("::"), "p_name")
    rows = flatten.flatten_tokens(table(spark, folder, "part"), listed, "|:#", "token")
    token = F.col("token")
    return rows.select(
        "p_partkey", text.segment(token, 1, " ").alias("code"), text.segment(token, 2, " ").alias("flag")
    ).distinct()
