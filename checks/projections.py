"""Projections, filters and scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import documents
from checks.registry import check, table
from millrace.functions import nested, text
from millrace.operators import aggregate, projection, versions
from millrace.plans import resource_specs


@check(
    "json_path",
    "select event_id, cast(json_extract(props, '$.k') as bigint) as k, cast(null as varchar) as missing from events",
)
def json_path(spark: SparkSession, folder: str) -> DataFrame:
    doc = F.try_parse_json("props")
    return table(spark, folder, "events").select(
        "event_id",
        F.try_variant_get(doc, "$.k", "bigint").alias("k"),
        F.try_variant_get(doc, "$.a.b", "string").alias("missing"),
    )


@check(
    "json_index",
    """
with o as (select *, case when o_orderstatus = 'O' then cast(substr(o_orderpriority, 1, 1) as int) else 0 end as n from orders)
select o_orderkey, case when n >= 1 then 'Part/' || (o_custkey + 1) end as first_ref,
       case when n >= 3 then 'Part/' || (o_custkey + 3) end as third_ref,
       case when n >= 3 then 't2' end as third_second_tag
from o
""",
)
def json_index(spark: SparkSession, folder: str) -> DataFrame:
    doc = F.try_parse_json("doc")
    return documents.order_docs(spark, folder).select(
        "o_orderkey",
        F.try_variant_get(doc, "$.line[0].ref", "string").alias("first_ref"),
        F.try_variant_get(doc, "$.line[2].ref", "string").alias("third_ref"),
        F.try_variant_get(doc, "$.line[2].tags[1]", "string").alias("third_second_tag"),
    )


@check(
    "attribute_by_code",
    """
select l_orderkey, l_linenumber, cast(l_partkey as varchar) as part, cast(cast(l_quantity as bigint) as varchar) as qty,
       l_returnflag as flag, l_linestatus as status, '' as unmatched, cast(null as varchar) as unmatched_null
from lineitem
""",
)
def attribute_by_code(spark: SparkSession, folder: str) -> DataFrame:
    marks = nested.pairs(
        "doc.extension",
        "x",
        "x.valueCodeableConcept.coding",
        "c",
        nested.packed(kind=nested.tail("c.system"), code="c.code"),
    )
    items = documents.parsed_items(spark, folder).withColumn("marks", F.expr(marks))

    def by_url(tag: str, default: str | None = "") -> str:
        return nested.tagged("doc.extension", f"{nested.tail('e.url')} = '{tag}'", "e.valueInteger", default)

    columns = {
        "part": by_url("part"),
        "qty": by_url("qty"),
        "flag": nested.tagged("marks", "e.kind = 'flag'", "e.code", ""),
        "status": nested.tagged("marks", "e.kind = 'status'", "e.code", ""),
        "unmatched": by_url("nothing"),
        "unmatched_null": by_url("nothing", None),
    }
    return items.select("l_orderkey", "l_linenumber", *[F.expr(x).alias(n) for n, x in columns.items()])


@check(
    "attribute_fallback",
    """
select l_orderkey, l_linenumber, case l_returnflag when 'A' then 'outer-A' when 'N' then 'inner-' || l_linestatus else '' end as flag
from lineitem
""",
)
def attribute_fallback(spark: SparkSession, folder: str) -> DataFrame:
    levels = nested.pairs(
        "doc.extension", "x", "x.extension", "i", nested.packed(url="x.url", value="x.valueCode", inner="i")
    )
    flag = (
        "array_max(transform(levels, e -> case when e.url = 'flag' then e.value "
        "when e.inner.url = 'flag' then e.inner.valueCode else '' end))"
    )
    items = documents.parsed_items(spark, folder).withColumn("levels", F.expr(levels))
    return items.select("l_orderkey", "l_linenumber", F.expr(flag).alias("flag"))


@check(
    "path_segment",
    """
select page_id, split_part(url, '/', 3) as host, split_part(url, '/', 4) as lang, split_part(url, '/', -1) as last,
       split_part(url, '/', 9) as beyond from pages where split_part(url, '/', 4) <> 'xx'
""",
)
def path_segment(spark: SparkSession, folder: str) -> DataFrame:
    url = F.col("url")
    return (
        table(spark, folder, "pages")
        .where(text.segment(url, 4) != "xx")
        .select(
            "page_id",
            text.segment(url, 3).alias("host"),
            text.segment(url, 4).alias("lang"),
            text.tail(url).alias("last"),
            text.segment(url, 9).alias("beyond"),
        )
    )


@check(
    "code_set_filter",
    """
select o_orderkey, o_orderpriority, o_orderstatus from orders
where o_orderpriority in ('1-URGENT', '2-HIGH') and o_orderstatus not in ('F')
  and (nullif(o_orderstatus, 'P') is null or o_orderstatus not in ('F', 'X'))
""",
)
def code_set_filter(spark: SparkSession, folder: str) -> DataFrame:
    status = F.col("o_orderstatus")
    open_status = F.nullif(status, F.lit("P"))
    return (
        table(spark, folder, "orders")
        .where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))
        .where(~status.isin("F"))
        .where(open_status.isNull() | ~status.isin("F", "X"))
        .select("o_orderkey", "o_orderpriority", "o_orderstatus")
    )


@check(
    "like_exclude",
    "select p_partkey, p_name from part where p_name not like '%ring%' and nullif(p_type, 'PROMO') not like '%SMALL%'",
)
def like_exclude(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.nullif(F.col("p_type"), F.lit("PROMO"))
    return (
        table(spark, folder, "part")
        .where(~F.col("p_name").like("%ring%") & ~kind.like("%SMALL%"))
        .select("p_partkey", "p_name")
    )


@check(
    "active_flag",
    """
select o_orderkey, case when date '1998-06-01' between cast(o_orderdate as date)
         and case when o_orderstatus <> 'P' then cast(o_orderdate as date) + 365 end then 'A' else 'T' end as flag
from orders
""",
)
def active_flag(spark: SparkSession, folder: str) -> DataFrame:
    start = F.to_date("o_orderdate")
    end = F.when(F.col("o_orderstatus") != "P", F.date_add(start, 365))
    day = F.lit("1998-06-01").cast("date")
    return table(spark, folder, "orders").select("o_orderkey", text.active_flag(day, start, end).alias("flag"))


@check(
    "bool_to_flag",
    """
select doc_id, case when toxic = 1 then 'Y' when quality = 1 then 'N' end as flag from labels
""",
)
def bool_to_flag(spark: SparkSession, folder: str) -> DataFrame:
    answer = F.when(F.col("toxic") == 1, "true").when(F.col("quality") == 1, "false").otherwise("unknown")
    return table(spark, folder, "labels").select("doc_id", text.bool_flag(answer).alias("flag"))


@check(
    "null_default",
    """
select d.doc_id, coalesce(quality, -1) as quality, coalesce(nullif(lang, 'fr'), nullif(source, 'web'), 'none') as origin
from documents d left join labels l on d.doc_id = l.doc_id
""",
)
def null_default(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "lang", "source")
    labels = table(spark, folder, "labels").select("doc_id", "quality")
    origin = F.coalesce(F.nullif(F.col("lang"), F.lit("fr")), F.nullif(F.col("source"), F.lit("web")), F.lit("none"))
    return docs.join(labels, "doc_id", "left").select(
        "doc_id", F.coalesce("quality", F.lit(-1)).alias("quality"), origin.alias("origin")
    )


@check(
    "non_empty_filter",
    """
select doc_id, n_chars from documents
where text is not null and trim(text, ' ') <> '' and nullif(lang, 'en') is not null and lang <> ''
""",
)
def non_empty_filter(spark: SparkSession, folder: str) -> DataFrame:
    lang = F.nullif(F.col("lang"), F.lit("en"))
    return (
        table(spark, folder, "documents")
        .where(text.filled(F.col("text")) & (F.length(lang) > 0))
        .select("doc_id", "n_chars")
    )


@check(
    "split_to_columns",
    """
select p_partkey, substr(split_part(p_name, ' ', 1), 1, 4) as word_1, substr(split_part(p_name, ' ', 2), 1, 4) as word_2,
       substr(split_part(p_name, ' ', 3), 1, 4) as word_3 from part
""",
)
def split_to_columns(spark: SparkSession, folder: str) -> DataFrame:
    words = text.pieces(F.col("p_name"), " ", ["word_1", "word_2", "word_3"], 4)
    return table(spark, folder, "part").select("p_partkey", *words)


@check(
    "fixed_slots_concat",
    """
with o as (select *, case when o_orderstatus = 'O' then cast(substr(o_orderpriority, 1, 1) as int) else 0 end as n from orders)
select o_orderkey, case when n >= 1 then '1 t1' else ' ' end || chr(10) || case when n >= 2 then '2 t1' else ' ' end
  || chr(10) || case when n >= 3 then '3 t1' else ' ' end || chr(10) || case when n >= 4 then '4 t1' else ' ' end
  || chr(10) || case when n >= 5 then '5 t1' else ' ' end || chr(10) || ' ' || chr(10) || ' ' as slots
from o
""",
)
def fixed_slots_concat(spark: SparkSession, folder: str) -> DataFrame:
    slots = [
        f"if(get(doc.line, {i}) is not null, concat(get(doc.line, {i}).no, ' ', get(get(doc.line, {i}).tags, 0)), ' ')"
        for i in range(7)
    ]
    joined = resource_specs.with_separator(slots, "\n")
    return documents.parsed_orders(spark, folder).select("o_orderkey", F.expr(joined).alias("slots"))


@check(
    "fixed_slots_concat_strict",
    """
select o_orderkey, case when o_orderstatus = 'O' and cast(substr(o_orderpriority, 1, 1) as int) >= 3
   then '1:Part/' || (o_custkey + 1) || ',2:Part/' || (o_custkey + 2) || ',3:Part/' || (o_custkey + 3) end as slots
from orders
""",
)
def fixed_slots_concat_strict(spark: SparkSession, folder: str) -> DataFrame:
    slots = [f"concat(get(doc.line, {i}).no, ':', get(doc.line, {i}).ref)" for i in range(3)]
    joined = resource_specs.with_separator(slots, ",")
    return documents.parsed_orders(spark, folder).select("o_orderkey", F.expr(joined).alias("slots"))


@check(
    "layout_pad",
    """
select 'C' as kind, c_custkey as key, c_name as name, c_mktsegment as segment, c_acctbal as balance, c_nationkey as nationkey
from customer union all
select 'S', s_suppkey, s_name, ' ', s_acctbal, s_nationkey from supplier
""",
)
def layout_pad(spark: SparkSession, folder: str) -> DataFrame:
    layout = ["kind", "key", "name", "segment", "balance", "nationkey"]
    people = table(spark, folder, "customer").toDF("key", "name", "nationkey", "balance", "segment")
    firms = table(spark, folder, "supplier").toDF("key", "name", "nationkey", "balance")
    padded = projection.padded_layout(firms, layout, {"kind": "S", "segment": " "})
    return projection.padded_layout(people, layout, {"kind": "C"}).unionByName(padded)


@check(
    "positional_rename",
    """
with m as (select o_custkey, o_orderpriority, max(cast(o_totalprice as decimal(18,2))) as p from orders group by 1, 2)
select o_custkey as customer, max(case when o_orderpriority = '1-URGENT' then p end) as slot_1,
       max(case when o_orderpriority = '2-HIGH' then p end) as slot_2,
       max(case when o_orderpriority = '3-MEDIUM' then p end) as slot_3
from m group by 1
""",
)
def positional_rename(spark: SparkSession, folder: str) -> DataFrame:
    price = F.col("o_totalprice").cast("decimal(18,2)")
    pivoted = (
        table(spark, folder, "orders")
        .groupBy("o_custkey")
        .pivot("o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM"])
        .agg(F.max(price))
    )
    return pivoted.toDF("customer", "slot_1", "slot_2", "slot_3")


@check(
    "conditional_update",
    """
select c_custkey, case when c_mktsegment = 'BUILDING'
    and (select count(*) from orders where o_orderstatus = 'X') = 0 then 'CLOSED' else c_mktsegment end as c_mktsegment
from customer
""",
)
def conditional_update(spark: SparkSession, folder: str) -> DataFrame:
    waiting = table(spark, folder, "orders").where("o_orderstatus = 'X'").agg(F.count("*").alias("n"))
    where = (F.col("c_mktsegment") == "BUILDING") & (waiting.scalar() == 0)
    customer = table(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    return projection.conditional_update(customer, "c_mktsegment", F.lit("CLOSED"), where)


@check(
    "renamed_extract",
    """select c_custkey as "Customer Key", c_name, c_nationkey as nation, c_acctbal, c_mktsegment as "Market Segment" from customer""",
)
def renamed_extract(spark: SparkSession, folder: str) -> DataFrame:
    names = {"c_custkey": "Customer Key", "c_nationkey": "nation", "c_mktsegment": "Market Segment", "c_name": "c_name"}
    return projection.renamed_extract(table(spark, folder, "customer"), names)


# --- scalar function families ----------------------------------------------------


@check(
    "scalar_string",
    """
select p_partkey, upper(p_name) as up, lower(p_type) as low, replace(p_name, ' ', '_') as replaced,
       regexp_replace(p_name, '[aeiou]+', '*', 'g') as masked, substr(p_brand, 7) as brand_no, length(p_name) as len,
       concat(p_brand, '-', p_type) as label, p_brand || p_type as both, trim(' ' || p_type || ' ') as trimmed,
       split_part('a||b||' || p_type, '||', 3) as third from part
""",
)
def scalar_string(spark: SparkSession, folder: str) -> DataFrame:
    name, brand, kind = F.col("p_name"), F.col("p_brand"), F.col("p_type")
    return table(spark, folder, "part").select(
        "p_partkey",
        F.upper(name).alias("up"),
        F.lower(kind).alias("low"),
        F.replace(name, F.lit(" "), F.lit("_")).alias("replaced"),
        F.regexp_replace(name, "[aeiou]+", "*").alias("masked"),
        F.substring(brand, 7, 100).alias("brand_no"),
        F.length(name).cast("bigint").alias("len"),
        F.concat(brand, F.lit("-"), kind).alias("label"),
        F.concat(brand, kind).alias("both"),
        F.trim(F.concat(F.lit(" "), kind, F.lit(" "))).alias("trimmed"),
        F.get(text.literal_split(F.concat(F.lit("a||b||"), kind), "||"), F.lit(2)).alias("third"),
    )


@check(
    "scalar_date",
    """
select o_orderkey, cast(o_orderdate as date) as day, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') as text,
       date_diff('second', timestamp '1995-01-01', o_orderdate) as seconds, cast(null as date) as junk,
       date_add(cast(o_orderdate as date), interval 0 day)::date as parsed
from orders
""",
)
def scalar_date(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        "o_orderkey",
        F.to_date("o_orderdate").alias("day"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("text"),
        F.expr("timestampdiff(SECOND, timestamp_ntz'1995-01-01', o_orderdate)").alias("seconds"),
        F.expr("try_to_date(concat('x', o_orderstatus))").alias("junk"),
        F.expr("try_to_date(date_format(o_orderdate, \"yyyy-MM-dd'T'HH:mm:ss'Z'\"))").alias("parsed"),
    )


@check(
    "scalar_null_math",
    """
select l_orderkey, l_linenumber, l_partkey, nullif(l_linenumber, 1) as not_first, coalesce(nullif(l_returnflag, 'N'), '-') as flag,
       l_linenumber between 2 and 4 as middle, cast(round(cast(l_tax as decimal(10,4)) * 100, 2) as decimal(10,2)) as tax_pct,
       case when l_linenumber > 5 then 'late' when l_linenumber in (1, 2) then 'early' else 'mid' end as place
from lineitem
""",
)
def scalar_null_math(spark: SparkSession, folder: str) -> DataFrame:
    line = F.col("l_linenumber")
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.nullif(line, F.lit(1)).alias("not_first"),
        F.coalesce(F.nullif(F.col("l_returnflag"), F.lit("N")), F.lit("-")).alias("flag"),
        line.between(2, 4).alias("middle"),
        F.round(F.col("l_tax").cast("decimal(10,4)") * 100, 2).cast("decimal(10,2)").alias("tax_pct"),
        F.when(line > 5, "late").when(line.isin(1, 2), "early").otherwise("mid").alias("place"),
    )


@check(
    "version_order",
    """
with v as (select o_custkey, o_orderkey, cast(cast(substr(o_orderpriority, 1, 1) as int) * 3 as varchar) as version from orders)
select o_custkey, version, o_orderkey from v
qualify row_number() over (partition by o_custkey order by cast(version as int) desc, o_orderkey) = 1
""",
)
def version_order(spark: SparkSession, folder: str) -> DataFrame:
    version = (F.substring("o_orderpriority", 1, 1).cast("int") * 3).cast("string").alias("version")
    orders = table(spark, folder, "orders").select("o_custkey", "o_orderkey", version)
    return versions.newest_per_key(orders, ["o_custkey"], versions.version_order(F.col("version"))).select(
        "o_custkey", "version", "o_orderkey"
    )


@check(
    "listagg_empty",
    """
select c_custkey, coalesce((select string_agg(distinct o_orderpriority, ',' order by o_orderpriority) from orders
   where o_custkey = c_custkey and o_orderstatus = 'P'), '') as pending
from customer
""",
)
def listagg_empty(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").where("o_orderstatus = 'P'")
    sets = aggregate.joined_set_per_key(orders, ["o_custkey"], F.col("o_orderpriority"), ",", "pending")
    customer = table(spark, folder, "customer").select(F.col("c_custkey").alias("o_custkey"))
    return customer.join(sets, "o_custkey", "left").select(
        F.col("o_custkey").alias("c_custkey"), F.coalesce("pending", F.lit("")).alias("pending")
    )
