"""Nested documents that Spark builds, one per row of a given table.

Arrays come from the row's own columns, so no rows are grouped to build them and
their sizes are bounded: absent, empty, one and many elements all occur.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.registry import table

# number of lines of an order document: its priority digit, absent for 'F', empty for 'P'
DIGIT = "cast(substr(o_orderpriority, 1, 1) as int)"

ORDER_DOC = f"""
to_json(named_struct(
  'id', concat('o', o_orderkey, '-', o_orderstatus), 'resourceType', 'Order',
  'meta', named_struct('versionId', '1', 'lastUpdated', date_format(o_orderdate, 'yyyy-MM-dd')),
  'identifier', array(
     named_struct('type', named_struct('coding', array(named_struct('code', 'CUST'))), 'value', cast(o_custkey as string)),
     named_struct('type', named_struct('coding', array(named_struct('code', 'PRI'))), 'value', o_orderpriority)),
  'line', case o_orderstatus when 'F' then null when 'P' then array()
          else transform(sequence(1, {DIGIT}), i -> named_struct(
             'no', i, 'ref', concat('Part/', o_custkey + i),
             'tags', transform(sequence(1, i), t -> concat('t', t)))) end,
  'site', transform(sequence(1, 1 + {DIGIT} div 3), s -> concat('s', s))
))
"""

ITEM_DOC = """
to_json(named_struct(
  'id', concat(l_orderkey, '-', l_linenumber),
  'extension', array(
    named_struct('url', 'http://x/part', 'valueInteger', l_partkey, 'valueCode', cast(null as string),
                 'valueCodeableConcept', null, 'extension', null),
    named_struct('url', 'http://x/qty', 'valueInteger', cast(l_quantity as bigint), 'valueCode', cast(null as string),
                 'valueCodeableConcept', null, 'extension', null),
    named_struct('url', if(l_returnflag = 'A', 'flag', 'other'), 'valueInteger', cast(null as bigint),
                 'valueCode', concat('outer-', l_returnflag), 'valueCodeableConcept', null,
                 'extension', array(named_struct('url', if(l_returnflag = 'N', 'flag', 'none'),
                                                 'valueCode', concat('inner-', l_linestatus)))),
    named_struct('url', 'http://x/marks', 'valueInteger', cast(null as bigint), 'valueCode', cast(null as string),
                 'valueCodeableConcept', named_struct('coding', array(
                     named_struct('system', 'http://x/flag', 'code', l_returnflag),
                     named_struct('system', 'http://x/status', 'code', l_linestatus))),
                 'extension', null))
))
"""

ORDER_SCHEMA = (
    "struct<id:string,identifier:array<struct<value:string,type:struct<coding:array<struct<code:string>>>>>,"
    "line:array<struct<no:int,ref:string,tags:array<string>>>,site:array<string>>"
)
ITEM_SCHEMA = (
    "struct<id:string,extension:array<struct<url:string,valueInteger:string,valueCode:string,"
    "valueCodeableConcept:struct<coding:array<struct<system:string,code:string>>>,"
    "extension:array<struct<url:string,valueCode:string>>>>>"
)


def order_docs(spark: SparkSession, folder: str) -> DataFrame:
    """`o_orderkey` and its JSON document."""
    return table(spark, folder, "orders").select("o_orderkey", F.expr(ORDER_DOC).alias("doc"))


def parsed_orders(spark: SparkSession, folder: str) -> DataFrame:
    return order_docs(spark, folder).select("o_orderkey", F.from_json("doc", ORDER_SCHEMA).alias("doc"))


def parsed_items(spark: SparkSession, folder: str) -> DataFrame:
    """Keys and parsed documents of all order lines."""
    docs = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", F.expr(ITEM_DOC).alias("doc"))
    return docs.select("l_orderkey", "l_linenumber", F.from_json("doc", ITEM_SCHEMA).alias("doc"))
