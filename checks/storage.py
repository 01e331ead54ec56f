"""Reading and writing files and tables, with audits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.registry import check, table
from millrace import session
from millrace.functions import text
from millrace.plans import archive, extract, feedback
from millrace.sources import delimited, keyed, ndjson, tables
from millrace.streaming import incremental, partials

DAY = "2024-03-01"


def day(value: str = DAY):
    return F.lit(value).cast("date")


# --- newline-delimited JSON ------------------------------------------------------

# lines of 'error' events are cut short, lines of 'view' events lack the id
EVENT_LINE = """
case event_type when 'error' then concat('{"id":"', event_id)
  when 'view' then to_json(named_struct('resourceType', event_type, 'k', get_json_object(props, '$.k')))
  else to_json(named_struct('id', cast(event_id as string), 'resourceType', event_type,
                            'k', get_json_object(props, '$.k'))) end
"""
EVENTS_SQL = f"""
select 'event_type=' || event_type as folder, event_type as file_resource_type,
       case when event_type = 'view' then ' ' else cast(event_id as varchar) end as file_record_id,
       cast(json_extract_string(props, '$.k') as varchar) as k, date '{DAY}' as load_dt
from events where event_type <> 'error'
"""


def event_lines(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(F.expr(EVENT_LINE).alias("value"), "event_type")


def ingested_columns(raw: DataFrame) -> DataFrame:
    return raw.select(
        text.segment(F.col("file_name"), 1).alias("folder"),
        "file_resource_type",
        "file_record_id",
        F.get_json_object("file_content_raw", "$.k").alias("k"),
        "load_dt",
    )


@check("ingest_ndjson", EVENTS_SQL)
def ingest_ndjson(spark: SparkSession, folder: str) -> DataFrame:
    root = session.scratch_path(spark, "events-in")
    event_lines(spark, folder).write.partitionBy("event_type").text(root)
    raw = ndjson.ingest(spark, root, pattern="*.txt", load_date=day(), line_numbers=False)
    return ingested_columns(raw)


# one file per type, every line says its own number; 'error' lines are cut short but count
NUMBERED_LINE = """
if(event_type = 'error', concat('{"id":"', event_id),
   to_json(named_struct('id', cast(event_id as string), 'resourceType', event_type, 'n', n)))
"""


@check(
    "ingest_line_numbers",
    """
with e as (select *, row_number() over (partition by event_type order by event_id) as n from events),
f as (select event_type, count(*) as n_lines from e group by 1)
select 'event_type=' || event_type as folder, event_type as file_resource_type, event_id::varchar as file_record_id, n as said,
  n as file_row_number, true as dated, true as scanned, 1 as n_keys, n_lines
from e join f using (event_type) where event_type <> 'error'
""",
)
def ingest_line_numbers(spark: SparkSession, folder: str) -> DataFrame:
    """All columns of the raw layout: each line's number against the one it says, one content key for each file."""
    root = session.scratch_path(spark, "events-in")
    place = Window.partitionBy("event_type").orderBy("event_id")
    events = table(spark, folder, "events").withColumn("n", F.row_number().over(place))
    lines = events.repartition("event_type").sortWithinPartitions("event_type", "n")
    lines.select(F.expr(NUMBERED_LINE).alias("value"), "event_type").write.partitionBy("event_type").text(root)
    raw = ndjson.ingest(spark, root, pattern="*.txt", load_date=day())
    sizes = events.groupBy("event_type").agg(F.count("*").alias("n_lines"))
    keys = raw.groupBy("file_resource_type").agg(F.count_distinct("file_content_key").cast("int").alias("n_keys"))
    return raw.join(keys, "file_resource_type").join(sizes, F.col("file_resource_type") == F.col("event_type")).select(
        text.segment(F.col("file_name"), 1).alias("folder"),
        "file_resource_type",
        "file_record_id",
        F.get_json_object("file_content_raw", "$.n").cast("bigint").alias("said"),
        "file_row_number",
        (F.col("file_last_modified") <= F.current_timestamp()).alias("dated"),
        F.col("start_scan_time").isNotNull().alias("scanned"),
        "n_keys",
        "n_lines",
    )


@check("ingest_incremental", EVENTS_SQL)
def ingest_incremental(spark: SparkSession, folder: str) -> DataFrame:
    root, target, state = (session.scratch_path(spark, x) for x in ("events-in", "events-raw", "events-state"))
    lines = event_lines(spark, folder)
    first = F.col("event_type").isin("click", "view")
    for arrived in (lines.where(first), lines.where(~first), None):
        if arrived is not None:
            arrived.write.mode("append").partitionBy("event_type").text(root)
        incremental.ingest_new_files(spark, root, target, state, pattern="*.txt", load_date=day())
    return ingested_columns(incremental.read_ingested(spark, target))


# --- delimited files -------------------------------------------------------------

PRICE = "cast(cast(o_totalprice as decimal(18,2)) as string)"
ORDER_LINE = f"""
case when o_orderstatus = 'P' and o_orderpriority = '1-URGENT' then concat_ws(',', cast(o_orderkey as string), 'x', {PRICE})
     when o_orderstatus = 'P' and o_orderpriority = '2-HIGH'
       then concat_ws(',', cast(o_orderkey as string), 'abc', {PRICE}, date_format(o_orderdate, 'yyyy-MM-dd'), o_orderpriority)
     else concat_ws(',', cast(o_orderkey as string), cast(o_custkey as string), {PRICE},
                    date_format(o_orderdate, 'yyyy-MM-dd'), o_orderpriority) end
"""
BAD = "o_orderstatus = 'P' and o_orderpriority in ('1-URGENT', '2-HIGH')"


def staged_orders(spark: SparkSession, folder: str) -> delimited.StagedFiles:
    """Orders as delimited files, one folder per status, some lines damaged."""
    root = session.scratch_path(spark, "orders-in")
    orders = table(spark, folder, "orders").repartition("o_orderstatus").sortWithinPartitions("o_orderstatus", "o_orderkey")
    lines = orders.select(F.expr(ORDER_LINE).alias("value"), "o_orderstatus")
    lines.write.partitionBy("o_orderstatus").text(root)
    schema = T.StructType(
        [
            T.StructField("c1", T.LongType()),
            T.StructField("c2", T.LongType()),
            T.StructField("c3", T.DecimalType(18, 2)),
            T.StructField("c4", T.DateType()),
            T.StructField("c5", T.StringType()),
        ]
    )
    return delimited.StagedFiles(root, "*.txt", schema, {"sep": ",", "dateFormat": "yyyy-MM-dd"})


LOADED_SQL = f"""
select o_orderkey, o_custkey, cast(o_totalprice as decimal(18,2)) as price, cast(o_orderdate as date) as day
from orders where not ({BAD})
"""
ORDER_FIELDS = {"o_orderkey": "c1", "o_custkey": "c2", "price": "c3", "day": "c4"}


@check("staged_file_load", LOADED_SQL)
def staged_file_load(spark: SparkSession, folder: str) -> DataFrame:
    """The second call finds nothing to load."""
    files = staged_orders(spark, folder)
    target, control = (session.scratch_path(spark, x) for x in ("orders-loaded", "orders-control"))
    for _ in range(2):
        fields = {n: F.col(c) for n, c in ORDER_FIELDS.items()}
        feedback.load_files(spark, files, fields, target, control, table="orders")
    return tables.read_runs(spark, target)


REJECTED_SQL = f"""
select 'o_orderstatus=' || o_orderstatus as folder, n as line, o_orderkey,
  case when o_orderpriority = '1-URGENT' then 'expected 5 values, found 3' else 'a value does not fit its column type' end as error,
  case when o_orderpriority = '1-URGENT' then 'parsing' else 'conversion' end as category,
  case when o_orderpriority = '1-URGENT' then 'VALUE_COUNT' else 'VALUE_TYPE' end as code,
  case when o_orderpriority <> '1-URGENT' then 'c2' end as column_name,
  case when o_orderpriority = '1-URGENT' then o_orderkey || ',x,' || cast(o_totalprice as decimal(18,2))
       else o_orderkey || ',abc,' || cast(o_totalprice as decimal(18,2)) || ',' || strftime(o_orderdate, '%Y-%m-%d') || ',' || o_orderpriority
  end as rejected_record, ' ' as fixed_status, ' ' as action_taken
from (select *, row_number() over (partition by o_orderstatus order by o_orderkey) as n from orders) where {BAD}
"""


@check(
    "file_load_status",
    f"""
with r as ({REJECTED_SQL}), f as (select folder, min(line) as line from r group by 1)
select 'o_orderstatus=' || o_orderstatus as folder,
       case when o_orderstatus = 'P' then 'PARTIALLY_LOADED' else 'LOADED' end as status, count(*) as rows_parsed,
       count(*) filter (where not ({BAD})) as row_loaded, cast(null as bigint) as error_limit,
       count(*) filter (where {BAD}) as errors_seen,
       any_value(r.error) as first_error, any_value(r.line) as first_error_line, any_value(r.column_name) as first_error_column_name,
       any_value(case when r.code = 'VALUE_TYPE' then length(r.o_orderkey::varchar) + 2 else length(r.rejected_record) end)
         as first_error_character
from orders left join f on f.folder = 'o_orderstatus=' || o_orderstatus left join r on r.folder = f.folder and r.line = f.line
group by 1, 2
""",
)
def file_load_status(spark: SparkSession, folder: str) -> DataFrame:
    files = staged_orders(spark, folder)
    parts = delimited.settle_staged(delimited.read_staged(spark, files), files, session.settle)
    status = delimited.load_status(spark, parts, files)
    return status.withColumn("folder", text.segment(F.col("file"), 1)).drop("file")


@check(
    "reject_capture",
    f"select * exclude (o_orderkey), line as row_number, line as row_start_line, "
    f"case when code = 'VALUE_TYPE' then length(o_orderkey::varchar) + 2 else length(rejected_record) end as \"character\", "
    f"case when code = 'VALUE_TYPE' then length(o_orderkey::varchar) + 1 else length(rejected_record) end as byte_offset "
    f"from ({REJECTED_SQL})",
)
def reject_capture(spark: SparkSession, folder: str) -> DataFrame:
    files = staged_orders(spark, folder)
    parts = delimited.settle_staged(delimited.read_staged(spark, files), files, session.settle)
    damaged = delimited.rejects(parts, files)
    return damaged.withColumn("folder", text.segment(F.col("file"), 1)).drop("file")


@check(
    "file_feedback_load",
    f"""
select 'not all rows loaded' as outcome, cast(count(*) filter (where not ({BAD})) as bigint) as rows_loaded,
       cast(count(*) filter (where {BAD}) as bigint) as errors, count(*) filter (where {BAD}) as n_rejects,
       count(*) filter (where not ({BAD})) as n_target, count(distinct o_orderstatus) as n_status, 1::bigint as n_runs,
       'no files processed' as again
from orders
""",
)
def file_feedback_load(spark: SparkSession, folder: str) -> DataFrame:
    """Verdict and control tables of a load; a second call says that there was nothing to do."""
    files = staged_orders(spark, folder)
    target, control = (session.scratch_path(spark, x) for x in ("orders-loaded", "orders-control"))
    fields = {n: F.col(c) for n, c in ORDER_FIELDS.items()}
    first, again = (
        feedback.load_files(spark, files, fields, target, control, table="orders", day=day()) for _ in range(2)
    )
    rejects = feedback.read_control(spark, control, "rejects").agg(F.count("*").alias("n_rejects"))
    status = feedback.read_control(spark, control, "status")
    loaded = tables.read_runs(spark, target).agg(F.count("*").alias("n_target"))
    return first.select(
        "outcome",
        "rows_loaded",
        "errors",
        rejects.scalar().alias("n_rejects"),
        loaded.scalar().alias("n_target"),
        status.agg(F.count("*")).scalar().alias("n_status"),
        status.agg(F.count_distinct("query_id")).scalar().alias("n_runs"),
        again.select("outcome").scalar().alias("again"),
    )


@check("run_ids", "select count(*) as files, true as well_formed, 1::bigint as n_runs from (select distinct o_orderstatus from orders)")
def run_ids(spark: SparkSession, folder: str) -> DataFrame:
    """One id per run, on every row the run writes."""
    files = staged_orders(spark, folder)
    target, control = (session.scratch_path(spark, x) for x in ("orders-loaded", "orders-control"))
    feedback.load_files(spark, files, {"k": F.col("c1")}, target, control, table="orders", day=day())
    status = feedback.read_control(spark, control, "status")
    return status.agg(
        F.count("*").alias("files"),
        F.bool_and(F.col("query_id").rlike("^[0-9a-f]{32}$")).alias("well_formed"),
        F.count_distinct("query_id").alias("n_runs"),
    )


# --- table copies ----------------------------------------------------------------


@check(
    "table_copy_append",
    "select *, date '2024-03-01' as load_dt from customer union all select *, date '2024-03-02' from customer",
)
def table_copy_append(spark: SparkSession, folder: str) -> DataFrame:
    target = session.scratch_path(spark, "customer-copy")
    customer = table(spark, folder, "customer")
    for value in ("2024-03-01", "2024-03-02", "2024-03-02"):  # the last run is repeated
        archive.copy_table(customer, target, "APPEND", day(value), f"run {value}")
    return tables.read_runs(spark, target)


@check("table_copy_truncate", "select *, date '2024-03-02' as load_dt from supplier")
def table_copy_truncate(spark: SparkSession, folder: str) -> DataFrame:
    target = session.scratch_path(spark, "supplier-copy")
    supplier = table(spark, folder, "supplier")
    for value in ("2024-03-01", "2024-03-02"):
        archive.copy_table(supplier, target, archive.TRUNCATE_LOAD, day(value), f"run {value}")
    return tables.read_runs(spark, target)


@check(
    "table_copy_audit",
    f"""
select 'orders_copy' as table_name, 'db' as target_db, 'main' as target_schema, date '{DAY}' as load_dt, 'LOADED' as status,
       count(*) as rows_parsed, count(*) as row_loaded, cast(null as bigint) as errors_seen from orders
""",
)
def table_copy_audit(spark: SparkSession, folder: str) -> DataFrame:
    target = session.scratch_path(spark, "orders-copy")
    copied = archive.copy_table(table(spark, folder, "orders"), target, "APPEND", day(), "run-1")
    audit = archive.audit_row(spark, "orders_copy", "db", "main", copied, day(), "run-1")
    return audit.select(
        "table_name", "target_db", "target_schema", "load_dt", "status", "rows_parsed", "row_loaded", "errors_seen"
    )


CONFIG = (
    "source_db_name string, source_schema_name string, source_table_name string, target_db_name string, "
    "target_schema_name string, target_table_name string, load_type string, frequency string, "
    "run_backup_trigger_ind boolean"
)


def archive_run(spark: SparkSession, folder: str) -> tuple[dict[str, DataFrame], str]:
    """Archive part and supplier in two runs; customer is not triggered, one source is missing."""
    base = session.scratch_path(spark, "archive")
    config = spark.createDataFrame(
        [
            ("src", "main", "part", "tgt", "main", "part_copy", "TRUNCATE_LOAD", "DAILY", True),
            ("src", "main", "supplier", "tgt", "main", "supplier_copy", "APPEND", "Monthly", True),
            ("src", "main", "customer", "tgt", "main", "customer_copy", "APPEND", "MONTHLY", False),
            ("src", "main", "supplier", "tgt", "main", "supplier_incremental", "APPEND", "DAILY", False),
            ("src", "main", "not_there", "tgt", "main", "lost_copy", "APPEND", "DAILY", True),
        ],
        CONFIG,
    )
    totals = spark.createDataFrame([("t1", "N"), ("t2", "Y"), ("t3", "N")], "table_name string, archive_status string")
    dictionary = spark.createDataFrame(
        [("supplier", "s_name", "Supplier Name"), ("supplier", "s_suppkey", "s_suppkey")],
        "table_name string, extract_field_name string, field_desc string",
    )

    def locate(database: str, schema: str, name: str) -> str:
        return f"{folder}/{name}.parquet" if database == "src" else f"{base}/{name}"

    control = f"{base}/control"
    archive.store_control(spark, control, config, totals)
    for _ in range(2):
        result = archive.run_archive(spark, control, dictionary, archive.Places(locate), day())
    return result, base


@check(
    "config_driven_copy",
    f"""
select 'part_copy' as table_name, date '{DAY}' as load_dt, 'LOADED' as status, count(*) as row_loaded from part
union all select 'supplier_copy', date '{DAY}', 'LOADED', count(*) from supplier
union all select 'lost_copy', date '{DAY}', 'FAILED', null from range(2)
""",
)
def config_driven_copy(spark: SparkSession, folder: str) -> DataFrame:
    return archive_run(spark, folder)[0]["audit"].select("table_name", "load_dt", "status", "row_loaded")


@check(
    "table_archive",
    """
select 'audit' as kind, 'part_copy' as name, cast(count(*) as varchar) as value from part
union all select 'copy', 'part', cast(count(*) as varchar) from part
union all select 'copy', 'supplier', cast(count(*) as varchar) from supplier
union all select 'trigger', 'lost_copy', 'true'
union all select 'audit', 'supplier_copy', cast(count(*) as varchar) from supplier
union all select 'extract', 'supplier', 'verified ' || count(*) from supplier
union all select 'trigger', unnest(['part_copy', 'supplier_copy', 'customer_copy', 'supplier_incremental']), 'false'
union all select 'total', unnest(['t1', 't2', 't3']), 'Y'
""",
)
def table_archive(spark: SparkSession, folder: str) -> DataFrame:
    result, base = archive_run(spark, folder)
    result["audit"] = result["audit"].where("status = 'LOADED'")

    def copied(name: str) -> DataFrame:
        rows = tables.read_runs(spark, f"{base}/{name}_copy").agg(F.count("*").cast("string").alias("value"))
        return rows.select(F.lit("copy").alias("kind"), F.lit(name).alias("name"), "value")

    def facts(name: str, kind: str, key: str, value) -> DataFrame:
        return result[name].select(F.lit(kind).alias("kind"), F.col(key).alias("name"), value.alias("value"))

    return (
        facts("audit", "audit", "table_name", F.col("row_loaded").cast("string"))
        .unionAll(
            facts(
                "extracts",
                "extract",
                "table_name",
                F.concat_ws(" ", "status", F.col("target_rows").cast("string")),
            )
        )
        .unionAll(facts("config", "trigger", "target_table_name", F.col("run_backup_trigger_ind").cast("string")))
        .unionAll(facts("totals", "total", "table_name", F.col("archive_status")))
        .unionAll(copied("part"))
        .unionAll(copied("supplier"))
    )


@check(
    "extract_verify",
    """
select 'customer' as table_name, count(*) as source_rows, count(*) as target_rows, true as counts_match, 'verified' as status
from customer
""",
)
def extract_verify(spark: SparkSession, folder: str) -> DataFrame:
    customer = table(spark, folder, "customer")
    target = session.scratch_path(spark, "customer-extract")
    tables.full_refresh(customer, target)
    return extract.verify_counts("customer", customer, spark.read.parquet(target))


@check(
    "extract_build",
    """
select o_orderkey as "Order Number", o_custkey, o_orderstatus as status, o_totalprice, cast(o_orderdate as date) as "Day",
       o_orderpriority from orders
""",
)
def extract_build(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").withColumn("o_orderdate", F.to_date("o_orderdate"))
    dictionary = spark.createDataFrame(
        [("orders", "o_orderkey", "Order Number"), ("orders", "o_orderstatus", "status"), ("orders", "o_orderdate", "Day")],
        "table_name string, extract_field_name string, field_desc string",
    )
    target = session.scratch_path(spark, "orders-extract")
    extract.build_extract(spark, "orders", orders, dictionary, target)
    return spark.read.parquet(target)


# --- whole-table and keyed writes ------------------------------------------------


@check("full_refresh", "select o_orderstatus, count(*) as n from orders group by 1")
def full_refresh(spark: SparkSession, folder: str) -> DataFrame:
    target = session.scratch_path(spark, "refresh")
    orders = table(spark, folder, "orders")
    for rows in (orders.where("o_orderstatus = 'F'"), orders):
        tables.full_refresh(rows.groupBy("o_orderstatus").agg(F.count("*").alias("n")), target)
    return spark.read.parquet(target)


REPLACED_SQL = """
with k as (select cast(o_custkey as varchar) as key, o_orderkey, o_orderdate >= timestamp '2001-03-01' as fresh from orders)
select key, o_orderkey, fresh from k
where fresh or key not in (select key from k where fresh)
"""


def keyed_orders(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        F.col("o_custkey").cast("string").alias("key"),
        "o_orderkey",
        F.expr("o_orderdate >= timestamp_ntz'2001-03-01'").alias("fresh"),
    )


@check("keyed_replace", REPLACED_SQL)
def keyed_replace(spark: SparkSession, folder: str) -> DataFrame:
    target = session.scratch_path(spark, "keyed")
    orders = keyed_orders(spark, folder)
    padded = orders.where("not fresh").withColumn("key", F.concat("key", F.lit("  ")))
    for batch in (padded, orders.where("fresh")):
        keyed.replace_keys(batch, target, ["key"], session.scratch_path(spark, "keyed-staged"))
    return keyed.read_keyed(spark, target).withColumn("key", F.trim("key"))


@check("incremental_upsert", REPLACED_SQL)
def incremental_upsert(spark: SparkSession, folder: str) -> DataFrame:
    root, target, state = (session.scratch_path(spark, x) for x in ("upsert-in", "upsert", "upsert-state"))
    orders = keyed_orders(spark, folder)
    for arrived in (orders.where("not fresh"), orders.where("fresh"), None):
        if arrived is not None:
            arrived.write.mode("append").parquet(root)
        incremental.upsert_new_files(spark, root, orders.schema, target, state, ["key"], lambda new: new, buckets=8)
    return keyed.read_keyed(spark, target)


@check(
    "history_append",
    """
select distinct o_orderstatus, o_orderpriority, cast('2024-03-01' as date) as load_dt from orders where o_orderstatus <> 'P'
union all select distinct o_orderstatus, o_orderpriority, cast('2024-03-02' as date) from orders
""",
)
def history_append(spark: SparkSession, folder: str) -> DataFrame:
    target = session.scratch_path(spark, "history")
    orders = table(spark, folder, "orders").select("o_orderstatus", "o_orderpriority")
    for value, rows in (("2024-03-01", orders.where("o_orderstatus <> 'P'")), ("2024-03-02", orders)):
        tables.append_history(rows.withColumn("load_dt", day(value)), target)
    return spark.read.parquet(target)


@check(
    "mart_refresh",
    """
with o as (select case when o_custkey % 10 > 0 then cast(date_trunc('month', o_orderdate) as date) end as mon, * from orders),
kept as (select mon from o group by 1 having 3 * count(*) filter (where o_orderstatus = 'P') <= count(*))
select o.mon, o_orderstatus, count(*) as n, cast(sum(cast(o_totalprice as decimal(18,2))) as decimal(28,2)) as total
from o join kept on o.mon is not distinct from kept.mon group by 1, 2
""",
)
def mart_refresh(spark: SparkSession, folder: str) -> DataFrame:
    """Later files touch a part of the slices only; one is NULL, and slices with too many P rows leave the mart."""
    root, target, state = (session.scratch_path(spark, x) for x in ("mart-in", "mart", "mart-state"))
    orders = table(spark, folder, "orders").select(
        F.when(F.col("o_custkey") % 10 > 0, F.trunc("o_orderdate", "month")).alias("mon"),
        "o_orderstatus",
        F.col("o_totalprice").cast("decimal(18,2)").alias("price"),
        "o_orderdate",
    )

    def totals(rows: DataFrame) -> DataFrame:
        some = F.count_if(F.col("o_orderstatus") == "P")
        kept = rows.groupBy(F.col("mon").alias("kept")).agg(F.count("*").alias("all"), some.alias("p")).where("3 * p <= all")
        return rows.join(kept, F.col("mon").eqNullSafe(F.col("kept")), "left_semi").groupBy("mon", "o_orderstatus").agg(
            F.count("*").alias("n"), F.sum("price").cast("decimal(28,2)").alias("total")
        )

    late = F.expr("o_orderdate >= timestamp_ntz'2000-06-01' and o_orderstatus = 'P'")
    for arrived in (orders.where(~late), orders.where(late)):
        arrived.write.mode("append").parquet(root)
        incremental.refresh_mart(spark, root, orders.schema, target, state, "mon", totals)
    return spark.read.parquet(target).select("mon", "o_orderstatus", "n", "total")


@check(
    "mart_partials",
    """
with o as (select case when o_custkey % 10 > 0 then cast(date_trunc('month', o_orderdate) as date) end as mon, * from orders),
late as (select *, o_orderdate >= timestamp '2000-06-01' and o_orderstatus = 'P' as later from o where o_orderpriority <> '5-LOW'),
kept as (select mon from late group by 1 having 3 * count(*) filter (where o_orderstatus = 'P') <= count(*))
select late.mon, o_orderstatus, count(*) as n, cast(sum(cast(o_totalprice as decimal(18,2))) as decimal(28,2)) as total,
  max(o_orderdate) as newest
from late join kept on late.mon is not distinct from kept.mon group by 1, 2
""",
)
def mart_partials(spark: SparkSession, folder: str) -> DataFrame:
    """As `mart_refresh`, from stored sums: late files arrive, then the first ones change (some rows of them are gone)."""
    root, target, state = (session.scratch_path(spark, x) for x in ("partials-in", "partials-mart", "partials-state"))
    orders = table(spark, folder, "orders").select(
        F.when(F.col("o_custkey") % 10 > 0, F.trunc("o_orderdate", "month")).alias("mon"),
        "o_orderstatus", F.col("o_totalprice").cast("decimal(18,2)").alias("price"), "o_orderdate", "o_orderpriority",
    )
    measures = {"n": ("sum", F.lit(1)), "total": ("sum", F.col("price")), "newest": ("max", F.col("o_orderdate"))}

    def totals(orders: DataFrame) -> DataFrame:
        some = F.sum(F.when(F.col("o_orderstatus") == "P", F.col("n")).otherwise(0))
        kept = orders.groupBy(F.col("mon").alias("kept")).agg(F.sum("n").alias("all"), some.alias("p")).where("3 * p <= all")
        return orders.join(kept, F.col("mon").eqNullSafe(F.col("kept")), "left_semi").withColumn("total", F.col("total").cast("decimal(28,2)"))

    late = F.expr("o_orderdate >= timestamp_ntz'2000-06-01' and o_orderstatus = 'P'")
    rest = orders.where("o_orderpriority <> '5-LOW'")
    steps = (("a", orders.where(~late)), ("b", rest.where(late)), ("a", rest.where(~late)))
    for name, rows in steps:
        rows.coalesce(1).write.mode("overwrite").parquet(f"{root}/{name}")
        sums = partials.PartialSums(spark, root, orders.schema, state, "mon", ["mon", "o_orderstatus"], measures, buckets=4)
        partials.refresh(spark, {"orders": sums}, target, "mon", totals)
    return spark.read.parquet(target).select("mon", "o_orderstatus", "n", "total", "newest")
