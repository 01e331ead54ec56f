"""Column profiles and the quality views over them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.aggregates import exact_mean
from checks.registry import check, table
from millrace import session
from millrace.operators import profile, quality
from millrace.plans import profiling
from millrace.sources import tables
from millrace.streaming import profiles

# column types of the given tables, for the SQL side
TYPES = {
    "region": "r_regionkey:int r_name:string",
    "nation": "n_nationkey:int n_name:string n_regionkey:int",
    "customer": "c_custkey:bigint c_name:string c_nationkey:int c_acctbal:double c_mktsegment:string",
    "supplier": "s_suppkey:bigint s_name:string s_nationkey:int s_acctbal:double",
    "part": "p_partkey:bigint p_name:string p_brand:string p_type:string p_size:int p_retailprice:double",
    "orders": (
        "o_orderkey:bigint o_custkey:bigint o_orderstatus:string o_totalprice:double o_orderdate:timestamp_ntz "
        "o_orderpriority:string"
    ),
    "lineitem": (
        "l_orderkey:bigint l_partkey:bigint l_suppkey:bigint l_linenumber:int l_quantity:double l_extendedprice:double "
        "l_discount:double l_tax:double l_returnflag:string l_linestatus:string l_shipdate:timestamp_ntz"
    ),
    "events": (
        "event_id:bigint ts:timestamp_ntz user_id:bigint event_type:string value:double props:string"
    ),
    "documents": "doc_id:bigint text:string lang:string source:string n_chars:bigint",
    "embeddings": "vec_id:bigint embedding:array<float> label:int",
    "pages": "page_id:bigint url:string html:string",
    "benchmark": "item_id:bigint text:string",
    "labels": "doc_id:bigint quality:int toxic:int",
    "conversations": "conv_id:bigint turn:bigint role:string text:string",
}
# orders with columns that are partly, blankly and wholly empty
GAPPY = "o_orderkey:bigint o_closed:string o_blank:string o_nothing:string o_flag:string"
GAPPY_SQL = """
(select o_orderkey, case when o_orderstatus = 'F' then o_orderpriority end as o_closed,
   case when o_orderstatus = 'F' then o_orderstatus when o_orderstatus = 'P' then '  ' else '' end as o_blank,
   cast(null as varchar) as o_nothing, case when o_orderpriority = '1-URGENT' then 'Y' end as o_flag from orders)
"""
RUN, TAKEN = "run-1", "2024-03-01 06:00:00"


def gappy_orders(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").selectExpr(
        "o_orderkey",
        "case when o_orderstatus = 'F' then o_orderpriority end as o_closed",
        "case when o_orderstatus = 'F' then o_orderstatus when o_orderstatus = 'P' then '  ' else '' end as o_blank",
        "cast(null as string) as o_nothing",
        "case when o_orderpriority = '1-URGENT' then 'Y' end as o_flag",
    )


def pct(part: str, whole: str) -> str:
    """SQL: exact percentage with two digits, NULL for nothing."""
    scaled = f"(20000 * cast({part} as hugeint) + {whole}) // (2 * nullif({whole}, 0))"
    return f"cast(cast({scaled} as decimal(28,0)) / 100 as decimal(20,2))"


def column_sql(name: str, source: str, column: str, kind: str, blanks: bool) -> str:
    missing = f"{column} is null"
    if blanks and kind == "string":
        missing += f" or trim({column}, ' ') = ''"
    nested = kind.startswith("array")
    low = "cast(null as varchar)" if nested else f"cast(min({column}) as varchar)"
    high = "cast(null as varchar)" if nested else f"cast(max({column}) as varchar)"
    return f"""
select '{name}' as table_name, '{column}' as column_name, '{kind}' as data_type, total_rows, null_count,
  total_rows - null_count as not_null_count, {pct('null_count', 'total_rows')} as null_percentage, distinct_count,
  {pct('distinct_count', '(total_rows - null_count)')} as distinct_percentage, min_value, max_value
from (select count(*) as total_rows, count(*) filter (where {missing}) as null_count,
  count(distinct {column}) as distinct_count, {low} as min_value, {high} as max_value from {source})"""


def table_sql(name: str, columns: str, source: str | None = None, blanks: bool = True) -> str:
    parts = [c.split(":", 1) for c in columns.split()]
    return " union all ".join(column_sql(name, source or name, c, kind, blanks) for c, kind in parts)


VISIBLE = [c for c in profile.RESULT_COLUMNS if c not in ("profile_run_id", "database_name", "schema_name", "profile_timestamp")]


def profiled(spark: SparkSession, named: dict[str, DataFrame], run: str = RUN, blanks: bool = True) -> DataFrame:
    taken = F.lit(TAKEN).cast("timestamp")
    return profiling.profile_run(named, run_id=run, blanks_are_null=blanks, taken_at=taken)


@check("profile_columns", table_sql("gappy", GAPPY, GAPPY_SQL) + " union all " + table_sql("lineitem", TYPES["lineitem"]))
def profile_columns(spark: SparkSession, folder: str) -> DataFrame:
    named = {"gappy": gappy_orders(spark, folder), "lineitem": table(spark, folder, "lineitem")}
    return profiled(spark, named).select(*VISIBLE)


@check("profile_columns_strict", table_sql("gappy", GAPPY, GAPPY_SQL, blanks=False))
def profile_columns_strict(spark: SparkSession, folder: str) -> DataFrame:
    return profiled(spark, {"gappy": gappy_orders(spark, folder)}, blanks=False).select(*VISIBLE)


@check("profile_schema", " union all ".join(table_sql(n, c) for n, c in TYPES.items()))
def profile_schema(spark: SparkSession, folder: str) -> DataFrame:
    return profiled(spark, {n: table(spark, folder, n) for n in TYPES}).select(*VISIBLE)


# --- quality views ---------------------------------------------------------------

QUALITY_TABLES = ["customer", "orders", "part"]
RESULTS_SQL = " union all ".join(
    [table_sql("gappy", GAPPY, GAPPY_SQL), *[table_sql(n, TYPES[n]) for n in QUALITY_TABLES]]
)


def results(spark: SparkSession, folder: str, run: str = RUN) -> DataFrame:
    named = {"gappy": gappy_orders(spark, folder), **{n: table(spark, folder, n) for n in QUALITY_TABLES}}
    return profiled(spark, named, run)


def over_results(sql: str) -> str:
    return f"with r as ({RESULTS_SQL}) {sql}"


def stored_results(spark: SparkSession, folder: str) -> DataFrame:
    """Two stored runs, the first one stored twice."""
    target = session.scratch_path(spark, "profiles")
    labels = profiled(spark, {"labels": table(spark, folder, "labels"), "orders": table(spark, folder, "orders")})
    for run in (labels, labels, results(spark, folder, "run-2")):
        profiling.store_run(spark, run, target)
    return profiling.stored_runs(spark, target)


@check(
    "profile_runs",
    "select 'run-2' as profile_run_id, 'customer, gappy, orders, part' as tables_profiled, 4 as table_count "
    "union all select 'run-1', 'labels, orders', 2 from labels having count(*) > 0",
)
def profile_runs(spark: SparkSession, folder: str) -> DataFrame:
    runs = quality.profile_runs(stored_results(spark, folder))
    return runs.select("profile_run_id", "tables_profiled", F.col("table_count").cast("int").alias("table_count"))


@check("run_filter", over_results("select table_name, column_name, total_rows from r where table_name = 'orders'"))
def run_filter(spark: SparkSession, folder: str) -> DataFrame:
    return quality.run_rows(stored_results(spark, folder), "run-2", "orders").select(
        "table_name", "column_name", "total_rows"
    )


@check(
    "search_filter",
    over_results(
        "select table_name, column_name from r where column_name ilike '%KEY%' and table_name in ('orders', 'part') "
        "and data_type in ('bigint')"
    ),
)
def search_filter(spark: SparkSession, folder: str) -> DataFrame:
    found = quality.search(results(spark, folder), "KEY", ["orders", "part"], ["bigint"])
    return found.select("table_name", "column_name")


@check(
    "dq_summary",
    over_results(
        f"""
select count(distinct table_name) as total_tables, count(*) as total_columns,
  cast({exact_mean('sum(null_percentage)', 'count(null_percentage)')} as decimal(20,2)) as avg_null_percentage,
  count(*) filter (where null_percentage > 50) as high_null_columns,
  count(*) filter (where distinct_percentage < 5) as low_cardinality_columns,
  cast(round(count(*) filter (where null_percentage > 50) * 100 / count(*), 1) as decimal(20,1)) as high_null_share,
  cast(round(count(*) filter (where distinct_percentage < 5) * 100 / count(*), 1) as decimal(20,1)) as low_cardinality_share
from r"""
    ),
)
def dq_summary(spark: SparkSession, folder: str) -> DataFrame:
    return quality.summary(results(spark, folder))


@check(
    "dq_histogram",
    over_results(
        """
select measure, cast(least(floor(v / 5), 19) as int) as bin, cast(least(floor(v / 5), 19) * 5 as double) as bin_start,
  cast(least(floor(v / 5), 19) * 5 + 5 as double) as bin_end, count(*) as column_count
from (select 'null' as measure, cast(null_percentage as double) as v from r
      union all select 'distinct', cast(distinct_percentage as double) from r where distinct_percentage is not null)
group by all"""
    ),
)
def dq_histogram(spark: SparkSession, folder: str) -> DataFrame:
    rows = results(spark, folder)
    nulls = quality.histogram(rows, "null_percentage").withColumn("measure", F.lit("null"))
    return nulls.unionByName(
        quality.histogram(rows, "distinct_percentage").withColumn("measure", F.lit("distinct"))
    )


@check("dq_type_counts", over_results("select data_type, count(*) as column_count from r group by 1"))
def dq_type_counts(spark: SparkSession, folder: str) -> DataFrame:
    return quality.type_counts(results(spark, folder))


@check(
    "dq_table_detail",
    over_results(
        f"""
select table_name, count(*) as column_count,
  cast({exact_mean('sum(null_percentage)', 'count(null_percentage)')} as decimal(20,2)) as avg_null_percentage,
  max(total_rows) as total_rows,
  cast({exact_mean('sum(distinct_percentage)', 'count(distinct_percentage)')} as decimal(20,2)) as avg_distinct_percentage
from r group by 1"""
    ),
)
def dq_table_detail(spark: SparkSession, folder: str) -> DataFrame:
    return quality.table_detail(results(spark, folder))


@check(
    "dq_completeness",
    over_results(
        "select table_name, column_name, null_percentage, distinct_percentage, "
        "cast(100 - null_percentage as decimal(20,2)) as completeness from r"
    ),
)
def dq_completeness(spark: SparkSession, folder: str) -> DataFrame:
    return quality.completeness(results(spark, folder))


@check(
    "dq_high_null",
    over_results("select table_name, column_name, data_type, null_percentage, total_rows from r where null_percentage > 50"),
)
def dq_high_null(spark: SparkSession, folder: str) -> DataFrame:
    return quality.high_null_columns(results(spark, folder))


@check(
    "dq_low_cardinality",
    over_results(
        "select table_name, column_name, data_type, distinct_count, distinct_percentage, total_rows from r "
        "where distinct_percentage < 5 and total_rows > 100"
    ),
)
def dq_low_cardinality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.low_cardinality_columns(results(spark, folder))


@check(
    "dq_all_null",
    over_results("select table_name, column_name, data_type, total_rows from r where null_percentage = 100"),
)
def dq_all_null(spark: SparkSession, folder: str) -> DataFrame:
    return quality.all_null_columns(results(spark, folder))


@check(
    "dq_widest_tables",
    over_results("select table_name, count(*) as column_count from r group by 1 order by 2 desc, 1 limit 3"),
)
def dq_widest_tables(spark: SparkSession, folder: str) -> DataFrame:
    return quality.widest_tables(results(spark, folder), 3)


@check(
    "dq_report",
    over_results(
        """
select view, cast(n as bigint) as n from (
  select 'summary' as view, 1 as n union all select 'type_counts', count(distinct data_type) from r
  union all select 'widest_tables', count(distinct table_name) from r
  union all select 'table_detail', count(distinct table_name) from r
  union all select 'completeness', count(*) from r
  union all select 'high_null', count(*) filter (where null_percentage > 50) from r
  union all select 'worst_null', least(20, count(*) filter (where null_percentage > 50)) from r
  union all select 'low_cardinality', count(*) filter (where distinct_percentage < 5 and total_rows > 100) from r
  union all select 'all_null', count(*) filter (where null_percentage = 100) from r
  union all select 'null_histogram', count(distinct least(floor(cast(null_percentage as double) / 5), 19)) from r
  union all select 'distinct_histogram', count(distinct least(floor(cast(distinct_percentage as double) / 5), 19)) from r)"""
    ),
)
def dq_report(spark: SparkSession, folder: str) -> DataFrame:
    """Row counts of all views of one run, the profile being taken once."""
    rows = session.settle(results(spark, folder), "profile")
    counts = [
        frame.agg(F.count("*").alias("n")).select(F.lit(name).alias("view"), "n")
        for name, frame in profiling.quality_report(rows).items()
    ]
    merged = counts[0]
    for part in counts[1:]:
        merged = merged.unionAll(part)
    return merged


@check(
    "csv_export",
    over_results(
        "select table_name, column_name, cast(total_rows as varchar) as total_rows, "
        "cast(null_percentage as varchar) as null_percentage from r"
    ),
)
def csv_export(spark: SparkSession, folder: str) -> DataFrame:
    target = session.scratch_path(spark, "profile-csv")
    tables.export_csv(results(spark, folder), target)
    written = spark.read.option("header", True).csv(target)
    return written.select("table_name", "column_name", "total_rows", "null_percentage")


@check("profile_lineitem", table_sql("lineitem", TYPES["lineitem"]))
def profile_lineitem(spark: SparkSession, folder: str) -> DataFrame:
    return profiled(spark, {"lineitem": table(spark, folder, "lineitem")}).select(*VISIBLE)


@check("profile_by_file", table_sql("gappy", GAPPY, GAPPY_SQL) + " union all " + table_sql("lineitem", TYPES["lineitem"]))
def profile_by_file(spark: SparkSession, folder: str) -> DataFrame:
    """Profiles kept file by file: a first run over part of the rows, a second one that reads the files added since."""
    parts = {
        "gappy": (gappy_orders(spark, folder), F.expr("o_orderkey % 3 = 0")),
        "lineitem": (table(spark, folder, "lineitem"), F.expr("l_linenumber <= 2")),
    }
    sources, late = {}, []
    for name, (rows, first) in parts.items():
        root = session.scratch_path(spark, name)
        rows.where(first).write.parquet(root)
        late.append((rows.where(~first), root))
        sources[name] = profiles.StoredProfile(spark, root, rows.schema, session.scratch_path(spark, "state"), buckets=4)
    profiles.profile_run(sources, run_id=RUN)
    for rows, root in late:
        rows.write.mode("append").parquet(root)
    return profiles.profile_run(sources, run_id=RUN).select(*VISIBLE)


SURE = [c for c in VISIBLE if not c.startswith("distinct_")]


@check(
    "profile_by_file_sketched",
    f"select {', '.join(SURE)}, true as distinct_close from ({table_sql('lineitem', TYPES['lineitem'])})",
)
def profile_by_file_sketched(spark: SparkSession, folder: str) -> DataFrame:
    """Profiles kept as one sketch for each file and column; estimates are held against the exact counts, 5 % apart at most."""
    rows = table(spark, folder, "lineitem")
    root = session.scratch_path(spark, "sketched")
    rows.write.parquet(root)
    source = profiles.StoredProfile(spark, root, rows.schema, session.scratch_path(spark, "state"), buckets=4, sketches=True)
    exact = profiled(spark, {"lineitem": rows}).select("column_name", F.col("distinct_count").alias("exact_count"))
    found = profiles.profile_run({"lineitem": source}, run_id=RUN).join(exact, "column_name")
    close = F.abs(F.col("distinct_count") - F.col("exact_count")) <= F.col("exact_count") * 0.05
    return found.select(*SURE, close.alias("distinct_close"))
