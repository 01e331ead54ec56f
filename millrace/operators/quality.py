"""Quality views over profile results (see `operators.profile`)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import measures
from millrace.operators import projection


def profile_runs(results: DataFrame) -> DataFrame:
    """Per run: when, which tables, how many; newest first."""
    per_table = results.groupBy("profile_run_id", "table_name").agg(
        F.max("profile_timestamp").alias("run_timestamp")
    )
    return (
        per_table.groupBy("profile_run_id")
        .agg(
            F.max("run_timestamp").alias("run_timestamp"),
            F.array_join(F.sort_array(F.collect_list("table_name")), ", ").alias("tables_profiled"),
            F.count("table_name").alias("table_count"),
        )
        .orderBy(F.col("run_timestamp").desc(), "profile_run_id")
    )


def run_rows(results: DataFrame, run_id: str, table: str | None = None) -> DataFrame:
    """Rows of one run, optionally of one table, ordered by table and column."""
    rows = results.where(F.col("profile_run_id") == run_id)
    if table is not None:
        rows = rows.where(F.col("table_name") == table)
    return rows.orderBy("table_name", "column_name")


def summary(results: DataFrame, high_null: float = 50, low_distinct: float = 5) -> DataFrame:
    """One row: tables, columns, average null %, and the two problem counts with shares."""
    counts = results.agg(
        F.count_distinct("table_name").alias("total_tables"),
        F.count("*").alias("total_columns"),
        F.round(F.avg("null_percentage"), 2).cast("decimal(20,2)").alias("avg_null_percentage"),
        F.count_if(F.col("null_percentage") > high_null).alias("high_null_columns"),
        F.count_if(F.col("distinct_percentage") < low_distinct).alias("low_cardinality_columns"),
    )
    for part in ("high_null", "low_cardinality"):
        share = measures.ratio(
            F.col(f"{part}_columns").cast("decimal(20,0)"), F.col("total_columns").cast("decimal(20,0)")
        )
        counts = counts.withColumn(f"{part}_share", F.round(share * 100, 1).cast("decimal(20,1)"))
    return counts


def histogram(results: DataFrame, measure: str, bins: int = 20, low: float = 0, high: float = 100) -> DataFrame:
    """Column counts per equal-width bin of a percentage; the last bin includes its end."""
    width = (high - low) / bins
    bucket = F.least(
        F.floor((F.col(measure).cast("double") - low) / width), F.lit(bins - 1)
    ).cast("int")
    return (
        results.where(F.col(measure).isNotNull())
        .groupBy(bucket.alias("bin"))
        .agg(F.count("*").alias("column_count"))
        .select(
            "bin",
            (F.lit(low) + F.col("bin") * width).cast("double").alias("bin_start"),
            (F.lit(low) + (F.col("bin") + 1) * width).cast("double").alias("bin_end"),
            "column_count",
        )
    )


def type_counts(results: DataFrame) -> DataFrame:
    return results.groupBy("data_type").agg(F.count("*").alias("column_count"))


def widest_tables(results: DataFrame, k: int = 10) -> DataFrame:
    """The k tables with most columns."""
    return (
        results.groupBy("table_name")
        .agg(F.count("*").alias("column_count"))
        .orderBy(F.col("column_count").desc(), "table_name")
        .limit(k)
    )


def table_detail(results: DataFrame) -> DataFrame:
    """Per table: columns, average null %, rows, average distinct %."""
    return results.groupBy("table_name").agg(
        F.count("*").alias("column_count"),
        F.round(F.avg("null_percentage"), 2).cast("decimal(20,2)").alias("avg_null_percentage"),
        F.max("total_rows").alias("total_rows"),
        F.round(F.avg("distinct_percentage"), 2).cast("decimal(20,2)").alias("avg_distinct_percentage"),
    )


def completeness(results: DataFrame) -> DataFrame:
    """Per column: completeness (100 - null %) and distinct %."""
    return results.select(
        "table_name",
        "column_name",
        "null_percentage",
        "distinct_percentage",
        (F.lit(100) - F.col("null_percentage")).cast("decimal(20,2)").alias("completeness"),
    )


def high_null_columns(results: DataFrame, threshold: float = 50) -> DataFrame:
    return (
        results.where(F.col("null_percentage") > threshold)
        .select("table_name", "column_name", "data_type", "null_percentage", "total_rows")
        .orderBy(F.col("null_percentage").desc(), "table_name", "column_name")
    )


def worst_null_columns(results: DataFrame, threshold: float = 50, k: int = 20) -> DataFrame:
    """The k columns with the highest null %, of those above the threshold."""
    return high_null_columns(results, threshold).limit(k)


def low_cardinality_columns(results: DataFrame, threshold: float = 5, min_rows: int = 100) -> DataFrame:
    return (
        results.where((F.col("distinct_percentage") < threshold) & (F.col("total_rows") > min_rows))
        .select("table_name", "column_name", "data_type", "distinct_count", "distinct_percentage", "total_rows")
        .orderBy("distinct_percentage", "table_name", "column_name")
    )


def all_null_columns(results: DataFrame) -> DataFrame:
    return results.where(F.col("null_percentage") == 100).select(
        "table_name", "column_name", "data_type", "total_rows"
    )


def search(results: DataFrame, column: str | None = None, tables=None, data_types=None) -> DataFrame:
    return projection.search_filter(
        results, {"column_name": column}, {"table_name": tables, "data_type": data_types}
    )
