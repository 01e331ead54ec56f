"""Profile of many tables under one run id, and the quality report over it."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import profile, quality
from millrace.sources import tables


def catalog_tables(spark: SparkSession, schema: str) -> dict[str, DataFrame]:
    """All tables of a catalog schema (temporary views left out), by name."""
    listed = [t for t in spark.catalog.listTables(schema) if t.tableType != "TEMPORARY"]
    return {t.name: spark.table(f"{schema}.`{t.name}`") for t in sorted(listed, key=lambda t: t.name)}


def profile_run(
    named_tables: Mapping[str, DataFrame], *, run_id: str | None = None, **options
) -> DataFrame:
    """Every column of every table under one run id (options as `operators.profile.profile_tables`)."""
    return profile.profile_tables(named_tables, run_id=run_id or str(uuid.uuid4()), **options)


def store_run(spark: SparkSession, results: DataFrame, target: str) -> None:
    """Add a run's rows to the stored results; the same run stored again replaces itself."""
    tables.replace_slices(results, target, ["profile_run_id"])


def stored_runs(spark: SparkSession, target: str) -> DataFrame:
    """All stored results; a filter on the run reads that run alone."""
    kinds = {"profile_run_id": "string"}
    rows = spark.read.parquet(target)
    return rows.withColumns({c: F.col(c).cast(k) for c, k in kinds.items()}).select(*profile.RESULT_COLUMNS)


def profile_schema(spark: SparkSession, schema: str, target: str, *, run_id: str | None = None, **options) -> str:
    """Profile all tables of a catalog schema and store the result; returns the run id."""
    run_id = run_id or str(uuid.uuid4())
    store_run(spark, profile_run(catalog_tables(spark, schema), run_id=run_id, schema=schema, **options), target)
    return run_id


def quality_report(results: DataFrame) -> dict[str, DataFrame]:
    """All quality views of one run, by name."""
    return {
        "summary": quality.summary(results),
        "null_histogram": quality.histogram(results, "null_percentage"),
        "distinct_histogram": quality.histogram(results, "distinct_percentage"),
        "type_counts": quality.type_counts(results),
        "widest_tables": quality.widest_tables(results),
        "table_detail": quality.table_detail(results),
        "completeness": quality.completeness(results),
        "high_null": quality.high_null_columns(results),
        "worst_null": quality.worst_null_columns(results),
        "low_cardinality": quality.low_cardinality_columns(results),
        "all_null": quality.all_null_columns(results),
    }
