"""Extract tables: all rows under dictionary names, with verification."""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators import projection
from millrace.sources import tables

COLUMN_LIST = "table_name string, column_name string, ordinal_position int, data_type string"
REPORT = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("renamed_columns", T.IntegerType()),
        T.StructField("kept_columns", T.IntegerType()),
        T.StructField("source_rows", T.LongType()),
        T.StructField("target_rows", T.LongType()),
        T.StructField("counts_match", T.BooleanType()),
        T.StructField("seconds", T.DoubleType()),
        T.StructField("rows_per_second", T.DoubleType()),
    ]
)


def column_list(spark: SparkSession, named_tables: dict[str, DataFrame]) -> DataFrame:
    """Columns of the tables as rows, from their schemas."""
    rows = [
        (name, f.name, i, f.dataType.simpleString())
        for name, table in named_tables.items()
        for i, f in enumerate(table.schema.fields, start=1)
    ]
    return spark.createDataFrame(rows, COLUMN_LIST)


def column_aliases(columns: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Each column with its dictionary name, or its own; in ordinal order.

    `dictionary` has `table_name`, `extract_field_name` and `field_desc`.
    """
    entries = dictionary.select(
        "table_name", F.col("extract_field_name").alias("column_name"), "field_desc"
    )
    return (
        columns.join(entries, ["table_name", "column_name"], "left")
        .select(
            "table_name",
            "column_name",
            "ordinal_position",
            F.coalesce("field_desc", "column_name").alias("column_alias"),
        )
        .orderBy("table_name", "ordinal_position")
    )


def dictionary_of(dictionary: DataFrame, table_name: str) -> dict[str, str]:
    """Names for the columns of one table (metadata); of several for one column the least."""
    rows = dictionary.where((F.col("table_name") == table_name) & F.col("field_desc").isNotNull())
    named = rows.groupBy("extract_field_name").agg(F.min("field_desc"))
    return {r[0]: r[1] for r in named.collect()}


def verify_counts(table_name: str, source: DataFrame, target: DataFrame) -> DataFrame:
    """One row comparing the row counts of source and target, without collecting either."""
    counted = (
        source.select(F.lit(1).alias("s"), F.lit(0).alias("t"))
        .unionAll(target.select(F.lit(0).alias("s"), F.lit(1).alias("t")))
        .agg(
            F.coalesce(F.sum("s"), F.lit(0)).alias("source_rows"),
            F.coalesce(F.sum("t"), F.lit(0)).alias("target_rows"),
        )
    )
    same = F.col("source_rows") == F.col("target_rows")
    return counted.select(
        F.lit(table_name).alias("table_name"),
        "source_rows",
        "target_rows",
        same.alias("counts_match"),
        F.when(F.col("source_rows") == 0, "source is empty")
        .when(same, "verified")
        .otherwise("row counts differ")
        .alias("status"),
    )


def build_extract(
    spark: SparkSession, table_name: str, source: DataFrame | None, dictionary: DataFrame, target: str
) -> DataFrame:
    """Write the renamed extract of a table and report on it (one row, `REPORT`).

    A missing or empty source is reported and skipped.
    """

    def report(status: str, renamed: int = 0, kept: int = 0, counts: Sequence[int] = (0, 0), seconds: float = 0.0):
        rate = counts[1] / seconds if seconds > 0 else None
        row = (table_name, status, renamed, kept, counts[0], counts[1], counts[0] == counts[1], seconds, rate)
        return spark.createDataFrame([row], REPORT)

    if source is None:
        return report("source table does not exist")
    names = dictionary_of(dictionary, table_name)
    aliases = projection.dictionary_aliases(source.columns, names)
    renamed = sum(old != new for old, new in aliases)
    kept = len(aliases) - renamed
    if source.isEmpty():
        return report("source is empty", renamed, kept)
    started = time.monotonic()
    tables.full_refresh(projection.renamed_extract(source, names), target)
    seconds = time.monotonic() - started
    counts = verify_counts(table_name, source, spark.read.parquet(target)).first()
    return report(
        counts["status"], renamed, kept, (counts["source_rows"], counts["target_rows"]), seconds
    )
