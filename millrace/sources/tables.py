"""Writing tables kept as Parquet folders."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import session

RUN = "load_run"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists on whatever file system the path names."""
    try:
        spark.read.format("binaryFile").load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def append_dated(source: DataFrame, target: str, load_date: Column, run: str, truncate: bool = False) -> None:
    """Copy all rows with a load date, under the partition of the run; `truncate` empties the target first.

    A run that is repeated overwrites what it wrote before.
    """
    stamped = source.withColumn("load_dt", load_date).withColumn(RUN, F.lit(run))
    mode = "static" if truncate else "dynamic"
    stamped.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(RUN).parquet(target)


def read_runs(spark: SparkSession, target: str) -> DataFrame:
    """A table written run by run, without the partition column."""
    return spark.read.parquet(target).drop(RUN)


def full_refresh(rows: DataFrame, target: str) -> None:
    """Replace the whole table by recomputed rows."""
    rows.write.mode("overwrite").parquet(target)


def append_history(snapshot: DataFrame, target: str, day: str = "load_dt") -> None:
    """Add a deduplicated snapshot under its date; a snapshot of the same date gives way to it."""
    replace_slices(snapshot.distinct(), target, [day])


def replace_slices(
    rows: DataFrame, target: str, by: Sequence[str], changed: DataFrame | None = None
) -> None:
    """Overwrite exactly the partitions that occur in `rows`.

    With `changed` (the values of `by` that were recomputed, NULL included) the
    partitions of changed values that `rows` no longer has are emptied as well.
    """
    spark = rows.sparkSession

    def write(frame: DataFrame) -> None:
        writer = frame.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(*by).parquet(target)

    if changed is None or not path_exists(spark, target):
        write(rows)
        return
    with session.workspace(spark) as settle:
        rows = settle(rows, "slices")
        write(rows)
        left = rows.select(*by).distinct()
        gone = changed.select(*by).distinct().alias("g").join(left.alias("r"), _same(by, "g", "r"), "left_anti")
        stored = spark.read.parquet(target)
        folder = F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "")
        stale = stored.select(*by, folder.alias("folder")).alias("s").join(
            gone.alias("g"), _same(by, "s", "g"), "left_semi"
        )
        # at most as many folders as slices changed
        for row in stale.select(F.try_url_decode(F.replace("folder", F.lit("+"), F.lit("%2B"))).alias("f")).distinct().collect():
            session.release(rows.drop(*by), row.f)


def _same(columns: Sequence[str], left: str, right: str) -> Column:
    """Equal in all columns, NULL equal to NULL."""
    tests = [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns]
    return reduce(lambda a, b: a & b, tests)


def export_csv(rows: DataFrame, target: str) -> None:
    """Write with a header line, one folder of part files."""
    rows.write.mode("overwrite").option("header", True).csv(target)
