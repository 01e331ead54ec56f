"""Load of staged delimited files into a table, with audit and rejects."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import session
from millrace.sources import delimited, runs, tables

IDENTITY = ["file_path", "file_size", "file_modification_time"]


def history(spark: SparkSession, control: str) -> DataFrame:
    """Identities of the files that earlier runs have dealt with."""
    path = f"{control}/files"
    if tables.path_exists(spark, path):
        return tables.read_runs(spark, path)
    return spark.createDataFrame([], "file_path string, file_size bigint, file_modification_time timestamp")


def read_control(spark: SparkSession, control: str, name: str) -> DataFrame:
    """All rows of the control table `status` or `rejects`."""
    return tables.read_runs(spark, f"{control}/{name}")


def load_files(
    spark: SparkSession,
    files: delimited.StagedFiles,
    fields: Mapping[str, Column],
    target: str,
    control: str,
    *,
    table: str,
    database: str = "",
    schema: str = "",
    day: Column | None = None,
) -> DataFrame:
    """Add the good lines of files not loaded before to `target`; returns the verdict (one row).

    Status per file and rejects go to the control tables below `control`, which
    also remember every file by path, size and date: it is not loaded again
    unless it has changed. The parsed lines are settled once, good and damaged
    ones apart, so good rows, status and rejects describe the same read and
    read each line once. The files of a run are stored
    first, and all it writes lies under its run id, so a run that died is
    repeated by the next call without doubling anything. Read the target with
    `sources.tables.read_runs`.
    """
    pending = runs.PendingWork(spark, f"{control}/pending")
    work = pending.stored()
    if work is None:
        listed = delimited.listed_files(spark, files)
        work = pending.begin(listed.join(history(spark, control), IDENTITY, "left_anti"))
    if work is None:
        nothing = spark.createDataFrame([], "row_loaded bigint, errors_seen bigint")
        return delimited.verdict(nothing)
    chosen, run = work
    stamp = F.current_date() if day is None else day
    about = {
        "table_name": F.lit(table),
        "target_db": F.lit(database),
        "target_schema": F.lit(schema),
        "query_id": F.lit(run),
    }

    def store(rows: DataFrame, path: str) -> None:
        tables.replace_slices(rows.withColumn(tables.RUN, F.lit(run)), path, [tables.RUN])

    with session.workspace(spark) as settle:
        parts = delimited.settle_staged(delimited.read_staged(spark, files, chosen), files, settle)
        store(delimited.good_rows(parts.good, fields), target)
        store(delimited.rejects(parts, files).withColumns({**about, "load_ts": F.current_timestamp()}), f"{control}/rejects")
        status = settle(delimited.load_status(spark, parts, files, chosen), "status")
        store(status.withColumns({**about, "load_dt": stamp}), f"{control}/status")
        outcome = delimited.verdict(status).first()
    store(chosen.select(*IDENTITY), f"{control}/files")
    pending.finish()
    return spark.createDataFrame([outcome], "files bigint, rows_loaded bigint, errors bigint, outcome string")
