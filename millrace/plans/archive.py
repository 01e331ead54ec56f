"""Config-driven table archive: copies, audit rows, trigger flags, monthly extracts."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from millrace.operators import projection
from millrace.plans import extract
from millrace.sources import runs, tables
from millrace.sources.generations import Generations

TRUNCATE_LOAD = "TRUNCATE_LOAD"
MONTHLY = "MONTHLY"
AUDIT = (
    "table_name string, target_db string, target_schema string, load_dt date, query_id string, file string, "
    "status string, rows_parsed bigint, row_loaded bigint, error_limit bigint, errors_seen bigint, "
    "first_error string, first_error_line bigint, first_error_character bigint, first_error_column_name string"
)


@dataclass(frozen=True)
class Places:
    """Where tables live: (database, schema, table) to a folder."""

    locate: Callable[[str, str, str], str]


def copy_table(source: DataFrame, target: str, load_type: str, day: Column, run_id: str) -> int:
    """Append the source to the target with its load date; returns the rows written.

    TRUNCATE_LOAD empties the target first. The rows lie under their run, so a
    repeated run overwrites its own (read with `tables.read_runs`). The count is
    observed while the rows are written, so the source is read once.
    """
    seen = Observation("copied")
    counted = source.observe(seen, F.count(F.lit(1)).alias("n"))
    tables.append_dated(counted, target, day, run_id, truncate=load_type == TRUNCATE_LOAD)
    return int(seen.get["n"])


def audit_row(
    spark: SparkSession, table: str, database: str, schema: str, rows: int | None, day: Column, run_id: str,
    error: str | None = None,
) -> DataFrame:
    """Load status of one copy: LOADED with its rows, or FAILED with the error."""
    known = spark.createDataFrame(
        [(table, database, schema, run_id, rows, error)],
        "table_name string, target_db string, target_schema string, query_id string, n bigint, first_error string",
    )
    status = F.when(F.col("first_error").isNull(), "LOADED").otherwise("FAILED")
    values = {"load_dt": day, "status": status, "rows_parsed": F.col("n"), "row_loaded": F.col("n")}
    columns = []
    for part in AUDIT.split(", "):
        name, kind = part.split(" ")
        value = values.get(name, F.col(name) if name in known.columns else F.lit(None))
        columns.append(value.cast(kind).alias(name))
    return known.select(*columns)


def pending(config: DataFrame) -> DataFrame:
    """Config rows whose trigger is set."""
    return config.where(F.col("run_backup_trigger_ind"))


def clear_triggers(config: DataFrame, target_tables: Sequence[str]) -> DataFrame:
    """Config with the triggers of the targets switched off."""
    done = F.col("run_backup_trigger_ind") & F.col("target_table_name").isin(list(target_tables))
    return projection.conditional_update(config, "run_backup_trigger_ind", F.lit(False), done)


def close_control_totals(totals: DataFrame, config: DataFrame, source_table: str) -> DataFrame:
    """All open control totals closed once no full copy of the source is pending.

    The condition is a scalar subquery: one count, evaluated once.
    """
    waiting = (
        pending(config)
        .where((F.col("source_table_name") == source_table) & ~F.col("target_table_name").like("%INCREMENTAL%"))
        .agg(F.count("*").alias("n"))
    )
    return projection.conditional_update(
        totals, "archive_status", F.lit("Y"), (F.col("archive_status") == "N") & (waiting.scalar() == 0)
    )


def archive_one(spark: SparkSession, row: Row, places: Places, day: Column, run_id: str) -> tuple[DataFrame, bool]:
    """Copy one configured table; its audit row and whether it went well. An error ends this copy only."""
    copied, error = None, None
    try:
        source = spark.read.parquet(
            places.locate(row.source_db_name, row.source_schema_name, row.source_table_name)
        )
        target = places.locate(row.target_db_name, row.target_schema_name, row.target_table_name)
        copied = copy_table(source, target, row.load_type, day, run_id)
    except Exception as failure:  # noqa: BLE001 - whatever it is, it goes to the audit and the others go on
        error = str(failure).split("\n")[0]
    audit = audit_row(
        spark, row.target_table_name, row.target_db_name, row.target_schema_name, copied, day, run_id, error
    )
    return audit, error is None


def control_state(spark: SparkSession, control: str) -> Generations:
    """The tables `config` and `totals`, which change together."""
    return Generations(spark, f"{control}/state")


def control_table(spark: SparkSession, control: str, name: str) -> DataFrame:
    """Newest state of a stored control table: `config`, `totals`; all rows of `audit` and `extracts`."""
    path, layout = f"{control}/{name}", {"audit": AUDIT, "extracts": extract.REPORT}.get(name)
    if layout is None:
        stored = control_state(spark, control).table(name)
        if stored is None:
            raise FileNotFoundError(f"no control table {name} at {control}")
        return stored
    return spark.read.schema(layout).parquet(path) if tables.path_exists(spark, path) else spark.createDataFrame([], layout)


def store_control(spark: SparkSession, control: str, config: DataFrame, totals: DataFrame, run_id: str = "") -> None:
    """Add a generation of the control tables that `run_archive` reads and updates: both of them or, after a crash, neither."""
    control_state(spark, control).write({"config": config.coalesce(1), "totals": totals.coalesce(1)}, run_id)


def run_archive(
    spark: SparkSession,
    control: str,
    dictionary: DataFrame,
    places: Places,
    day: Column,
    parallel: int = 4,
) -> dict[str, DataFrame]:
    """Archive every triggered table; returns audit, config, control totals and extract reports as stored.

    The config is a control table with one row per table to copy. Copies are
    independent Spark jobs submitted from a few threads, so small ones overlap.
    A copy that fails gets a FAILED audit row and keeps its trigger; the others
    are done and their triggers cleared, in the stored tables. The triggered
    rows are stored as pending work first, so that a run that died is repeated
    under its own run id and appends nothing twice. Config and totals change in
    one step (`store_control`).
    """
    config, totals = (control_table(spark, control, name) for name in ("config", "totals"))
    waiting = runs.PendingWork(spark, f"{control}/pending")
    work = waiting.stored() or waiting.begin(pending(config))
    if work is not None:
        rows, run_id = work
        jobs = rows.collect()
        with ThreadPoolExecutor(max_workers=parallel) as pool:
            results = list(pool.map(lambda row: archive_one(spark, row, places, day, run_id), jobs))
        done = [row for row, (_, well) in zip(jobs, results) if well]
        reports = []
        for row in done:
            if (row.frequency or "").upper() == MONTHLY:
                path = places.locate(row.source_db_name, row.source_schema_name, row.source_table_name)
                source = spark.read.parquet(path) if tables.path_exists(spark, path) else None
                target = places.locate(
                    row.target_db_name, row.target_schema_name, row.source_table_name + "_extract"
                )
                reports.append(extract.build_extract(spark, row.source_table_name, source, dictionary, target))

        def store(frames: list[DataFrame], schema: str, name: str) -> None:
            merged = spark.createDataFrame([], schema)
            for frame in frames:
                merged = merged.unionAll(frame)
            tables.replace_slices(merged.withColumn(tables.RUN, F.lit(run_id)), f"{control}/{name}", [tables.RUN])

        store([audit for audit, _ in results], AUDIT, "audit")
        store(reports, extract.REPORT, "extracts")
        config = clear_triggers(config, [row.target_table_name for row in done])
        for name in dict.fromkeys(row.source_table_name for row in done):
            totals = close_control_totals(totals, config, name)
        store_control(spark, control, config, totals, run_id)
        waiting.finish()
    return {name: control_table(spark, control, name) for name in ("audit", "config", "totals", "extracts")}
