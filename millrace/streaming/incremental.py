"""Incremental processing with Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import session
from millrace.sources import keyed, ndjson, newest, tables


# A file counts as new until it was loaded, however old it is dated (the source would forget it after a week).
ANY_AGE = {"maxFileAge": "36500d"}


def file_stream(spark: SparkSession, archive: str | None = None):
    """A reader of new files below a folder.

    The source keeps the names of loaded files on the driver. With `archive` it
    moves them there once they are loaded, which bounds that list.
    """
    reader = spark.readStream.options(**ANY_AGE)
    return reader.options(cleanSource="archive", sourceArchiveDir=archive) if archive else reader


def run_to_end(query) -> None:
    """Wait for an `availableNow` query and raise what it raised."""
    query.awaitTermination()


def ingest_new_files(
    spark: SparkSession,
    root: str,
    target: str,
    checkpoint: str,
    *,
    pattern: str = "*.ndjson",
    load_date: Column | None = None,
    line_numbers: bool = True,
    archive: str | None = None,
) -> None:
    """Load every file that earlier runs with this checkpoint have not loaded, whatever its date.

    Each micro-batch owns one folder of the target, so a batch that is replayed
    after a failure overwrites its own rows instead of adding them twice.
    """

    def store(lines: DataFrame, batch_id: int) -> None:
        day = F.current_date() if load_date is None else load_date
        with session.workspace(spark) as settle:
            raw = ndjson.documents(lines, root, day, F.current_timestamp(), line_numbers, settle)
            ndjson.write_raw(raw, f"{target}/ingest_batch={batch_id}", "overwrite")

    lines = ndjson.read_lines(file_stream(spark, archive), root, pattern)
    run_to_end(
        lines.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_ingested(spark: SparkSession, target: str) -> DataFrame:
    """Raw documents written by `ingest_new_files`, with the batch that brought them."""
    return spark.read.parquet(target).select(*ndjson.RAW_COLUMNS, "ingest_batch")


def upsert_new_files(
    spark: SparkSession,
    root: str,
    schema,
    target: str,
    checkpoint: str,
    keys: Sequence[str],
    shape: Callable[[DataFrame], DataFrame],
    buckets: int | None = None,
    archive: str | None = None,
) -> None:
    """Shape new Parquet files under `root` and replace the target rows of the same keys.

    A micro-batch is named by its checkpoint and number, so one that is replayed
    after it was done changes nothing (see `keyed.replace_keys`).
    """

    def replace(new: DataFrame, batch_id: int) -> None:
        keyed.replace_keys(shape(new), target, keys, f"{checkpoint}/{batch_id}", buckets)

    stream = file_stream(spark, archive).schema(schema).option("recursiveFileLookup", "true").parquet(root)
    run_to_end(
        stream.writeStream.foreachBatch(replace)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def refresh_mart(
    spark: SparkSession,
    root: str,
    schema,
    target: str,
    checkpoint: str,
    slice_col: str,
    compute: Callable[[DataFrame], DataFrame],
    by_slice: bool = False,
) -> None:
    """Recompute the mart slices that new files under `root` touch.

    A micro-batch only says which slices changed; those are recomputed from all
    files and overwrite their partitions, so late and repeated files are safe. A
    slice may be NULL; one that recomputes to nothing is emptied. The changed
    values are settled and joined, however many they are; the least and the
    greatest reach the scan as a filter. With `by_slice` the files lie in a
    folder for each slice and others are not listed. See `partials` for marts
    that need not read the files of a slice again.
    """

    def refresh(new: DataFrame, batch_id: int) -> None:
        everything = spark.read.schema(schema)
        if not by_slice:
            everything = everything.option("recursiveFileLookup", "true")
        with session.workspace(spark) as settle:
            changed = settle(new.select(slice_col).distinct(), "changed-slices")
            touched = newest.within_slices(everything.parquet(root), changed, slice_col)
            tables.replace_slices(compute(touched), target, [slice_col], changed)

    stream = file_stream(spark).schema(schema)
    if not by_slice:
        stream = stream.option("recursiveFileLookup", "true")
    run_to_end(
        stream.parquet(root).writeStream.foreachBatch(refresh)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
