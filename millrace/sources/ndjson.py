"""Newline-delimited JSON documents with file provenance."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace import session

Settle = Callable[[DataFrame, str], DataFrame]

RAW_COLUMNS = [
    "file_name",
    "file_row_number",
    "file_content_key",
    "file_last_modified",
    "start_scan_time",
    "file_resource_type",
    "file_record_id",
    "file_content_raw",
    "load_dt",
]

PROVENANCE = [
    "_metadata.file_path",
    "_metadata.file_size",
    "_metadata.file_block_start",
    "_metadata.file_modification_time",
]


def relative_path(path: Column, root: str) -> Column:
    """Decoded file path below `root` (any scheme prefix is ignored)."""
    plain = F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    marker = "/" + root.split("://")[-1].removeprefix("file:").strip("/") + "/"
    return F.substring_index(plain, marker, -1) if marker != "//" else plain


def in_reading_order(lines: DataFrame) -> DataFrame:
    """Marks the order in which a scan delivers its lines (`_order`)."""
    return lines.withColumn("_order", F.monotonically_increasing_id())


BLOCK = ["file_path", "file_block_start"]


def blocks(lines: DataFrame, settle: Settle = session.settle, more: Mapping[str, Column] | None = None) -> DataFrame:
    """One row for each block a scan reads: its first `_order`, its lines, those before it in the file, the file's content key.

    `more` are further aggregates of the block's lines.
    Large files are read in blocks; within a block the lines come in file order
    and consecutively. Only this narrow summary is shuffled, never a line. It is
    stored, so that joining it back broadcasts it while it is small by the size
    of its files. The content key is the same for files with the same lines in
    the same order: two hashes of each line are added up, alone and multiplied
    by the line's place. Places count from the block's first line; what a block
    lacks to the file's is its offset times its sum, so blocks of any size give
    the same key.
    """
    bits = (1 << 48) - 1
    place = F.col("_order").bitwiseAND((1 << 33) - 1)  # inside a task the lower bits number the lines
    hashes = [F.xxhash64("value"), F.xxhash64(F.lit(1), "value")] if "value" in lines.columns else []
    sums = {}
    for n, value in enumerate(hashes):
        one = value.bitwiseAND(bits).cast("decimal(38,0)")
        sums |= {f"_sum{n}": F.sum(one), f"_placed{n}": F.sum(F.try_multiply(one, place.cast("decimal(10,0)")).cast("decimal(38,0)"))}
    counted = lines.groupBy(*BLOCK).agg(
        F.min("_order").alias("_first"), F.count("*").alias("_lines"), *[c.alias(n) for n, c in (sums | dict(more or {})).items()]
    )
    file = Window.partitionBy("file_path")
    earlier = file.orderBy("file_block_start").rowsBetween(Window.unboundedPreceding, -1)
    shifted = counted.withColumn("_shift", F.coalesce(F.sum("_lines").over(earlier), F.lit(0)))
    first = F.col("_first").bitwiseAND((1 << 33) - 1)
    parts = [F.sum("_lines").over(file).cast("string")]
    for n in range(len(hashes)):
        moved = F.col(f"_placed{n}") + F.col(f"_sum{n}") * (F.col("_shift") - first).cast("decimal(20,0)")
        parts += [F.sum(f"_sum{n}").over(file).cast("string"), F.sum(moved.cast("decimal(38,0)")).over(file).cast("string")]
    return settle(
        shifted.select(*BLOCK, "_first", "_lines", "_shift", *(more or {}), F.sha2(F.concat_ws("|", *parts), 256).alias("file_content_key")), "blocks"
    )


def with_line_numbers(lines: DataFrame, name: str = "line", settle: Settle = session.settle) -> DataFrame:
    """Adds the 1-based line number within each file, and the file's content key, without a shuffle of lines.

    A line's place in its block is its distance from the block's first line.
    Lines that were stored since they were read bring their order in `_order`.
    """
    marked = lines if "_order" in lines.columns else in_reading_order(lines)
    return (
        marked.join(blocks(marked, settle), BLOCK)
        .withColumn(name, F.col("_order") - F.col("_first") + F.col("_shift") + 1)
        .drop("_order", "_first", "_lines", "_shift")
    )


def read_lines(reader, root: str, pattern: str = "*.ndjson") -> DataFrame:
    """Lines of all matching files below `root`; `reader` is `spark.read` or `spark.readStream`."""
    return (
        reader.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .text(root)
        .select("value", *PROVENANCE)
    )


def documents(
    lines: DataFrame,
    root: str,
    load_date: Column,
    scan_time: Column,
    line_numbers: bool = True,
    settle: Settle = session.settle,
) -> DataFrame:
    """Raw document rows from lines: one per parsable JSON line.

    Unparsable and blank lines are left out and do not stop the load. Without
    `line_numbers` the row number is NULL.
    """
    lines = with_line_numbers(lines, "file_row_number", settle)
    if not line_numbers:
        lines = lines.withColumn("file_row_number", F.lit(None).cast("bigint"))
    parsed = lines.withColumn("_doc", F.try_parse_json("value")).where("_doc IS NOT NULL")

    def lifted(path: str) -> Column:
        return F.coalesce(F.try_variant_get("_doc", path, "string"), F.lit(" "))

    return parsed.select(
        relative_path(F.col("file_path"), root).alias("file_name"),
        "file_row_number",
        "file_content_key",
        F.col("file_modification_time").alias("file_last_modified"),
        scan_time.alias("start_scan_time"),
        lifted("$.resourceType").alias("file_resource_type"),
        lifted("$.id").alias("file_record_id"),
        F.col("value").alias("file_content_raw"),
        load_date.alias("load_dt"),
    )


def ingest(
    spark: SparkSession,
    root: str,
    *,
    pattern: str = "*.ndjson",
    base: str | None = None,
    load_date: Column | None = None,
    line_numbers: bool = True,
) -> DataFrame:
    """Read every matching file below `root` into the raw document layout.

    `base` is the folder file names are relative to (default `root`).
    """
    return documents(
        read_lines(spark.read, root, pattern),
        base or root,
        F.current_date() if load_date is None else load_date,
        F.current_timestamp(),
        line_numbers,
    )


def write_raw(raw: DataFrame, target: str, mode: str = "append") -> None:
    """Store raw documents so that readers prune by resource type and load date."""
    raw.write.mode(mode).partitionBy("file_resource_type", "load_dt").parquet(target)
