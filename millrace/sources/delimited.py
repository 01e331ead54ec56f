"""Delimited files with per-file audit and reject capture."""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import text
from millrace.sources import ndjson

CORRUPT = "_corrupt_record"


@dataclass(frozen=True)
class StagedFiles:
    """Files below a folder: which ones, how they are written, what they hold."""

    root: str
    pattern: str
    schema: T.StructType
    options: Mapping[str, str]

    @property
    def separator(self) -> str:
        return self.options.get("sep", ",")


def read_staged(spark: SparkSession, files: StagedFiles, only: DataFrame | None = None) -> DataFrame:
    """All lines with typed columns, the raw text of damaged lines, and provenance.

    A line is damaged when a value does not fit its type or the number of
    values differs from the number of columns. `only` (file_path, file_size,
    file_modification_time) restricts the read: older files are not opened,
    others not kept. Settle the result before taking rows, status and rejects
    from it: all three then describe the same single read.
    """
    schema = T.StructType([*files.schema.fields, T.StructField(CORRUPT, T.StringType())])
    lines = (
        spark.read.schema(schema)
        .options(**files.options)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", files.pattern)
        # a line is judged by all its values, whichever columns are read later
        .option("columnPruning", "false")
        .csv(files.root)
        .select("*", *ndjson.PROVENANCE)
    )
    if only is None:
        return ndjson.in_reading_order(lines)
    first = only.where("file_size > 0").agg(F.min("file_modification_time")).first()[0]
    lines = ndjson.in_reading_order(lines.where(F.col("file_modification_time") >= F.lit(first)))
    return lines.join(only.select("file_path"), "file_path", "left_semi")


def good_rows(staged: DataFrame, fields: Mapping[str, Column]) -> DataFrame:
    """The requested target columns of the undamaged lines."""
    return staged.where(F.col(CORRUPT).isNull()).select(*[c.alias(n) for n, c in fields.items()])


def raw_values(files: StagedFiles) -> Column:
    """Number of values on a damaged line; separators inside quotes do not part values."""
    quote, escape = (re.escape(files.options.get(n, d)) for n, d in (("quote", '"'), ("escape", "\\")))
    sep = re.escape(files.separator)
    quoted = f"(^|{sep})[ \\t]*{quote}(?:{escape}.|{quote}{quote}|[^{quote}])*{quote}"
    return F.size(text.literal_split(F.regexp_replace(F.col(CORRUPT), quoted, "$1q"), files.separator))


def _misfit(files: StagedFiles) -> Column:
    """First column whose value does not fit, with the value: a struct (column, value), NULL if none is found.

    The line is parsed twice by the reader's own rules, as texts and as the
    columns' types; a text that is there and has no typed value is the culprit.
    """
    fields = files.schema.fields
    options = {**files.options, "mode": "PERMISSIVE"}
    texts = F.from_csv(F.col(CORRUPT), ", ".join(f"c{i} string" for i in range(len(fields))), options)
    typed = F.from_csv(
        F.col(CORRUPT), ", ".join(f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(fields)), options
    )
    found = [
        F.when(
            texts[f"c{i}"].isNotNull() & typed[f"c{i}"].isNull(),
            F.struct(F.lit(f.name).alias("column"), texts[f"c{i}"].alias("value")),
        )
        for i, f in enumerate(fields)
    ]
    return F.coalesce(*found)


def errors(staged: DataFrame, files: StagedFiles) -> DataFrame:
    """The damaged lines with what is wrong: error, category, code, column_name, character, byte_offset.

    character and byte_offset say where on the line the value that does not fit
    starts (from 1 and from 0); a wrong number of values starts at the line's end.
    """
    expected = len(files.schema.fields)
    bad = staged.where(F.col(CORRUPT).isNotNull()).withColumn("_found", raw_values(files))
    bad = bad.withColumn("_misfit", F.when(F.col("_found") == expected, _misfit(files)))
    wrong_count = F.col("_found") != expected
    place = F.position(F.col("_misfit.value"), F.col(CORRUPT))
    before = F.substring(F.col(CORRUPT), F.lit(1), place - 1)
    where = F.when(F.col("_misfit").isNotNull(), place).otherwise(F.length(F.col(CORRUPT)))
    return bad.select(
        "*",
        F.when(
            wrong_count, F.concat(F.lit(f"expected {expected} values, found "), F.col("_found").cast("string"))
        ).otherwise(F.lit("a value does not fit its column type")).alias("error"),
        F.when(wrong_count, "parsing").otherwise("conversion").alias("category"),
        F.when(wrong_count, "VALUE_COUNT").otherwise("VALUE_TYPE").alias("code"),
        F.col("_misfit.column").alias("column_name"),
        where.cast("bigint").alias("character"),
        F.when(F.col("_misfit").isNotNull(), F.octet_length(before)).otherwise(F.octet_length(F.col(CORRUPT)))
        .cast("bigint").alias("byte_offset"),
    ).drop("_found", "_misfit")


def listed_files(spark: SparkSession, files: StagedFiles) -> DataFrame:
    """Every matching file below the root with size and date; contents stay unread.

    The list stays distributed. A scan never opens empty files, so those come
    from the listing alone, with size 0 and no date but the start of time.
    """
    listing = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", files.pattern)
        .load(files.root)
    )
    found = listing.select(*[c for c in ndjson.PROVENANCE if "block" not in c])
    names = listing.inputFiles()
    if len(names) == found.count():
        return found
    every = spark.createDataFrame([(n,) for n in names], "file_path string")
    place = ndjson.relative_path(F.col("file_path"), files.root)
    empty = every.withColumn("place", place).join(found.select(place.alias("place")), "place", "left_anti")
    return found.unionByName(
        empty.select("file_path", F.lit(0).cast("bigint").alias("file_size"), F.timestamp_seconds(F.lit(0)).alias("file_modification_time"))
    )


DAMAGED = "_damaged"


@dataclass(frozen=True)
class Settled:
    """The lines of a load, read apart: the good ones, the damaged ones with their errors, and a narrow row for each block."""

    good: DataFrame
    errors: DataFrame
    blocks: DataFrame


def settle_staged(staged: DataFrame, files: StagedFiles, settle) -> Settled:
    """Write the lines once, good and damaged ones apart, so that rows, counts and rejects read each part once.

    Of the good lines only their place is read a second time, to number the
    blocks and count. `settle` comes from a `session.workspace`.
    """
    lines = settle(staged.withColumn(DAMAGED, F.col(CORRUPT).isNotNull()), "staged", [DAMAGED])
    block = ndjson.blocks(lines.select(*ndjson.BLOCK, "_order", DAMAGED), settle, {"_bad": F.count_if(DAMAGED)})
    wrong = settle(errors(lines.where(DAMAGED).drop(DAMAGED), files), "damaged")
    return Settled(lines.where(~F.col(DAMAGED)).drop(DAMAGED), wrong, block)


def load_status(
    spark: SparkSession, parts: Settled, files: StagedFiles, listed: DataFrame | None = None
) -> DataFrame:
    """Per file: status, lines parsed and loaded, errors seen, and the first error by place in the file.

    Lines were counted by block, so one dominant file is no bottleneck. `listed`
    are the files to report on (default: all), empty ones too.
    """
    counted = parts.blocks.groupBy("file_path").agg(
        F.sum("_lines").alias("rows_parsed"), F.sum(F.col("_lines") - F.col("_bad")).alias("row_loaded")
    )
    place = ("file_block_start", "_order", "error", "character", "column_name")
    first = parts.errors.groupBy("file_path").agg(F.min(F.struct(*place)).alias("e"))
    block = parts.blocks.select(*ndjson.BLOCK, "_first", "_shift")
    first = first.withColumn("file_block_start", F.col("e.file_block_start")).join(block, ndjson.BLOCK).select(
        "file_path",
        F.col("e.error").alias("first_error"),
        (F.col("e._order") - F.col("_first") + F.col("_shift") + 1 + _header(files)).alias("first_error_line"),
        F.col("e.character").alias("first_error_character"),
        F.col("e.column_name").alias("first_error_column_name"),
    )
    every = listed_files(spark, files) if listed is None else listed
    every = every.select("file_path").join(counted, "file_path", "left").join(first, "file_path", "left")
    every = every.fillna(0, ["rows_parsed", "row_loaded"])
    seen = F.col("rows_parsed") - F.col("row_loaded")
    status = F.when(seen == 0, "LOADED").when(F.col("row_loaded") == 0, "LOAD_FAILED").otherwise("PARTIALLY_LOADED")
    return every.select(
        ndjson.relative_path(F.col("file_path"), files.root).alias("file"),
        status.alias("status"),
        "rows_parsed",
        "row_loaded",
        F.lit(None).cast("bigint").alias("error_limit"),
        seen.alias("errors_seen"),
        "first_error",
        "first_error_line",
        "first_error_character",
        "first_error_column_name",
    )


def _header(files: StagedFiles) -> int:
    return 1 if str(files.options.get("header", "false")).lower() == "true" else 0


def rejects(parts: Settled, files: StagedFiles) -> DataFrame:
    """Damaged lines with place and kind of the error, and two blank columns for the fix."""
    block = parts.blocks.select(*ndjson.BLOCK, "_first", "_shift")
    number = F.col("_order") - F.col("_first") + F.col("_shift") + 1
    return parts.errors.join(block, ndjson.BLOCK).select(
        "error",
        ndjson.relative_path(F.col("file_path"), files.root).alias("file"),
        (number + _header(files)).alias("line"),
        "character",
        "byte_offset",
        "category",
        "code",
        "column_name",
        number.alias("row_number"),
        (number + _header(files)).alias("row_start_line"),
        F.col(CORRUPT).alias("rejected_record"),
        F.lit(" ").alias("fixed_status"),
        F.lit(" ").alias("action_taken"),
    )


def verdict(status: DataFrame) -> DataFrame:
    """One row: overall outcome of a load from its per-file status."""
    totals = status.agg(
        F.count("*").alias("files"),
        F.coalesce(F.sum("row_loaded"), F.lit(0)).alias("rows_loaded"),
        F.coalesce(F.sum("errors_seen"), F.lit(0)).alias("errors"),
    )
    outcome = (
        F.when(F.col("files") == 0, "no files processed")
        .when(F.col("errors") > 0, "not all rows loaded")
        .otherwise("loaded")
    )
    return totals.withColumn("outcome", outcome)
