"""Provider resources: raw JSON documents to flat, versioned tables.

Each resource is described by data (`resource_specs`): what to parse, which
arrays fold to columns, which arrays become row keys. One plan runs them all:

1. keep the load slices the target lacks, and of those the newest version of
   each record (newest over *all* raw rows, so a late old file changes nothing;
   loads keep a table of the newest versions for that, see `sources.newest`);
2. parse the JSON once into typed structs holding only the fields read;
3. fold every independent array inside the row (`functions.nested`);
4. unfold only arrays that provide grouping keys, then aggregate by key, which
   merges documents tied on their modification time;
5. one row per network where the resource asks for it;
6. replace the target rows of the same records (`sources.keyed.replace_keys`).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import nested, text
from millrace.operators import flatten, versions
from millrace.sources import keyed, newest, runs, tables

RECORD_KEYS = ["file_record_id", "file_export_type"]
EXPORT_SEGMENT = 3
BUNDLE_SEGMENT = 5


@dataclass(frozen=True)
class Shape:
    """SQL expressions of a resource, in the order they are applied.

    branches    folded arrays of the parsed document `doc`
    tops        MAX columns known per document
    sets        distinct value arrays per document, with the finishing expression (`{}` = the set)
    unfold      arrays turned into rows (an empty one still gives one row)
    unfold_only arrays turned into rows (an empty one drops the document)
    derived     columns parsed out of an unfolded element, each may read the previous
    doc_keys    grouping keys beyond record, export type and load date
    keys        grouping keys read from unfolded elements
    late_tops   MAX columns that depend on an unfolded element
    finals      columns computed from tops and late tops of the aggregated row
    rows_from   name of the set that yields one output row per value
    """

    tops: Mapping[str, str]
    branches: Mapping[str, str] = field(default_factory=dict)
    sets: Mapping[str, tuple[str, str]] = field(default_factory=dict)
    unfold: Mapping[str, str] = field(default_factory=dict)
    unfold_only: Mapping[str, str] = field(default_factory=dict)
    derived: Mapping[str, str] = field(default_factory=dict)
    doc_keys: Mapping[str, str] = field(default_factory=dict)
    keys: Mapping[str, str] = field(default_factory=dict)
    late_tops: Mapping[str, str] = field(default_factory=dict)
    finals: Mapping[str, str] = field(default_factory=dict)
    rows_from: str | None = None


@dataclass(frozen=True)
class Resource:
    """A resource type: JSON fields to read, expressions, output layout."""

    kind: str
    schema: str
    shape: Shape
    layout: Sequence[str]
    latest_by: Sequence[str] = tuple(RECORD_KEYS)


def with_export_type(raw: DataFrame) -> DataFrame:
    return raw.withColumn("file_export_type", text.segment(F.col("file_name"), EXPORT_SEGMENT))


ALONE = "alone"  # marks a document whose record has no other one of the same modification time


def current_documents(
    raw: DataFrame, resource: Resource, processed: DataFrame | None = None
) -> DataFrame:
    """Newest documents of the resource, from load slices not yet `processed`, with the mark ALONE."""
    rows = with_export_type(raw.where(F.col("file_resource_type") == resource.kind))
    batch = rows if processed is None else versions.gate_new_slices(rows, processed, "load_dt")
    return versions.latest_marked(rows, resource.latest_by, "file_last_modified", within=batch, name=ALONE)


def named(expressions: Mapping[str, str]) -> list[Column]:
    """SQL expressions as named columns."""
    return [F.expr(x).alias(n) for n, x in expressions.items()]


def _merged(values: str) -> Column:
    """Union of the value arrays of the tied documents of a group."""
    return F.array_distinct(F.flatten(F.collect_set(values)))


def _keyed_by_element(shape: Shape) -> bool:
    """Whether the unfolded elements are the keys themselves, so that distinct ones of a document are its groups."""
    unfolded = {**shape.unfold, **shape.unfold_only}
    return not shape.derived and not shape.late_tops and all(shape.keys.get(n) == n for n in unfolded) and len(shape.keys) == len(unfolded)


def flatten_documents(docs: DataFrame, resource: Resource) -> DataFrame:
    """Flat rows of already selected documents.

    Documents marked ALONE have nothing to be merged with: where keys are whole elements, their rows
    are final as they are unfolded, and only the others are grouped, which would move and sort every
    column of every row.
    """
    if ALONE not in docs.columns:
        return _flattened(docs, resource, merged=True)
    if not _keyed_by_element(resource.shape):
        return _flattened(docs.drop(ALONE), resource, merged=True)
    alone = _flattened(docs.where(F.col(ALONE)).drop(ALONE), resource, merged=False)
    return alone.unionAll(_flattened(docs.where(~F.col(ALONE)).drop(ALONE), resource, merged=True))


def _finished(rows: DataFrame, shape: Shape) -> DataFrame:
    finished = {n: finish.format(n) for n, (_, finish) in shape.sets.items()}
    finished.update(shape.finals)
    return rows.withColumns({n: F.expr(x) for n, x in finished.items()}) if finished else rows


def _flattened(docs: DataFrame, resource: Resource, merged: bool) -> DataFrame:
    """Flat rows, tied documents `merged`; without that every document must be the only one of its record."""
    shape = resource.shape
    ids = ["file_export_type", "file_record_id", "load_dt"]
    # named twice, or Spark draws the making of the text into the parser, whose arguments are interpreted
    content = F.col("file_content_raw")
    rows = docs.select(*ids, F.when(content.isNotNull(), F.from_json(content, resource.schema)).alias("doc"))
    rows = rows.select("*", *named(shape.branches))

    tops = {
        "version_id": "doc.meta.versionId",
        "last_updtd_ts": "doc.meta.lastUpdated",
        "profile_type": nested.tail("doc.id", "-"),
        **shape.tops,
    }
    tops = {n: c for n, c in tops.items() if n not in shape.doc_keys}
    unfolded = {**shape.unfold, **shape.unfold_only}
    per_document = [*ids, *shape.doc_keys, *tops, *shape.sets]
    rows = rows.select(
        *ids,
        *named({**shape.doc_keys, **tops, **unfolded}),
        *named({n: values for n, (values, _) in shape.sets.items()}),
    )
    if not merged:
        rows = rows.withColumns({n: F.coalesce(F.array_distinct(n), F.array()) for n in shape.sets} | {n: F.array_distinct(n) for n in unfolded})
        rows = _finished(rows, shape)  # before they are unfolded: once for each document
    for name in unfolded:
        rows = flatten.flatten_parsed(rows, name) if name in shape.unfold_only else rows.withColumn(name, F.explode_outer(name))
    for name, parsed in shape.derived.items():
        rows = rows.withColumn(name, F.expr(parsed))
    if unfolded:
        early = [] if merged else [n for n in shape.finals if n not in per_document]
        rows = rows.select(*per_document, *early, *named({**shape.keys, **shape.late_tops}))

    flat = rows
    if merged:
        grouped = rows.groupBy(*ids, *shape.doc_keys, *shape.keys).agg(
            *[F.max(n).alias(n) for n in (*tops, *shape.late_tops)],
            *[_merged(n).alias(n) for n in shape.sets],
        )
        flat = _finished(grouped, shape)
    if shape.rows_from:
        flat = flatten.flatten_parsed(flat, shape.rows_from)
    return flat.select(*resource.layout)


def flatten_resource(
    raw: DataFrame, resource: Resource, processed: DataFrame | None = None
) -> DataFrame:
    """Flat rows of the newest documents in the slices not yet processed."""
    return flatten_documents(current_documents(raw, resource, processed), resource)


def load_resource(
    spark: SparkSession,
    raw: DataFrame,
    resource: Resource,
    target: str,
    log: str,
    buckets: int | None = None,
    gate: str = "load_dt",
    arrived: DataFrame | None = None,
) -> DataFrame:
    """Bring the flat table at `target` up to date with `raw`; returns the slices that were processed.

    `log` holds the processed values of `gate`: load dates for a raw table that
    is filled once a day, `ingest_batch` for one that grows at any time. Slices
    to load are those of `arrived` (a table with a column `gate`), else all of
    `raw`, that the log lacks. Only their rows are read in full: which of them
    are the newest of their record anywhere comes from a stored table beside the
    log (`sources.newest`), built once from the slices logged so far where it is
    missing. The pending slices are stored before the target is touched and
    logged after it was replaced; a run that died is taken up by the next one
    with the same slices, also if more has arrived meanwhile. A slice whose rows
    were all superseded later still counts as processed.
    """
    kind = raw.schema[gate].dataType
    rows = with_export_type(raw.where(F.col("file_resource_type") == resource.kind))
    layout = T.StructType([T.StructField(gate, kind)])
    processed = spark.read.parquet(log) if tables.path_exists(spark, log) else spark.createDataFrame([], layout)
    pending = runs.PendingWork(spark, f"{log}_work/pending")
    work = pending.stored() or pending.begin(versions.new_slices(rows if arrived is None else arrived, processed, gate))
    if work is None:
        return spark.createDataFrame([], layout)
    slices, run = work
    known = newest.NewestVersions(spark, f"{log}_work/newest", resource.latest_by, "file_last_modified", buckets)
    if not known.exists() and not processed.isEmpty():
        known.merge(newest.within_slices(rows, processed, gate), "before")
    chosen = known.merge(newest.within_slices(rows, slices, gate), run)
    keyed.replace_keys(flatten_documents(chosen, resource), target, RECORD_KEYS, run, buckets)
    new = spark.createDataFrame(slices.collect(), slices.schema)  # one short value for each slice
    new.join(processed.alias("p"), new[gate].eqNullSafe(F.col(f"p.{gate}")), "left_anti").write.mode("append").parquet(log)
    pending.finish()
    return new
