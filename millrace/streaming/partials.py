"""Marts kept up to date from stored partial sums.

Every file of a source is reduced once to sums of the finest grain that the mart needs; they are kept
in a keyed table under the file's path. When files arrive, change or go, only new and changed ones are
read: their sums replace what the table has for them, and the slices that any of these files had or
has rows in are added up from the stored sums of all files. Nothing is read a second time.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import session
from millrace.sources import keyed, newest, runs, tables
from millrace.sources.generations import Generations

FILE, SIZE, TIME = "source_file", "source_size", "source_time"
IDENTITY = [FILE, SIZE, TIME]
MERGE = {"sum": F.sum, "min": F.min, "max": F.max}


class FileState:
    """What is kept of each Parquet file below `root`, in one table keyed by the file's path.

    Rows say that a file was read (`is_file` true), that it is gone (NULL), or what it holds (false).
    """

    def __init__(self, spark: SparkSession, root: str, schema, state: str, buckets: int | None = None):
        self.spark, self.root, self.schema, self.buckets = spark, root, schema, buckets
        self.table = keyed.KeyedTable(spark, f"{state}/partials")
        self.pending = runs.PendingWork(spark, f"{state}/pending")

    def _listed(self) -> DataFrame:
        """Path, size and date of every file below the root, without their contents."""
        files = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
        about = [F.col("_metadata.file_path"), F.col("_metadata.file_size"), F.col("_metadata.file_modification_time")]
        return files.load(self.root).select(*[c.alias(n) for c, n in zip(about, IDENTITY)])

    def _stored(self) -> DataFrame | None:
        return self.table.read() if self.table.manifest() is not None else None

    def _work(self, stored: DataFrame | None) -> DataFrame:
        """Files to read (`gone` false) and files that are no longer there."""
        listed = self._listed().withColumn("gone", F.lit(False))
        if stored is None:
            return listed
        known = stored.where("is_file").select(*IDENTITY)
        lost = known.join(listed, FILE, "left_anti").withColumn("gone", F.lit(True))
        return listed.join(known, IDENTITY, "left_anti").unionByName(lost)

    def _rows(self, files: DataFrame) -> DataFrame:
        """All rows of the files that are there, and no others."""
        decoded = F.try_url_decode(F.replace(FILE, F.lit("+"), F.lit("%2B")))
        paths = [row[0] for row in files.where("not gone").select(decoded).collect()]  # as the scan itself lists them
        reader = self.spark.read.schema(self.schema).option("basePath", self.root)
        return reader.parquet(*paths) if paths else reader.parquet(self.root).limit(0)

    def _marked(self, kept: DataFrame, files: DataFrame) -> DataFrame:
        """What is kept, and one row for each file that says it was read (is_file), or that it is gone (NULL)."""
        return kept.withColumn("is_file", F.lit(False)).unionByName(
            files.withColumn("is_file", F.when(~F.col("gone"), True)).drop("gone"), allowMissingColumns=True
        )


class PartialSums(FileState):
    """Mergeable sums of the Parquet files below `root`.

    by        grouping columns of the finest grain, the slice among them
    measures  name to (`sum` | `min` | `max`, input): what can be merged again; a count is a sum of ones
    """

    def __init__(
        self, spark: SparkSession, root: str, schema, state: str, slice_col: str, by: Sequence[str],
        measures: Mapping[str, tuple[str, Column]], buckets: int | None = None,
    ):
        super().__init__(spark, root, schema, state, buckets)
        self.slice_col, self.by, self.measures = slice_col, list(by), dict(measures)
        if slice_col not in self.by:
            raise ValueError(f"{slice_col} must be among the grouping columns")
        self.slices = Generations(spark, f"{state}/slices")

    def _reduced(self, files: DataFrame) -> DataFrame:
        """Sums of the files, and a row for each file."""
        sums = self._rows(files).groupBy(F.col("_metadata.file_path").alias(FILE), *self.by).agg(
            *[MERGE[how](value).alias(name) for name, (how, value) in self.measures.items()]
        )
        return self._marked(sums, files)

    def update(self) -> tuple[DataFrame, str] | None:
        """Take in files that are new, have changed or are gone; the slices to add up again, and the run. None for no such file.

        Ends with `finish`. A run that died is taken up with the same files and the same slices.
        """
        work = self.pending.stored()
        stored = self._stored()
        if work is None:
            work = self.pending.begin(self._work(stored))
        if work is None:
            return None
        files, run = work
        mark = self.slices.newest()
        if mark is None or mark.note != run:
            with session.workspace(self.spark) as settle:
                reduced = settle(self._reduced(files), "partials")
                had = reduced
                if stored is not None:
                    had = had.unionByName(stored.join(files.select(FILE), FILE, "left_semi"))
                # written before the old sums give way, so that a slice that a file has left is known
                self.slices.write({"slices": had.where("not is_file").select(self.slice_col).distinct()}, run)
                self.table.replace(reduced, [FILE], run, self.buckets)
        else:  # does nothing where the sums were stored
            self.table.replace(self._reduced(files), [FILE], run, self.buckets)
        return self.slices.table("slices"), run

    def finish(self) -> None:
        """The slices of the last `update` are stored in the mart."""
        self.pending.finish()

    def current(self, slices: DataFrame) -> DataFrame:
        """The sums of all files in these slices, merged: columns `by` and the measures."""
        rows = newest.within_slices(self.table.read().where("not is_file"), slices, self.slice_col)
        return rows.groupBy(*self.by).agg(*[MERGE[how](name).alias(name) for name, (how, _) in self.measures.items()])


def refresh(
    spark: SparkSession, sources: Mapping[str, PartialSums], target: str, slice_col: str, compute: Callable[..., DataFrame]
) -> None:
    """Bring the mart at `target` up to date: `compute` gets each source's merged sums under its name.

    Slices that any source touches are recomputed from all sources' sums and swapped in; those that
    come out empty are emptied. A run that died is repeated to the same result.
    """
    touched = [found[0] for found in (s.update() for s in sources.values()) if found is not None]
    if not touched:
        return
    slices = reduce(DataFrame.unionByName, touched).distinct()
    if all(s.table.manifest() is not None for s in sources.values()):
        rows = compute(**{name: s.current(slices) for name, s in sources.items()})
        tables.replace_slices(rows, target, [slice_col], slices)
    for source in sources.values():
        source.finish()
