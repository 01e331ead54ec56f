"""Column profiles kept up to date file by file.

Every file of a table is read once: its counts, minima and maxima go into one row and its distinct values
(numbers as they are, texts as digests) into arrays of some rows more, all under the file's path. A profile
merges what is kept of all files; it equals one that reads the whole table. New and changed files replace
what was kept of them, files that are gone leave it. With `sketches` a file keeps one mergeable sketch for each
column in place of its distinct values: distinct counts are estimates then, and the state stays small.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators import profile
from millrace.streaming.partials import FILE, FileState


class StoredProfile(FileState):
    """Mergeable profile of the Parquet files below `root`; the schema and `blanks_are_null` must stay the same.

    The distinct values of a file's column are kept in arrays, one for each task that found some of them; nothing is dropped.
    With `sketches` they are one row of bounded size for each column (`operators.profile.column_sketches`);
    everything but the distinct counts stays exact. A state of the other kind, or with a row for each value, is refused. An empty folder, or one whose files have no rows, gives the profile of an empty table.
    """

    def __init__(
        self, spark: SparkSession, root: str, schema: T.StructType, state: str, blanks_are_null: bool = True,
        buckets: int | None = None, sketches: bool = False,
    ):
        super().__init__(spark, root, schema, state, buckets)
        if FILE in schema.names:
            raise ValueError(f"a profiled table cannot have a column {FILE}")
        self.blanks_are_null, self.sketches = blanks_are_null, sketches

    def _stored(self) -> DataFrame | None:
        stored = super()._stored()
        if stored is not None and (profile.SKETCH in stored.columns) != self.sketches:
            raise ValueError("the stored profile keeps " + ("values, not sketches" if self.sketches else "sketches, not values"))
        if stored is not None and not self.sketches and not isinstance(stored.schema["number"].dataType, T.ArrayType):
            raise ValueError("the stored profile keeps a row for each value: take a new folder for the state")
        return stored

    def _values(self, rows: DataFrame, files: DataFrame) -> DataFrame:
        """The distinct values of each file and column in arrays, each holding what one task has of them.

        A digest stands for the path while values are sorted out one by one; a seed is taken that tells all files apart.
        """
        there, seed = files.where("not gone"), 0
        while True:
            digest = F.xxhash64(FILE, F.lit(seed))
            found = there.agg(F.count_distinct(digest).alias("digests"), F.count_distinct(FILE).alias("paths")).first()
            if found.digests == found.paths:
                break
            seed += 1
        values = profile.column_values(rows.withColumn(FILE, digest), by=[FILE]).distinct()
        packed = values.groupBy(F.col(FILE).alias("digest_of_path"), "slot", F.spark_partition_id().alias("task")).agg(
            *[F.collect_list(v).alias(v) for v in profile.VALUE]
        )
        paths = there.select(FILE, digest.alias("digest_of_path"))
        return paths.join(packed, "digest_of_path").select(FILE, "slot", *profile.VALUE)

    def _kept(self, files: DataFrame) -> DataFrame:
        """One row of facts for each file (no `slot`) and the rows of its distinct values, or of its columns' sketches."""
        rows = self._rows(files).select(F.col("_metadata.file_path").alias(FILE), "*")
        facts = profile.typed_facts(rows, self.blanks_are_null, by=[FILE])
        found = profile.column_sketches(rows, [FILE]) if self.sketches else self._values(rows, files)
        return self._marked(facts.unionByName(found, allowMissingColumns=True), files)

    def update(self) -> int:
        """Take in files that are new, have changed or are gone; returns how many. A run that died is taken up with the same files."""
        work = self.pending.stored() or self.pending.begin(self._work(self._stored()))
        if work is None:
            return 0
        files, run = work
        self.table.replace(self._kept(files), [FILE], run, self.buckets)
        count = files.count()
        self.pending.finish()
        return count

    def state(self) -> tuple[T.StructType, DataFrame, DataFrame]:
        """Schema, facts and values of all files, for `operators.profile.profile_states`."""
        stored = self._stored()
        if stored is None:
            none = self.spark.createDataFrame([], self.schema)
            found = profile.column_sketches(none) if self.sketches else profile.column_values(none)
            return self.schema, profile.typed_facts(none, self.blanks_are_null), found
        kept = stored.where("not is_file")
        found = kept.where("slot is not null")
        if not self.sketches:
            # of the three arrays one is filled
            found = found.selectExpr("slot", f"inline(arrays_zip({', '.join(profile.VALUE)}))")
        return self.schema, kept.where("slot is null"), found


def profile_run(sources: Mapping[str, StoredProfile], *, run_id: str, **options) -> DataFrame:
    """Bring every source up to date and profile them under one run id (options as `profile_states`)."""
    for source in sources.values():
        source.update()
    return profile.profile_states({name: s.state() for name, s in sources.items()}, run_id=run_id, **options)
