"""The newest version of every record, kept up to date batch by batch.

A load has to know whether a row is the newest of its record anywhere, also in slices loaded long
ago. Instead of grouping the whole history for every load, the newest clock of each record is kept
in a keyed table: a load reads its own slices and the buckets of that table that its records are in.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import session
from millrace.sources import keyed

RECORD, CLOCK = "record", "clock"


class NewestVersions:
    """Newest value of `clock` for each combination of `keys` over all batches merged so far."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], clock: str, buckets: int | None = None):
        self.spark, self.keys, self.clock = spark, list(keys), clock
        self.table, self.buckets = keyed.KeyedTable(spark, path), buckets

    def exists(self) -> bool:
        return self.table.manifest() is not None

    def _record(self) -> Column:
        """One text for a combination of keys; no two share it, and it neither begins nor ends with a blank."""
        return F.to_json(F.struct(*[F.col(f"`{k}`").cast("string").alias(k) for k in self.keys]))

    def _newest(self, rows: DataFrame) -> DataFrame:
        known = rows.dropna(subset=[*self.keys, self.clock])
        return known.groupBy(self._record().alias(RECORD)).agg(F.max(F.col(f"`{self.clock}`")).alias(CLOCK))

    def merge(self, batch: DataFrame, batch_id: str) -> DataFrame:
        """Rows of `batch` with the newest clock their key has in it or in any batch before; ties stay.

        The batch is remembered under its id, so merging it again gives the same rows, unless a newer
        version has come meanwhile. Rows with a NULL key or clock are never the newest.
        """
        with session.workspace(self.spark) as settle:
            arrived = settle(self._newest(batch), "arrived")
            state = self.table.manifest()
            if state is None:
                self.table.replace(arrived, [RECORD], batch_id, self.buckets)
                state = self.table.manifest()
            else:
                old = self.table.read(self._touched(arrived, state)).withColumnRenamed(CLOCK, "_old")
                newer = arrived.join(old, RECORD, "left").where(F.col("_old").isNull() | (F.col(CLOCK) > F.col("_old")))
                self.table.replace(newer.select(RECORD, CLOCK), [RECORD], batch_id)
            touched = self._touched(arrived, state)
        current = self.table.read(touched).toDF("_record", "_clock")
        is_it = (self._record() == F.col("_record")) & (F.col(f"`{self.clock}`") == F.col("_clock"))
        return batch.join(current, is_it, "left_semi")

    def _touched(self, arrived: DataFrame, state: keyed.Manifest) -> list[int]:
        """The buckets that the records are in: at most as many numbers as the table has buckets."""
        return [row[0] for row in arrived.select(keyed.key_bucket([RECORD], state.buckets)).distinct().collect()]


def within_slices(rows: DataFrame, slices: DataFrame, gate: str) -> DataFrame:
    """Rows whose `gate` is one of `slices` (NULL is a slice too).

    The least and the greatest slice reach the scan as a filter, whatever their number, so files and
    partitions outside are not read; the rest is a semi join.
    """
    edge = slices.agg(F.min(gate).alias("a"), F.max(gate).alias("b"), F.count_if(F.col(gate).isNull()).alias("n")).first()
    inside = F.lit(False) if edge.a is None else F.col(gate).between(edge.a, edge.b)
    if edge.n:
        inside = inside | F.col(gate).isNull()
    new = slices.select(F.col(gate).alias("_slice")).distinct()
    return rows.where(inside).join(new, F.col(gate).eqNullSafe(F.col("_slice")), "left_semi")
