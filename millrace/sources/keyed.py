"""Tables whose rows are replaced by key: a base, batches written beside it, and a manifest.

A batch replaces all rows that share a key with it. Only the batch itself is written; readers take
each key's rows from the newest batch that has the key, else from the base. Once the batches have
grown to a share of the base they are folded into a new one, so the cost of folding stays in
proportion to what arrives; many small batches are folded into one before that. The manifest, a
note in `generations`, names the folders that count, so it needs neither success markers nor
renames, and a crash at any step leaves the table as it was before the batch or after it.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import session
from millrace.sources import tables
from millrace.sources.generations import Generations

BUCKET = "key_bucket"
BUCKETS = 64
FOLD_SHARE = 0.25  # rows of the batches, of those of the base, above which they are folded into it
MAX_BATCHES = 8  # batches beside the base; beyond, they are folded into one
REMEMBERED = 64  # batches that are known to be done when they come again


@dataclass
class Manifest:
    """What the table consists of. Folders are relative to the table's data folder, batches oldest first."""

    keys: list[str]
    buckets: int
    schema: dict
    base: str
    base_rows: int
    batches: list[str] = field(default_factory=list)
    batch_rows: int = 0
    done: list[str] = field(default_factory=list)
    replaced: list[str] = field(default_factory=list)  # folders of the generation before, to be emptied by the next writer


def key_bucket(keys: Sequence[str], buckets: int) -> Column:
    """Partition number of a trimmed key."""
    return F.pmod(F.xxhash64(*[F.trim(F.col(k)) for k in keys]), F.lit(buckets)).cast("int")


class KeyedTable:
    """One writer at a time; readers see whole batches only, in the state of the newest manifest."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.generations = Generations(spark, f"{self.path}/_manifest")

    def manifest(self) -> Manifest | None:
        """None for a new table. Data of another layout in the folder is an error, not an empty table."""
        mark = self.generations.newest()
        if mark is not None:
            return Manifest(**json.loads(mark.note))
        if tables.path_exists(self.spark, self.path):
            files = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(self.path).select("path")
            if not files.where(~F.contains("path", F.lit("/data/"))).isEmpty():
                raise ValueError(f"{self.path} has files but no manifest")
        return None

    def replace(self, batch: DataFrame, keys: Sequence[str], batch_id: str, buckets: int | None = None) -> None:
        """Delete rows whose trimmed key is in `batch` and add the batch; the same `batch_id` again changes nothing."""
        known = self.manifest()
        if known and buckets and known.buckets != buckets:
            raise ValueError(f"{self.path} has {known.buckets} buckets, not {buckets}")
        if known and known.keys != list(keys):
            raise ValueError(f"{self.path} has the keys {known.keys}, not {list(keys)}")
        if known and batch_id in known.done:
            return
        folder = "b" + hashlib.sha256(batch_id.encode()).hexdigest()[:24]
        count = known.buckets if known else buckets or BUCKETS
        rows = batch.withColumn(BUCKET, key_bucket(keys, count))
        if known:
            self._empty(known)
            rows = rows.select(*[f["name"] for f in known.schema["fields"]], BUCKET)
        self._write(rows, folder, whole=known is None)
        if known is None:
            state = Manifest(list(keys), count, json.loads(batch.schema.json()), folder, 0)
            state.base_rows = self._rows(state, folder).count()
        else:
            added = self._rows(known, folder).count()
            state = Manifest(**{**asdict(known), "batches": [*known.batches, folder], "batch_rows": known.batch_rows + added, "replaced": []})
        state.done = [*state.done, batch_id][-REMEMBERED:]
        self._store(state)
        self._fold(state)

    def _write(self, rows: DataFrame, folder: str, whole: bool) -> None:
        writer = rows.hint("rebalance", BUCKET).write.mode("overwrite")
        # a batch has few rows in many buckets: its files are not split by them
        (writer.partitionBy(BUCKET) if whole else writer).parquet(self._data(folder))

    def _data(self, folder: str) -> str:
        return f"{self.path}/data/{folder}"

    def _rows(self, state: Manifest, folder: str) -> DataFrame:
        schema = T.StructType.fromJson(state.schema).add(BUCKET, T.IntegerType())
        return self.spark.read.schema(schema).parquet(self._data(folder))

    def _store(self, state: Manifest) -> None:
        self.generations.write({}, json.dumps(asdict(state)))

    def _empty(self, state: Manifest) -> None:
        """Empty the folders that the last manifest has left behind; readers of the one before are gone by now."""
        for folder in state.replaced:
            session.release(self.spark.createDataFrame([], T.StructType.fromJson(state.schema)), self._data(folder))

    def _fold(self, state: Manifest) -> None:
        """Fold the batches into a new base, or into one batch, where there is enough to fold."""
        name = f"f{self.generations.newest().number + 1}"
        if state.batch_rows > FOLD_SHARE * state.base_rows:
            self._write(self._current(state, [state.base, *state.batches]), name, whole=True)
            rows = self._rows(state, name).count()
            change = {"base": name, "base_rows": rows, "batches": [], "batch_rows": 0, "replaced": [state.base, *state.batches]}
        elif len(state.batches) > MAX_BATCHES:
            self._write(self._current(state, state.batches), name, whole=False)
            change = {"batches": [name], "batch_rows": self._rows(state, name).count(), "replaced": state.batches}
        else:
            return
        self._store(Manifest(**{**asdict(state), **change}))

    def _current(self, state: Manifest, folders: Sequence[str], buckets: Sequence[int] | None = None) -> DataFrame:
        """Rows of the folders (oldest first) whose key no later folder has; NULL keys are never replaced."""
        order = "_order"
        parts = []
        for n, folder in enumerate(folders):
            rows = self._rows(state, folder)
            if buckets is not None:
                rows = rows.where(F.col(BUCKET).isin(list(buckets)))
            parts.append(rows.withColumn(order, F.lit(n)))
        every = reduce(DataFrame.unionByName, parts)
        if len(parts) == 1:
            return every.drop(order)
        names = {k: f"_key_{k}" for k in state.keys}
        newest = (
            reduce(DataFrame.unionByName, parts[1:])
            .groupBy(*[F.trim(F.col(f"`{k}`")).alias(n) for k, n in names.items()])
            .agg(F.max(order).alias("_newest"))
        )
        same = [F.trim(F.col(f"`{k}`")) == F.col(n) for k, n in names.items()]
        return every.join(newest, [*same, F.col(order) < F.col("_newest")], "left_anti").drop(order)

    def read(self, buckets: Sequence[int] | None = None, with_bucket: bool = False) -> DataFrame:
        """The table's rows; with `buckets` only those in them, read from their files alone."""
        state = self.manifest()
        if state is None:
            raise FileNotFoundError(f"no table at {self.path}")
        rows = self._current(state, [state.base, *state.batches], buckets)
        return rows if with_bucket else rows.drop(BUCKET)


def replace_keys(batch: DataFrame, target: str, keys: Sequence[str], batch_id: str, buckets: int | None = None) -> None:
    """Delete rows of the keyed table `target` whose trimmed key is in the batch, then add the batch.

    The number of buckets is stored when the table is made (`buckets`, else BUCKETS); asking for
    another one later is an error (see `rebucket`). `batch_id` names the batch, the same for every
    attempt: one that died is repeated, one that was done changes nothing.
    """
    KeyedTable(batch.sparkSession, target).replace(batch, keys, batch_id, buckets)


def read_keyed(spark: SparkSession, target: str, buckets: Sequence[int] | None = None) -> DataFrame:
    """A table written by `replace_keys`; with `buckets` only the rows whose `key_bucket` is one of them."""
    return KeyedTable(spark, target).read(buckets)


def stored_buckets(spark: SparkSession, target: str) -> int | None:
    """The number of buckets a keyed table was laid out with; None for a new table."""
    state = KeyedTable(spark, target).manifest()
    return state.buckets if state else None


def rebucket(spark: SparkSession, target: str, copy: str, keys: Sequence[str], buckets: int) -> None:
    """Write a keyed table to `copy` with another number of buckets, for a table that has outgrown its own.

    Some 256 MB to a bucket keep folding and lookups by bucket cheap. Readers switch to the copy.
    """
    replace_keys(read_keyed(spark, target), copy, keys, "rebucket", buckets)
