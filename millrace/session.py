"""Session settings the jobs are tuned for, and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings worth having on a large cluster. Nothing in the library depends on
# them for correct results; they only let Spark re-plan at run time.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join partition even when that costs one more exchange
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.optimizer.dynamicPartitionPruning.enabled": "true",
}


def build_session(
    app: str = "millrace", master: str | None = None, **settings: str
) -> SparkSession:
    """A session with the recommended settings; `settings` use `__` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in RECOMMENDED.items():
        builder = builder.config(name, value)
    for name, value in settings.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach, named by `spark.checkpoint.dir`.

    Where the setting is absent it is set to a folder below the session's
    warehouse directory. That must then be a folder that every node reaches: on
    a cluster a `file:` one, Spark's default, would be another on each machine
    and is refused.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    if folder.startswith(("file:", "/")) and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that nobody has used before."""
    return f"{shared_dir(spark)}/millrace/{label}-{uuid.uuid4().hex}"


def settle(frame: DataFrame, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Cut lineage by writing `frame` to the shared folder and reading it back; `by` lays it out in folders.

    Used where one result feeds several consumers; the written copy survives
    the loss of executors, which a cached copy does not.
    """
    spark = frame.sparkSession
    path = scratch_path(spark, label)
    frame.write.partitionBy(*by).parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def release(frame: DataFrame, path: str) -> None:
    """Empty a scratch folder: its files give way to one without rows, in the layout of `frame`."""
    frame.sparkSession.createDataFrame([], frame.schema).write.mode("overwrite").parquet(path)


@contextmanager
def workspace(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Gives a `settle` whose copies are emptied at the end, also after an error; `by` lays a copy out in folders."""
    kept: list[tuple[DataFrame, str]] = []

    def keep(frame: DataFrame, label: str, by: Sequence[str] = ()) -> DataFrame:
        path = scratch_path(spark, label)
        kept.append((frame, path))
        frame.write.partitionBy(*by).parquet(path)
        return spark.read.schema(frame.schema).parquet(path)

    try:
        yield keep
    finally:
        for frame, path in kept:
            release(frame, path)
