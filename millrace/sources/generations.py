"""Small state kept as numbered generations: the newest complete one counts.

A generation's tables are written first, each into a folder of its own, and its mark last: one short
file that appears as a whole. Nothing is overwritten that the newest mark names, so a crash at any
moment leaves the generation before it readable. No success markers are needed.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import session
from millrace.sources import tables

MARK = "number bigint, note string, schemas map<string,string>"


class Generations:
    """Named tables and a note that change together."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def newest(self) -> Row | None:
        """The mark of the newest complete generation."""
        path = f"{self.folder}/marks"
        if not tables.path_exists(self.spark, path):
            return None
        marks = self.spark.read.schema(MARK).option("recursiveFileLookup", "true").json(path)
        return marks.where("number is not null").orderBy(F.desc("number")).first()

    def table(self, name: str, mark: Row | None = None) -> DataFrame | None:
        """A table of the newest generation (or of the one given); None if it has no such table."""
        mark = mark or self.newest()
        if mark is None or name not in mark.schemas:
            return None
        schema = T.StructType.fromJson(_json(mark.schemas[name]))
        return self.spark.read.schema(schema).parquet(self._place(mark.number, name))

    def write(self, frames: Mapping[str, DataFrame], note: str = "") -> int:
        """Add a generation; the one before stays readable, the one before that is emptied."""
        last = self.newest()
        number = last.number + 1 if last else 1
        for name, frame in frames.items():
            frame.write.mode("overwrite").parquet(self._place(number, name))
        schemas = {name: frame.schema.json() for name, frame in frames.items()}
        self._mark(number, self.spark.createDataFrame([(number, note, schemas)], MARK))
        self._drop(number - 2)
        return number

    def _place(self, number: int, name: str) -> str:
        return f"{self.folder}/g{number}/{name}"

    def _mark(self, number: int, rows: DataFrame) -> None:
        rows.coalesce(1).write.mode("overwrite").json(f"{self.folder}/marks/g{number}")

    def _drop(self, number: int) -> None:
        path = f"{self.folder}/marks/g{number}"
        if number < 1 or not tables.path_exists(self.spark, path):
            return
        mark = self.spark.read.schema(MARK).json(path).first()
        for name, schema in (mark.schemas if mark else {}).items():
            session.release(self.spark.createDataFrame([], T.StructType.fromJson(_json(schema))), self._place(number, name))
        self._mark(number, self.spark.createDataFrame([], MARK))


def _json(text: str) -> dict:
    import json

    return json.loads(text)
