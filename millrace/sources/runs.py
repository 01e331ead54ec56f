"""Work in progress that survives a crash."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from millrace.sources.generations import Generations


class PendingWork:
    """What a run has set out to do, stored until it is done.

    A run that dies leaves its work behind; the next one takes up the same work
    under the same run id, whatever else has arrived meanwhile, so everything
    written under that id is overwritten instead of added again. Work counts as
    stored once all of it is (`generations`).
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.generations = Generations(spark, folder)

    def stored(self) -> tuple[DataFrame, str] | None:
        """Work left behind by a run that did not end, with its id."""
        mark = self.generations.newest()
        items = self.generations.table("items", mark) if mark else None
        return (items, mark.note) if items is not None and not items.isEmpty() else None

    def begin(self, items: DataFrame) -> tuple[DataFrame, str] | None:
        """Store new work; None if there is nothing to do."""
        self.generations.write({"items": items}, uuid.uuid4().hex)
        return self.stored()

    def finish(self) -> None:
        self.generations.write({})
