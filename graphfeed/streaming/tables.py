"""A keyed table that micro-batches are merged into."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from graphfeed.operators.skew import newest
from graphfeed.sources import folders

# Runs of one level that are merged into one of the next.
FAN = 8


class KeyedTable:
    """Rows by ``keys``; of the rows with one key that with the highest ``order`` counts.

    A batch writes only its own newest rows, as a run of level 0 named after it. Writing it again
    replaces that run, so a repeated batch counts once. ``FAN`` runs of a level are merged into one
    run of the next, so a table of n batches is read from at most ``FAN`` runs for each of
    log(n) levels, and a row is written once per level. Readers take the newest row per key over
    all runs, in whatever order these came: a run that is still there beside the one it was merged
    into, or that a repeated batch brings back, changes nothing.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, keys: Sequence[str],
                 order: Sequence[str], fan: int = FAN):
        self.spark, self.path, self.schema = spark, path, schema
        self.keys, self.order, self.fan = list(keys), list(order), fan
        self._merged: list[str] = []

    def merge(self, batch: DataFrame, batch_id: int) -> None:
        newest(batch, self.keys, self.order).write.mode("overwrite").parquet(
            f"{self.path}/level=0/run={batch_id}"
        )
        self._compact()

    def runs(self) -> list[list[str]]:
        """Folders of the complete runs, by level."""
        levels = len(folders.names(self.spark, self.path))
        found = []
        for level in range(levels):
            below = f"{self.path}/level={level}"
            paths = [f"{below}/{name}" for name in folders.names(self.spark, below)]
            found.append([p for p in paths if folders.is_complete(self.spark, p)])
        return found

    def _compact(self) -> None:
        # runs merged at the last batch have served the readers that had listed them
        for path in self._merged:
            folders.remove(self.spark, path)
        self._merged = []
        level = 0
        while True:
            runs = self.runs()
            if level >= len(runs):
                return
            full = runs[level]
            if len(full) >= self.fan:
                rows = self.spark.read.schema(self.schema).parquet(*full)
                newest(rows, self.keys, self.order).write.parquet(
                    f"{self.path}/level={level + 1}/run={uuid.uuid4().hex}"
                )
                self._merged += full
            level += 1

    def read(self) -> DataFrame:
        paths = [path for level in self.runs() for path in level if path not in self._merged]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return newest(self.spark.read.schema(self.schema).parquet(*paths), self.keys, self.order)
