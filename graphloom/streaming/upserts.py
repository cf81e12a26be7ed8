"""A mutation log applied to an attribute table in micro-batches, last write wins.

A batch is one Parquet folder that holds its own last writes. Its number is appended to the list of finished batches
only after that, and readers start from the list, so they see a batch whole or not at all, and a replay changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from graphloom.operators.mutate import latest


class AttributeTable:
    """Last writes under `at`, any folder that Spark can write."""

    def __init__(self, spark: SparkSession, at: str, schema: str, keys: list[str], value: str, order: list[str]):
        self.spark, self.at, self.schema, self.keys, self.value, self.order = spark, at.rstrip("/"), schema, keys, value, order
        self._finish([])

    def _finish(self, batches: list[int]) -> None:
        self.spark.createDataFrame([(b,) for b in batches], "batch long").coalesce(1).write.mode("append").parquet(f"{self.at}/finished")

    def finished(self) -> list[int]:
        """Numbers of the batches that are in the table, one small row each."""
        return sorted({r["batch"] for r in self.spark.read.schema("batch long").parquet(f"{self.at}/finished").collect()})

    def read(self) -> DataFrame:
        """The state after the last finished batch. It stays as it is while further batches come in."""
        folders = [f"{self.at}/batch={b}" for b in self.finished()]
        rows = self.spark.read.schema(self.schema).parquet(*folders) if folders else self.spark.createDataFrame([], self.schema)
        return latest(rows, self.keys, self.value, self.order)

    def apply(self, batch: DataFrame, batch_id: int) -> None:
        """Adds a batch; for foreachBatch."""
        if batch_id not in self.finished():
            latest(batch, self.keys, self.value, self.order).write.mode("overwrite").parquet(f"{self.at}/batch={batch_id}")
            self._finish([batch_id])


def run_upserts(log: DataFrame, to: AttributeTable, checkpoint: str):
    """A started streaming query that applies a log to the table, all that there is by now; a later one with the same
    checkpoint goes on from there."""
    return log.writeStream.foreachBatch(to.apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
