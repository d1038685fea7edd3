"""A table folded batch by batch inside ``foreachBatch``.

The state of batch N is written to slot N mod 2 from the state of batch N-1 in
the other slot. A batch that is run again reads the same earlier slot and
overwrites its own, so retries change nothing, and two copies are all that is
kept. The folder must be one every executor reaches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


class Snapshot:
    def __init__(self, path: str, schema: str):
        self.path = path.rstrip("/")
        self.schema = schema

    def _slot(self, batch_id: int) -> str:
        return f"{self.path}/slot={batch_id % 2}"

    def before(self, spark: SparkSession, batch_id: int) -> DataFrame | None:
        """State ahead of a batch; None for the first."""
        return self.after(spark, batch_id - 1) if batch_id > 0 else None

    def after(self, spark: SparkSession, batch_id: int) -> DataFrame:
        return spark.read.schema(self.schema).parquet(self._slot(batch_id))

    def fold(
        self,
        spark: SparkSession,
        batch_id: int,
        step: Callable[[DataFrame | None], DataFrame],
    ) -> DataFrame:
        """Write ``step(state before)`` and return it as read back."""
        step(self.before(spark, batch_id)).write.mode("overwrite").parquet(self._slot(batch_id))
        return self.after(spark, batch_id)
