"""A stored consumer-offset ledger (S2): what a group has consumed, kept by the running query.

Structured Streaming resumes from its own checkpoint.  A query with another
checkpoint (a new version, another sink) resumes from this ledger instead.  A
batch's ledger is saved after the batch's rows have been stored, so a crash in
between replays the batch and loses nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.offsets import merge_ledgers, offset_ledger
from strata.sources.sinks import fs_children

LEDGER = "topic string, partition int, next_offset bigint"


class OffsetLedger:
    """The next offset per topic partition of a consumer group, in ``<root>/group=<group>/run=<n>/batch=<id>``.

    Every batch's folder holds the whole ledger as of that batch, a row per topic
    partition, so a read opens one folder; a replayed batch overwrites its own.
    A query with a new checkpoint counts its batches from 0 again: it opens a
    new run, which starts with the ledger that the last one left.
    """

    def __init__(self, spark: SparkSession, root: str, group: str):
        self.spark, self.path = spark, f"{root.rstrip('/')}/group={group}"
        self.run = len(fs_children(spark, self.path))

    def resume(self) -> OffsetLedger:
        """Goes on with the last run, for a restart from the same checkpoint."""
        self.run = max(0, self.run - 1)
        return self

    def _folder(self, run: int, before: int | None = None) -> str | None:
        """The folder of a run's newest committed batch (before one, if given), or of the run before."""
        while run >= 0:
            ids = [int(c.split("=")[1]) for c in fs_children(self.spark, f"{self.path}/run={run}", committed=True)]
            ids = [i for i in ids if before is None or i < before]
            if ids:
                return f"{self.path}/run={run}/batch={max(ids)}"
            run, before = run - 1, None
        return None

    def _at(self, folder: str | None) -> DataFrame:
        return self.spark.createDataFrame([], LEDGER) if folder is None else self.spark.read.schema(LEDGER).parquet(folder)

    def read(self) -> DataFrame:
        """The ledger as last saved: topic, partition, next_offset."""
        return self._at(self._folder(self.run))

    def save(self, records: DataFrame, batch_id: int) -> None:
        """Advances the ledger by a batch of consumed topic records."""
        merged = merge_ledgers(self._at(self._folder(self.run, batch_id)), offset_ledger(records))
        merged.select("topic", F.col("partition").cast("int"), "next_offset").coalesce(1).write.mode("overwrite").parquet(
            f"{self.path}/run={self.run}/batch={int(batch_id)}")


def with_ledger(sink: Callable[[DataFrame, int], None], ledger: OffsetLedger) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that stores a batch by ``sink`` and then saves the offsets it came from."""

    def write(batch: DataFrame, batch_id: int) -> None:
        sink(batch, batch_id)
        ledger.save(batch, batch_id)

    return write
