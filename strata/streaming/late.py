"""An outlet for late rows (D4, T-c).

A stateful operator drops the rows behind its watermark, and nobody hears of
them.  A gate in front of it splits a feed by the same rule: a micro-batch's
watermark is the greatest event time of the batches before it, less the delay;
rows at or behind it go to a table of late rows, the others on to the feed that
the stateful job reads with the same delay.  That job's watermark is never
ahead of the gate's, so it drops none of them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from strata.sources.sinks import fs_children

Sink = Callable[[DataFrame, int], None]


class LateGate:
    """The gate's memory: ``<root>/batch=<id>`` holds one row, the greatest event time up to that batch.

    A batch looks only at the row before it and overwrites its own, so a
    replayed batch is split as it was the first time.
    """

    def __init__(self, spark: SparkSession, root: str, time_col: str, delay_s: int):
        self.spark, self.root, self.time_col, self.delay_s = spark, root.rstrip("/"), time_col, delay_s

    def _high(self, before: int):
        ids = [i for c in fs_children(self.spark, self.root, committed=True) if (i := int(c.split("=")[1])) < before]
        if not ids:
            return None
        return self.spark.read.schema("high timestamp").parquet(f"{self.root}/batch={max(ids)}").first()["high"]

    def split(self, batch: DataFrame, batch_id: int, on_time: Sink, late: Sink) -> None:
        """Stores a batch's two parts; a row without an event time is late."""
        high, at = self._high(batch_id), F.col(self.time_col)
        ahead = at.isNotNull()
        if high is not None:
            ahead = F.coalesce(at > F.lit(high) - F.make_dt_interval(secs=F.lit(self.delay_s)), F.lit(False))
        on_time(batch.where(ahead), batch_id)
        late(batch.where(~ahead), batch_id)
        highest = batch.agg(F.max(at).alias("high")).select(F.greatest("high", F.lit(high).cast("timestamp")).alias("high"))
        highest.write.mode("overwrite").parquet(f"{self.root}/batch={int(batch_id)}")


def late_gate_job(feed: DataFrame, gate: LateGate, on_time: Sink, late: Sink, checkpoint: str) -> DataStreamWriter:
    """Splits ``feed`` at its watermark, batch by batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        gate.split(batch, batch_id, on_time, late)

    return feed.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)


def folder_sink(path: str) -> Sink:
    """Batches as Parquet in ``batch=<id>`` folders, which a replay overwrites."""

    def write(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/batch={int(batch_id)}")

    return write
