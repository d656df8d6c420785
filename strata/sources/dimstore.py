"""Keyed dimension tables in Parquet with idempotent batch writes.

No table format with MERGE is available, so a dimension is log-structured:

    <root>/kind=delta/version=<batch_id>/   the last row per key of one batch
    <root>/kind=base/version=<batch_id>/    the whole table as of that batch

Rows keep their arrival columns, and the last arrival of a key wins, however
the feed is split into batches.  A batch write overwrites its own ``version``
folder, so replaying a batch id (at-least-once delivery, a retried task, a
restarted stream) gives the same table; so does replaying a compaction, which
reads the base before it.  A read is one scan of the newest base and the
deltas after it, and one partial aggregation on the key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.operators.dedup import last_per_key
from strata.operators.dims import ARRIVAL


def _fs_versions(spark: SparkSession, path: str) -> list[int]:
    """Committed ``version=N`` folders under ``path`` (those with a _SUCCESS marker)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hpath):
        return []
    out = []
    for st in fs.listStatus(hpath):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith("version="):
            if fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
                out.append(int(name.split("=", 1)[1]))
    return sorted(out)


class DimensionStore:
    def __init__(self, spark: SparkSession, root: str, key: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.key = key

    def write_batch(self, rows: DataFrame, batch_id: int) -> None:
        """Store the last version per key of one batch (``rows`` carry the arrival columns)."""
        latest = last_per_key(rows, [self.key], ARRIVAL)
        latest.write.mode("overwrite").parquet(f"{self.root}/kind=delta/version={int(batch_id)}")

    def _latest(self, before: int | None = None) -> DataFrame:
        """The last row per key, from the newest base (before a batch, if one is given) and what came after it."""
        bases = [v for v in _fs_versions(self.spark, f"{self.root}/kind=base") if before is None or v < before]
        start = bases[-1] if bases else -1
        deltas = [v for v in _fs_versions(self.spark, f"{self.root}/kind=delta")
                  if v > start and (before is None or v <= before)]
        paths = [f"{self.root}/kind=base/version={v}" for v in bases[-1:]]
        paths += [f"{self.root}/kind=delta/version={v}" for v in deltas]
        if not paths:
            raise FileNotFoundError(f"no committed dimension data under {self.root}")
        rows = self.spark.read.option("basePath", self.root).parquet(*paths)
        return last_per_key(rows, [self.key], (*ARRIVAL, "version")).drop("kind", "version")

    def read(self) -> DataFrame:
        """The current table (newest row per key)."""
        return self._latest().drop(*ARRIVAL)

    def compact(self, batch_id: int) -> None:
        """Write the table as of ``batch_id`` as a base (later reads skip older deltas)."""
        self._latest(before=batch_id).write.mode("overwrite").parquet(f"{self.root}/kind=base/version={int(batch_id)}")
