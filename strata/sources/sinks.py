"""Sinks (S5, S8-S11) with batch-id idempotence.

Streaming jobs call these from ``foreachBatch``; each write is keyed by the
batch id, so the replay of a batch after a failure overwrites its own output
instead of duplicating it (the reference saved offsets after side effects and
could lose or repeat rows, SURVEY Q10).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from strata.operators.dedup import last_per_key
from strata.operators.wide import HEADER_COLUMNS
from strata.schemas import ORDER_WIDE

# The folder names that the sinks below write.
PARTITION_COLUMNS = ("dt", "day", "batch", "topic")


def fs_children(spark: SparkSession, path: str, committed: bool = False) -> list[str]:
    """Names of the folders below ``path`` (none, if there is no such path), with ``committed`` those with a success marker."""
    jvm = spark.sparkContext._jvm
    top = jvm.org.apache.hadoop.fs.Path(path)
    fs = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(top):
        return []
    found = [st.getPath() for st in fs.listStatus(top) if st.isDirectory()]
    return sorted(f.getName() for f in found if not committed or fs.exists(jvm.org.apache.hadoop.fs.Path(f, "_SUCCESS")))


def read_partitioned(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Read a folder tree of ``key=value`` partitions, keeping partition values as text.

    Type inference would turn a day like ``20240101`` into a number (and could
    drop leading zeros), so the relation is read by a schema of its own columns
    with the partition columns as text.
    """
    found = spark.read.option("basePath", path).format(fmt).load(path)
    files = set(found.drop(*PARTITION_COLUMNS).columns)
    schema = T.StructType([f if f.name in files else T.StructField(f.name, T.StringType()) for f in found.schema.fields])
    return spark.read.option("basePath", path).format(fmt).schema(schema).load(path)


def archive_text(df: DataFrame, path: str, value: str = "value", day: str = "dt", batch_id: int | None = None) -> None:
    """Raw lines, one per record, in day folders (``<path>/dt=<day>/``).

    With a batch id the batch lands in its own ``batch=<id>`` folder (overwrite,
    idempotent); without one the lines are appended.
    """
    out = df.select(F.col(value).alias("value"), F.col(day).alias("dt"))
    if batch_id is None:
        out.write.mode("append").partitionBy("dt").text(path)
    else:
        out.write.mode("overwrite").partitionBy("dt").text(f"{path}/_batches/batch={int(batch_id)}")


def archive_stream(records: DataFrame, path: str, checkpoint: str, value: str = "value", day: str = "dt") -> DataStreamWriter:
    """S5 as a stream: each record's line in its day's folder, by the exactly-once file sink."""
    out = records.select(F.col(value).alias("value"), F.col(day).alias("dt"))
    return (out.writeStream.format("text").partitionBy("dt").option("path", path)
            .option("checkpointLocation", checkpoint).outputMode("append"))


def read_archive(spark: SparkSession, path: str, batched: bool = True) -> DataFrame:
    return read_partitioned(spark, f"{path}/_batches" if batched else path, fmt="text")


class DayIndex:
    """Documents by id in per-day partitions; the same id overwrites (last write wins).

    Layout ``<root>/batch=<id>/day=<day>/``.  Reading one day prunes to that day's
    folders; the newest row per (day, id) wins by (batch, ``order``).  ``compact``
    bounds the folders of a day.
    """

    def __init__(self, spark: SparkSession, root: str, id_col: str = "mid", day_col: str = "day"):
        self.spark, self.root, self.id_col, self.day_col = spark, root.rstrip("/"), id_col, day_col

    def write_batch(self, docs: DataFrame, batch_id: int, order: Sequence[str] = ()) -> None:
        """Bulk-index one batch; within the batch the last by ``order`` wins."""
        keys = [self.day_col, self.id_col]
        latest = last_per_key(docs, keys, order) if order else docs.dropDuplicates(keys)
        latest.write.mode("overwrite").partitionBy(self.day_col).parquet(f"{self.root}/batch={int(batch_id)}")

    def compact(self, through: int, at_least: int = 8) -> list[str]:
        """Merge each day that has ``at_least`` folders of batches up to ``through`` into one folder of that batch; gives the days.

        ``through`` is a batch that can't be replayed any more.  The merged rows
        are added beside the old ones, which the newest-row rule makes no
        difference to a read, and what they replace is deleted only after their
        commit; so a crash at any point is mended by calling it again.  A read
        that listed its files before may have to be repeated.
        """
        jvm = self.spark.sparkContext._jvm
        found = jvm.org.apache.hadoop.fs.Path(f"{self.root}/batch=*/{self.day_col}=*")
        fs = found.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        folders: dict[str, list] = {}
        for status in fs.globStatus(found):
            path = status.getPath()
            if int(path.getParent().getName().split("=", 1)[1]) <= through:
                folders.setdefault(path.getName().split("=", 1)[1], []).append(path)
        folders = {day: paths for day, paths in folders.items() if len(paths) >= at_least}
        if not folders:
            return []
        target = f"batch={int(through)}"
        old = []
        for path in (p for paths in folders.values() for p in paths):
            inside = path.getParent().getName() == target
            old += [f.getPath() for f in fs.listStatus(path)] if inside else [path]
        tasks = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        merged = self._newest(F.col(self.day_col).isin(*folders) & (F.col("batch").cast("bigint") <= through))
        (merged.repartitionByRange(tasks, self.day_col, self.id_col).write.mode("append").partitionBy(self.day_col)
         .parquet(f"{self.root}/{target}"))
        for path in old:
            fs.delete(path, True)
        return sorted(folders)

    def read(self, *days: str) -> DataFrame:
        """The newest row of each id and day; with ``days`` only those, by a partition filter."""
        return self._newest(F.col(self.day_col).isin(*days) if days else None)

    def _newest(self, which: Column | None) -> DataFrame:
        df = read_partitioned(self.spark, self.root)
        if which is not None:
            df = df.where(which)
        cols = [c for c in df.columns if c != "batch"]
        ordered = df.withColumn("_b", F.col("batch").cast("bigint")).drop("batch")
        return last_per_key(ordered, [self.day_col, self.id_col], ["_b"]).select(*cols)


def write_order_wide(wide: DataFrame, path: str, batch_id: int | None = None) -> None:
    """The wide order fact, in ``dt=<day>`` folders; with a batch id in ``month=<month>/batch=<id>`` folders that a replay overwrites.

    The rows are ranged by day and order over as many tasks as a shuffle has,
    so small days share a task and a large one is written by several, to a file
    each.  A micro-batch may have a few rows of every day, so its files hold the
    days of a month, in order; a read of a day opens its month's files and, by
    their statistics, reads that day's part.  Ranging looks at the rows twice,
    so a micro-batch is held meanwhile.
    """
    # An order's lines follow each other: with the header's columns side by side they shrink well in the shuffle.
    out = wide.select(*HEADER_COLUMNS, *[c for c in ORDER_WIDE.names if c not in HEADER_COLUMNS])
    tasks = int(wide.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = lambda rows: rows.repartitionByRange(tasks, "dt", "order_id", "order_detail_id").select(*ORDER_WIDE.names)
    if batch_id is None:
        ranged(out).write.mode("append").partitionBy("dt").parquet(path)
        return
    out = out.persist(StorageLevel.DISK_ONLY)
    try:
        parts = ranged(out).withColumns({"month": _month("dt"), "batch": F.lit(int(batch_id))})
        (parts.sortWithinPartitions("month", "dt", "order_id", "order_detail_id").write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("month", "batch").parquet(path))
    finally:
        out.unpersist()


def _month(day: str) -> Column:
    return F.substring(day, 1, 7)


def read_order_wide(spark: SparkSession, path: str, days: Sequence[str] | None = None) -> DataFrame:
    """The stored wide fact, with ``days`` only those: a partition filter, so other days' (of micro-batches: months') files are not opened.

    A day without a folder has no rows.
    """
    months = any(c.startswith("month=") for c in fs_children(spark, path))
    schema = T.StructType([*ORDER_WIDE.fields, T.StructField("month", T.StringType())]) if months else ORDER_WIDE
    fact = spark.read.schema(schema).option("basePath", path).parquet(path)
    if days is not None:
        fact = fact.where(F.col("dt").isin(*days))
        if months:
            fact = fact.where(F.col("month").isin(*{d[:7] for d in days}))
    return fact.select(*ORDER_WIDE.names)


def append_documents(df: DataFrame, path: str, id_col: str = "_id") -> None:
    """Append documents with a generated id."""
    df.withColumn(id_col, F.expr("uuid()")).write.mode("append").parquet(path)


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str], batchsize: int = 100,
               isolation_level: str = "NONE", num_partitions: int = 4) -> None:
    """Append to a JDBC table with the reference's writer settings.

    Credentials and driver class come in ``properties`` from the caller, never from code.
    """
    (df.write.mode("append").option("batchsize", str(batchsize)).option("isolationLevel", isolation_level)
     .option("numPartitions", str(num_partitions)).jdbc(url, table, properties=properties))


def console(stream_df: DataFrame, num_rows: int = 1000, truncate: bool = False):
    """A console sink writer showing up to ``num_rows`` rows per batch."""
    return stream_df.writeStream.format("console").option("numRows", num_rows).option("truncate", truncate)
