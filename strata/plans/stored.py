"""Tables that dashboards read, written once for the state of the tables that they come from.

A stored table lies under the session's shared folder, in a folder named after
its sources' files, their sizes and times: when a source changes, or the folder
is gone or was not finished, it is written anew.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from strata.plans.warehouse import Warehouse
from strata.session import shared_path
from strata.sources.sinks import DayIndex, read_order_wide, write_order_wide


def _state(spark: SparkSession, sf_dir: str, tables: Sequence[str]) -> str:
    """A digest of the tables' files, sizes and modification times."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    seen = []
    for t in tables:
        path = jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{t}.parquet")
        files = path.getFileSystem(conf).listStatus(path)
        seen += sorted(f"{f.getPath()}:{f.getLen()}:{f.getModificationTime()}" for f in files)
    return hashlib.sha256("\n".join(seen).encode()).hexdigest()[:16]


def _stored(spark: SparkSession, sf_dir: str, name: str, tables: Sequence[str], write: Callable[[str], None]) -> str:
    """The table's folder; ``done``, its mark, is the last thing written."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = shared_path(spark, "stored", f"{name}-{_state(spark, sf_dir, tables)}")
    folder, mark = (jvm.org.apache.hadoop.fs.Path(p) for p in (path, f"{path}/done"))
    fs = folder.getFileSystem(conf)
    if not fs.exists(mark):
        fs.delete(folder, True)
        write(f"{path}/table")
        fs.create(mark).close()
    return f"{path}/table"


def stored_wide(spark: SparkSession, sf_dir: str, *days: str) -> DataFrame:
    """The wide order fact as the dashboard's store keeps it; with ``days`` only those."""
    tables = ("lineitem", "part", "orders", "customer", "nation")
    path = _stored(spark, sf_dir, "order_wide", tables, lambda p: write_order_wide(Warehouse(spark, sf_dir).order_wide(scale=2), p))
    return read_order_wide(spark, path, days or None)


def stored_dau(spark: SparkSession, sf_dir: str, *days: str) -> DataFrame:
    """The day index of active devices (S8) as ``dau_job`` keeps it, a device once a day; with ``days`` (yyyyMMdd) only those."""
    path = _stored(spark, sf_dir, "dau", ("events",), lambda p: DayIndex(spark, p).write_batch(Warehouse(spark, sf_dir).dau, 0))
    return DayIndex(spark, path).read(*days)
