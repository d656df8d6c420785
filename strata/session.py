"""Session helpers: local sessions for tests/bench, per-query settings, shared folders.

On a cluster the caller owns the session.  Operators never change cluster
settings; the catalogue only pins the session time zone (all day/hour strings
are computed in UTC) and reads the shared checkpoint folder from the session.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

SESSION_ZONE = "UTC"
STATE_PER_CORE = 4


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "strata") -> SparkSession:
    """A local session for tests and the bench.  Not used by library code."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", SESSION_ZONE)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("STRATA_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.streaming.forceDeleteTempCheckpointLocation", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def pin_zone(spark: SparkSession) -> None:
    """Day and hour strings are defined in UTC."""
    if spark.conf.get("spark.sql.session.timeZone", None) != SESSION_ZONE:
        spark.conf.set("spark.sql.session.timeZone", SESSION_ZONE)


# A finished query's shuffle files go at once, not when the driver next collects garbage.  A stream's state is
# compressed better, and its versions are kept for the batches that a restart can need, not for a hundred.
_TIDY = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.streaming.stateStore.compression.codec": "zstd",
    "spark.sql.streaming.minBatchesToRetain": "2",
}


def state_partitions(spark: SparkSession) -> int:
    """Partitions of a stream's state: each trigger opens and commits every one of them, in several stores, and they
    hold a trigger's rows, so their number follows the cores, up to the session's number for whole tables."""
    return min(int(spark.conf.get("spark.sql.shuffle.partitions")), STATE_PER_CORE * spark.sparkContext.defaultParallelism)


@contextmanager
def tidy(spark: SparkSession, **more: str) -> Iterator[None]:
    """Queries and streams that start inside leave little behind on disk; the session's settings are put back."""
    settings = _TIDY | more
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def start_stateful(writer: DataStreamWriter) -> StreamingQuery:
    """Starts a stream whose state has ``state_partitions``; it takes the settings along."""
    spark = writer._spark
    with tidy(spark, **{"spark.sql.shuffle.partitions": str(state_partitions(spark))}):
        return writer.start()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session; only when it is unset on a local master (tests, the
    bench) a scratch folder is created and registered as the checkpoint dir.
    On any other master an unset folder is an error: each executor would write
    to its own disk.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if not root:
        root = sc.getConf().get("spark.checkpoint.dir", None)
        if not root:
            if not re.match(r"local(\[|$)", sc.master):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            root = tempfile.mkdtemp(prefix="strata-ckpt-")
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    return root.rstrip("/")


def shared_path(spark: SparkSession, *parts: str, unique: bool = False) -> str:
    """A path under the shared checkpoint folder (never a machine-local temp dir)."""
    tail = list(parts)
    if unique:
        tail.append(uuid.uuid4().hex[:12])
    return "/".join([checkpoint_root(spark), "strata", *tail])
