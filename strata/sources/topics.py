"""Topic source and sink (S1, S3, S4) behind one pair of functions.

With the Kafka connector on the classpath, ``format="kafka"`` reads and writes
real topics.  Without it (as on this machine, SURVEY T5) the same record
schema is kept in Parquet folders, one folder per topic, so every job and
test runs unchanged against files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.offsets import after_ledger
from strata.operators.offsets import starting_offsets as as_starting_offsets
from strata.schemas import TOPIC_RECORD

# Records are JSON text, which shrinks to less than half of what the default codec leaves.
TOPIC_CODEC = "zstd"
RECORD_COLUMNS = [f.name for f in TOPIC_RECORD.fields]


def read_topic(spark: SparkSession, topic: str, *, fmt: str = "files", root: str | None = None,
               stream: bool = False, starting_offsets: str | None = None, ledger: DataFrame | None = None,
               options: dict | None = None, max_per_trigger: int | None = None) -> DataFrame:
    """Records of one topic: key, value, topic, partition, offset, timestamp.

    ``starting_offsets`` is Kafka's own; files are read whole and have none.

    ``ledger`` (S2) names the next offset of each partition; records before it
    are left out, partitions that it does not name are read from their start.
    ``max_per_trigger`` bounds a stream's micro-batch (T-a): in offsets of a
    Kafka topic, in files of a folder.

    ``fmt="kafka"``: ``options`` carries ``kafka.bootstrap.servers`` and the like.
    ``fmt="files"``: the topic's folder under ``root``; a stream's checkpoint
    remembers the files it has read.
    """
    if fmt != "kafka" and starting_offsets is not None:
        raise ValueError("files have no offsets to start from")
    reader = spark.readStream if stream else spark.read
    if fmt == "kafka":
        reader = reader.format("kafka").option("subscribe", topic).options(**(options or {}))
        if ledger is not None:
            starting_offsets = as_starting_offsets(ledger)
        if starting_offsets is not None:
            reader = reader.option("startingOffsets", starting_offsets)
        if stream and max_per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
        return reader.load().select(F.col("key").cast("string"), F.col("value").cast("string"), "topic", "partition",
                                    "offset", "timestamp")
    reader = reader.schema(TOPIC_RECORD)
    if stream and max_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_per_trigger)
    records = reader.parquet(root.rstrip("/")).where(F.col("topic") == topic).select(*RECORD_COLUMNS)
    return records if ledger is None else after_ledger(records, ledger)


def as_records(df: DataFrame, topic_col: str = "topic", value_col: str = "value", key_col: str | None = None) -> DataFrame:
    """Shape a frame for a topic sink: topic, key, value (S12 output goes in ``value``)."""
    key = F.col(key_col).cast("string") if key_col else F.lit(None).cast("string")
    return df.select(F.col(topic_col).alias("topic"), key.alias("key"), F.col(value_col).alias("value"))


def write_topic_batch(df: DataFrame, *, fmt: str = "files", root: str | None = None,
                      batch_id: int | None = None, options: dict | None = None) -> None:
    """S3/S4 for one batch: rows of (topic, key, value) to their topics.

    Files: appended under ``topic=<name>`` folders, where ``read_topic`` finds
    them; with a batch id, in a ``batch=<id>`` folder below that a replay
    overwrites.  A broker assigns partitions, offsets and times; files have
    none, unless the rows bring their own.
    """
    if fmt == "kafka":
        df.select("topic", "key", "value").write.format("kafka").options(**(options or {})).save()
        return
    own = [F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name)
           for f in TOPIC_RECORD.fields]
    if batch_id is None:
        df.select(*own).write.mode("append").option("compression", TOPIC_CODEC).partitionBy("topic").parquet(root)
        return
    (df.select(*own, F.lit(int(batch_id)).alias("batch")).write.mode("overwrite").option("compression", TOPIC_CODEC)
     .option("partitionOverwriteMode", "dynamic").partitionBy("topic", "batch").parquet(root))
