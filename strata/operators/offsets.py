"""Consumer-offset ledger.

Structured Streaming keeps its own offsets in the checkpoint.  The ledger is
for consumers outside Spark and for starting a new query where an old one
stopped: the next offset to read per (topic, partition).
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def offset_ledger(records: DataFrame, group: str | None = None) -> DataFrame:
    """Next offset (max + 1) per topic and partition of the consumed records."""
    out = records.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("next_offset"))
    if group is not None:
        out = out.withColumn("group_id", F.lit(group))
    return out


def merge_ledgers(old: DataFrame, new: DataFrame) -> DataFrame:
    """A saved ledger advanced by a new one (offsets never move backwards)."""
    cols = ["topic", "partition", "next_offset"]
    return old.select(*cols).unionByName(new.select(*cols)).groupBy("topic", "partition").agg(
        F.max("next_offset").alias("next_offset")
    )


def after_ledger(records: DataFrame, ledger: DataFrame) -> DataFrame:
    """The records (a stream's too) that a ledger has not seen: of partitions that it does not name, all.

    A ledger has a row per topic partition, so it is the small side of the join.
    """
    seen = ledger.select(F.col("topic").alias("_t"), F.col("partition").alias("_p"), "next_offset")
    at = (records["topic"] == seen["_t"]) & (records["partition"] == seen["_p"])
    unseen = "next_offset is null or offset is null or offset >= next_offset"
    return records.join(seen, at, "left").where(unseen).select(*records.columns)


def starting_offsets(ledger: DataFrame) -> str:
    """The ledger as a Kafka ``startingOffsets`` JSON string.

    One row per topic partition, so the collected size is bounded by the
    partition count, not by the data.
    """
    spec: dict[str, dict[str, int]] = {}
    for r in ledger.select("topic", "partition", "next_offset").collect():
        spec.setdefault(r["topic"], {})[str(r["partition"])] = int(r["next_offset"])
    return json.dumps(spec, sort_keys=True)
