"""Dimension upsert by key.

A dimension feed is a topic of row JSON.  One micro-batch of it reduces to the
last version of each key, ordered by (timestamp, partition, offset): rows
without a message key may sit in different partitions, so the offset alone
does not order them (SURVEY T8).  Merging with the stored table keeps the
newer of the stored and the incoming row per key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.decode import Decoded, pick_columns
from strata.operators.dedup import last_per_key

ARRIVAL = ("timestamp", "partition", "offset")


def decode_dimension(records: DataFrame, schema: T.StructType, key: str) -> Decoded:
    """Topic records -> dimension columns plus the arrival order columns; records without a key apart."""
    return pick_columns(records, schema, key, keep=ARRIVAL)


def latest_versions(rows: DataFrame, key: str, order: tuple[str, ...] = ARRIVAL) -> DataFrame:
    """D5 within a batch: the last version of each key (arrival columns kept)."""
    return last_per_key(rows, [key], order)


def upsert(current: DataFrame | None, updates: DataFrame, key: str, order: tuple[str, ...] = ARRIVAL,
           version_col: str = "_version", version: int = 0) -> DataFrame:
    """S6 as a function: the table after applying ``updates`` to ``current``.

    Rows carry ``version_col`` (the batch that wrote them); an incoming row wins
    over a stored one with the same key, and among incoming rows the last by
    ``order`` wins.  One shuffle on the key with map-side reduction.
    """
    cols = [c for c in updates.columns if c not in order]
    inc = updates.withColumn(version_col, F.lit(version).cast("bigint"))
    if current is None:
        merged = inc
    else:
        cur = current.select(*cols, version_col, *[F.lit(None).cast(updates.schema[o].dataType).alias(o)
                                                   for o in order])
        merged = cur.unionByName(inc.select(*cols, version_col, *order))
    latest = last_per_key(merged, [key], (version_col, *order))
    return latest.select(*cols, version_col)
