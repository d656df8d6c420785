"""First / last row per key.

Batch forms use ``min_by`` / ``max_by`` over a struct: the aggregate is partial,
so repeats of a key collapse before the shuffle and a hot key costs one row
per map task, not one task holding the whole group.  Stream forms use the
state store with a watermark (``dropDuplicatesWithinWatermark``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the least ``order`` tuple for each ``keys`` value (ties: any one)."""
    payload = [c for c in df.columns if c not in keys]
    best = F.min_by(F.struct(*payload), F.struct(*order))
    return df.groupBy(*keys).agg(best.alias("_r")).select(*keys, *[F.col("_r." + c).alias(c) for c in payload])


def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order`` tuple for each key (last write wins)."""
    payload = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*payload), F.struct(*order))
    return df.groupBy(*keys).agg(best.alias("_r")).select(*keys, *[F.col("_r." + c).alias(c) for c in payload])
