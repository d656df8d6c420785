"""Daily active devices (R5 + D1): the first start log of each device per event day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.dates import ts_from_millis
from strata.operators.dedup import first_per_key

DAU_COLUMNS = ("mid", "uid", "ar", "ch", "vc", "dt", "hr", "mi", "ts")


def with_index_day(start_logs: DataFrame) -> DataFrame:
    """Add ``day`` (``yyyyMMdd`` of the event time): the per-day index / partition key.

    The reference names the index after the processing day; the event day is
    used here so a late log lands in its own day (SURVEY Q11).
    """
    return start_logs.withColumn("day", F.date_format(ts_from_millis("ts"), "yyyyMMdd"))


def first_start_per_day(start_logs: DataFrame, order: tuple[str, ...] = ("ts",)) -> DataFrame:
    """D1 batch: keep the earliest start per (mid, event day); ``order`` breaks ties (e.g. offset)."""
    logs = start_logs if "day" in start_logs.columns else with_index_day(start_logs)
    keys = ["day", "mid"]
    ranked = first_per_key(logs, keys, order)
    return ranked.select(*DAU_COLUMNS, "day", *[c for c in ranked.columns if c not in DAU_COLUMNS and c != "day"])
