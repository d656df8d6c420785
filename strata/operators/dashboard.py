"""Dashboard queries.

Inputs are the device-activity table (one row per device and day, ``day`` =
``yyyyMMdd``) and the wide order table (``dt`` = ``yyyy-MM-dd``).  Both are
day-partitioned when written by the sinks, so the day filters prune files.
Dates are ``yyyy-MM-dd`` strings; a malformed date raises, as in the reference.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.dates import hour_of
from strata.functions.money import sum_money

# KPI ids and display names of the reference dashboard.
KPI_DAU = ("dau", "新增日活")
KPI_NEW_MID = ("new_mid", "新增设备")
KPI_NEW_ORDER = ("new_order", "订单金额")
TODAY, YESTERDAY = "today", "yesterday"
HOUR_BUCKETS = 24


def _parse(date: str) -> _dt.date:
    return _dt.datetime.strptime(date, "%Y-%m-%d").date()


def compact(date: str) -> str:
    """C4 on a parameter: ``yyyy-MM-dd`` -> ``yyyyMMdd``."""
    return _parse(date).strftime("%Y%m%d")


def yesterday(date: str) -> str:
    """C3 on a parameter: the previous day, ``yyyy-MM-dd``."""
    return (_parse(date) - _dt.timedelta(days=1)).strftime("%Y-%m-%d")


def dau_total(dau: DataFrame, date: str) -> DataFrame:
    """A1: number of active devices on ``date`` (one row: dt, dau)."""
    return dau.where(F.col("day") == compact(date)).agg(F.count(F.lit(1)).alias("dau")).select(
        F.lit(date).alias("dt"), "dau"
    )


def dau_hour(dau: DataFrame, date: str) -> DataFrame:
    """A2: active devices by first-start hour, busiest first (terms aggregation, size 24)."""
    return (
        dau.where(F.col("day") == compact(date))
        .groupBy("hr")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), F.asc("hr"))
        .limit(HOUR_BUCKETS)
    )


def _measure(measure: str) -> str:
    if measure not in ("final_total_amount", "final_detail_amount"):
        raise ValueError("measure must be final_total_amount (reference) or final_detail_amount")
    return measure


def order_amount_total(wide: DataFrame, date: str, measure: str = "final_total_amount") -> DataFrame:
    """A3 + R9: exact sum of ``measure`` over the wide rows of ``date``; 0 for an empty day.

    The reference sums the order total once per line (SURVEY Q1);
    ``measure="final_detail_amount"`` sums the apportioned line amounts instead.
    """
    m = _measure(measure)
    return wide.where(F.col("dt") == date).agg(
        F.coalesce(sum_money(m), F.lit(0).cast("decimal(22,2)")).alias("amount")
    )


def order_amount_totals(wide: DataFrame, date: str, measures: tuple[str, ...]) -> DataFrame:
    """A3 for several measures in one scan: one row, one exact sum column per measure."""
    aggs = [F.coalesce(sum_money(_measure(m)), F.lit(0).cast("decimal(22,2)")).alias(m) for m in measures]
    return wide.where(F.col("dt") == date).agg(*aggs)


def order_amount_hour(wide: DataFrame, date: str, measure: str = "final_total_amount") -> DataFrame:
    """A4 + C9: exact sum of ``measure`` by hour of ``create_time`` for ``date`` (no zero-filled hours)."""
    m = _measure(measure)
    return (
        wide.where(F.col("dt") == date)
        .groupBy(hour_of("create_time").alias("hr"))
        .agg(sum_money(m).alias("amount"))
    )


def order_amount_by_day_hour(wide: DataFrame, measure: str = "final_total_amount") -> DataFrame:
    """A4 for every day at once: exact sum of ``measure`` per (dt, hr).

    The rollup a dashboard store keeps so that any A4 / A5 request is a lookup
    of at most 48 rows; one partial aggregation, one shuffle of (dt, hr) groups.
    """
    m = _measure(measure)
    return wide.groupBy("dt", hour_of("create_time").alias("hr")).agg(sum_money(m).alias("amount"))


def hourly_compare_dau(dau: DataFrame, date: str) -> DataFrame:
    """A5 for ``id=dau``: (day, hr, value) for ``date`` and the day before, one scan."""
    today, yday = compact(date), compact(yesterday(date))
    label = F.when(F.col("day") == today, F.lit(TODAY)).otherwise(F.lit(YESTERDAY))
    return (
        dau.where(F.col("day").isin(today, yday))
        .groupBy(label.alias("day"), "hr")
        .agg(F.count(F.lit(1)).alias("value"))
    )


def hourly_compare_amount(wide: DataFrame, date: str, measure: str = "final_total_amount") -> DataFrame:
    """A5 for ``id=order_amount``: (day, hr, value) for ``date`` and the day before, one scan."""
    m = _measure(measure)
    yday = yesterday(date)
    label = F.when(F.col("dt") == date, F.lit(TODAY)).otherwise(F.lit(YESTERDAY))
    return (
        wide.where(F.col("dt").isin(date, yday))
        .groupBy(label.alias("day"), hour_of("create_time").cast("string").alias("hr"))
        .agg(sum_money(m).alias("value"))
    )


def hourly_compare(kind: str, table: DataFrame, date: str, **kw) -> DataFrame | None:
    """A5 dispatch: ``dau`` or ``order_amount``; any other id gives None (no result)."""
    if kind == "dau":
        return hourly_compare_dau(table, date)
    if kind == "order_amount":
        return hourly_compare_amount(table, date, **kw)
    return None


def kpi_list(dau: DataFrame, wide: DataFrame, date: str, new_mid: int | None = None,
             order_date: str | None = None, measure: str = "final_total_amount") -> DataFrame:
    """Three KPI rows (id, name, value as text).

    ``dau`` is the A1 count (the reference hard-codes 0 and writes it over the id,
    SURVEY Q2); ``new_mid`` is not computed by the reference (a constant), so it is
    a parameter, null by default (Q3); ``new_order`` is A3.  ``order_date``
    defaults to ``date``.
    """
    d = dau_total(dau, date).select(
        F.lit(KPI_DAU[0]).alias("id"), F.lit(KPI_DAU[1]).alias("name"), F.col("dau").cast("string").alias("value")
    )
    spark = dau.sparkSession
    nm = spark.range(1).select(
        F.lit(KPI_NEW_MID[0]).alias("id"), F.lit(KPI_NEW_MID[1]).alias("name"),
        F.lit(None if new_mid is None else str(new_mid)).cast("string").alias("value"),
    )
    o = order_amount_total(wide, order_date or date, measure).select(
        F.lit(KPI_NEW_ORDER[0]).alias("id"), F.lit(KPI_NEW_ORDER[1]).alias("name"),
        F.col("amount").cast("string").alias("value"),
    )
    return d.unionByName(nm).unionByName(o)
