"""Order header x order line: the wide fact.

Batch and streaming share these functions.  Arrival times are TIMESTAMP
columns; in streams they are the event-time columns carrying the watermarks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.dedup import first_per_key
from strata.schemas import ORDER_WIDE

# The reference's window join geometry (seconds).
WINDOW_S = 15
SLIDE_S = 5
RETENTION_S = 600

# Columns of OrderWide taken from the header and from the line.
_FROM_INFO = {
    "order_id": "id", "order_status": "order_status", "create_time": "create_time", "dt": "create_date",
    "benefit_reduce_amount": "benefit_reduce_amount", "original_total_amount": "original_total_amount",
    "feight_fee": "feight_fee", "final_total_amount": "final_total_amount",
    "province_name": "province_name", "province_area_code": "province_area_code",
    "user_age_group": "user_age_group", "user_gender": "user_gender", "if_first_order": "if_first_order",
    "user_id": "user_id",
}
_FROM_DETAIL = {
    "order_detail_id": "id", "sku_id": "sku_id", "sku_name": "sku_name", "sku_price": "order_price",
    "sku_num": "sku_num", "spu_id": "spu_id", "tm_id": "tm_id", "category3_id": "category3_id",
    "spu_name": "spu_name", "tm_name": "tm_name", "category3_name": "category3_name",
}
HEADER_COLUMNS = tuple(_FROM_INFO)


def _bucket(ts: Column, slide_s: int) -> Column:
    return F.floor(F.unix_micros(ts) / F.lit(slide_s * 1_000_000))


def _within(a: Column, b: Column, seconds: int) -> Column:
    """Times at most ``seconds`` apart; bounds by interval literals, from which a stream join learns when state expires."""
    span = F.expr(f"interval {int(seconds)} seconds")
    return (b >= a - span) & (b <= a + span)


def window_join(info: DataFrame, detail: DataFrame, info_time: str = "arrive_ts", detail_time: str = "arrive_ts",
                window_s: int = WINDOW_S, slide_s: int = SLIDE_S) -> DataFrame:
    """Inner join on order id of rows that share a sliding window of arrival time.

    With windows of ``window_s`` sliding by ``slide_s`` (aligned to slide
    boundaries), two rows share at least one window iff their slide buckets
    differ by at most ``window_s / slide_s - 1``.  Testing that once gives each
    pair once, instead of once per shared window as the window-then-join does
    (so the pair de-duplication D2 has nothing to remove for this reason).
    The interval bound on the raw times lets a stream-stream join drop state.

    Output: the header columns prefixed ``i_`` and the line columns prefixed ``d_``.
    """
    reach = window_s // slide_s - 1
    i = info.select([F.col(c).alias("i_" + c) for c in info.columns])
    d = detail.select([F.col(c).alias("d_" + c) for c in detail.columns])
    it, dt = F.col("i_" + info_time), F.col("d_" + detail_time)
    cond = (
        (F.col("i_id") == F.col("d_order_id"))
        & _within(it, dt, window_s)
        & (F.abs(_bucket(it, slide_s) - _bucket(dt, slide_s)) <= reach)
    )
    return i.join(d, cond, "inner")


def retained_join(info: DataFrame, detail: DataFrame, info_time: str = "arrive_ts", detail_time: str = "arrive_ts",
                  retention_s: int = RETENTION_S, dedup_detail: bool = True, how: str = "inner") -> DataFrame:
    """J5 + D3 + D4: pair a header and a line that arrive within ``retention_s`` of each other.

    ``how="full_outer"`` also gives the headers and lines that met no partner,
    once and with nulls on the other side; in a stream when their state expires.

    Either side may come first; each pair is emitted once.  Redelivered lines
    collapse to the earliest delivery (D3): the arrival is no part of a line.  In a stream
    the watermarks on both inputs evict rows older than the retention (D4).
    """
    if dedup_detail:
        line = [c for c in detail.columns if c not in ("arrive_s", detail_time)]
        detail = first_per_key(detail, line, [detail_time])
    i = info.select([F.col(c).alias("i_" + c) for c in info.columns])
    d = detail.select([F.col(c).alias("d_" + c) for c in detail.columns])
    it, dt = F.col("i_" + info_time), F.col("d_" + detail_time)
    cond = (
        (F.col("i_id") == F.col("d_order_id"))
        & _within(it, dt, retention_s)
    )
    return i.join(d, cond, how)


def unmatched(pairs: DataFrame) -> DataFrame:
    """Of a full outer join the rows without a partner: ``side`` (info or detail), order_id, order_detail_id."""
    lone = pairs.where("i_id is null or d_id is null")
    return lone.select(F.when(F.col("d_id").isNull(), "info").otherwise("detail").alias("side"),
                       F.coalesce("i_id", "d_order_id").alias("order_id"), F.col("d_id").alias("order_detail_id"))


def full_outer(info: DataFrame, detail: DataFrame) -> DataFrame:
    """Every header and every line of one batch, matched on order id, nulls kept."""
    i = info.select([F.col(c).alias("i_" + c) for c in info.columns])
    d = detail.select([F.col(c).alias("d_" + c) for c in detail.columns])
    return i.join(d, F.col("i_id") == F.col("d_order_id"), "full_outer")


def inner_pairs(info: DataFrame, detail: DataFrame) -> DataFrame:
    """J7 in batch form: header and line on order id."""
    i = info.select([F.col(c).alias("i_" + c) for c in info.columns])
    d = detail.select([F.col(c).alias("d_" + c) for c in detail.columns])
    return i.join(d, F.col("i_id") == F.col("d_order_id"), "inner")


def merge_wide(pairs: DataFrame, defaults: bool = True, keep: tuple[str, ...] = ()) -> DataFrame:
    """A joined (``i_*``, ``d_*``) frame -> the 26 OrderWide columns.

    Fields missing on either side take the bean defaults (0 for numbers, null
    for text) when ``defaults`` is set.  ``final_detail_amount`` is 0 until the
    apportionment fills it.  ``keep`` carries extra joined columns along.
    """
    cols = []
    present = set(pairs.columns)
    for f in ORDER_WIDE.fields:
        if f.name in _FROM_INFO:
            src = "i_" + _FROM_INFO[f.name]
        elif f.name in _FROM_DETAIL:
            src = "d_" + _FROM_DETAIL[f.name]
        else:
            src = None
        c = F.col(src) if src and src in present else F.lit(None)
        c = c.cast(f.dataType)
        # the keys stay bare columns: wrapped, they would lose the join's partitioning
        if defaults and f.name not in ("order_id", "order_detail_id") and f.dataType.typeName() in ("long", "double"):
            c = F.coalesce(c, F.lit(0).cast(f.dataType))
        cols.append(c.alias(f.name))
    return pairs.select(*cols, *keep)
