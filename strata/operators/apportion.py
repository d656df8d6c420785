"""Apportion an order's final amount to its lines (A6, C10, C11, D6 batch form).

Rule: ``line = price x qty``; ``share = final x line / original_total``.  The
line that completes the order (running sum of lines = original total) takes
``final - sum(shares of the lines before it)`` instead, so the shares of a
complete order add up to its final amount exactly.

Batch form, arrival order = ``order_col`` ascending (the detail id).  The
completing line is the last one with an amount, when all lines add up to the
total; lines without an amount have a zero share wherever they stand.  That
turns the running window into three per-order aggregates joined back on the
order id: the aggregate is partial (map-side), and the join is one AQE can
split when one order holds a large share of all lines.  Negative lines
(refunds) take part like any other.

Money is exact: amounts are ``decimal(18,2)`` and quotients are formed in whole
cents.  ``scale=None`` keeps 12 places of the share; ``scale=2`` rounds shares to
cents and the completing line takes the remainder.  A zero total gives a null
share.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.money import line_amount, money, share_of

def apportion(wide: DataFrame, scale: int | None = None, order_col: str = "order_detail_id",
              out_col: str = "final_detail_amount", as_double: bool = True) -> DataFrame:
    """Fill ``out_col`` on OrderWide rows (one row per (order, line))."""
    final, total = money("final_total_amount"), money("original_total_amount")
    line = line_amount("sku_price", "sku_num")
    share = share_of(final, line, total)
    if scale is not None:
        share = F.round(share, scale)
    w = wide.withColumn("_line", line).withColumn("_share", share)
    per_order = w.groupBy(F.col("order_id").alias("_oid")).agg(
        F.sum("_line").alias("_lines"),
        F.sum("_share").alias("_shares"),
        F.max(F.when(F.col("_line") != 0, F.col(order_col))).alias("_last_pos"),
    )
    j = w.join(per_order, w["order_id"] == per_order["_oid"], "left")
    completes = (
        (F.col("_lines") == total)
        & (F.col(order_col) == F.col("_last_pos"))
        & F.col("_share").isNotNull()
    )
    value = F.when(completes, final - (F.col("_shares") - F.col("_share"))).otherwise(F.col("_share"))
    if scale is not None:
        value = F.round(value, scale)
    if as_double:
        value = value.cast("double")
    keep = [c for c in wide.columns if c != out_col]
    return j.select(*keep, value.alias(out_col)).select(*wide.columns if out_col in wide.columns
                                                         else [*wide.columns, out_col])
