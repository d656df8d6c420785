"""Streaming apportionment (D6): ``applyInPandasWithState`` keyed by buckets of the order id.

The state of an order is the sum of the line amounts seen so far and the sum
of the shares given to them.  A line with an amount that brings the running sum to the order's original
total takes ``final - shares so far``; any other line takes its share.  A
micro-batch's lines come in Arrow frames; a frame is sorted by order and
detail id and worked off as a whole, with cumulative sums that go on from the
state, so an order of any size needs the memory of one frame (rows reach the
function in no particular order, SURVEY T10).  State expires with the
event-time watermark ``retention_s`` after the order's last line.

A call of the function costs about a millisecond, whatever its rows, so calls
are made for buckets of orders, and a bucket's state holds its live orders.
``buckets`` is part of a checkpoint: a restarted stream keeps it.

Money is exact: amounts are whole cents, ``scale=2`` gives each share in cents,
rounded half-up, and ``scale=None`` keeps 28 significant digits.  A frame is
worked off by whole columns where all of it fits 64 bits, else in Python integers.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from decimal import ROUND_HALF_UP, Context, Decimal

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

_CTX = Context(prec=34, rounding=ROUND_HALF_UP)
_CENT = Decimal("0.01")
#: JSON: of each live order the sums of its lines and shares as text, and the time of its last line.
STATE_SCHEMA = "orders string"
BUCKETS = 1024
_BUCKET = "_bucket"
# Below these, doubles are sure as cents, products fit 64 bits, and whole numbers are exact doubles.
_SURE, _FITS, _EXACT = 2.0 ** 44, 2.0 ** 60, 2.0 ** 53


def _cents(x: float) -> int:
    """A double amount in whole cents, half-up from its shortest decimal form (as Spark casts)."""
    return int(Decimal(repr(float(x))).quantize(_CENT, rounding=ROUND_HALF_UP).scaleb(2))


def _all_cents(x: np.ndarray) -> np.ndarray:
    """``_cents`` of each value: by whole columns where the nearest cent is beyond doubt, else one by one."""
    x = x.astype(np.float64)
    scaled = x * 100
    whole = np.rint(scaled)
    # up to there a product is off by far less than what keeps it away from half a cent
    sure = (np.abs(scaled) < _SURE) & (np.abs(scaled - whole) < 0.49)
    if sure.all():
        return whole.astype(np.int64)
    out = np.where(sure, whole, 0).astype(np.int64).astype(object)
    out[~sure] = [_cents(v) for v in x[~sure]]
    return out


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whole products; as Python integers where 64 bits may not hold them."""
    if a.dtype != object and b.dtype != object and float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) < _FITS:
        return a * b
    return a.astype(object) * b.astype(object)


def _whole(cents: int, scale: int | None):
    """An amount in units of ``scale`` places (None: as Decimal)."""
    if scale is None:
        return Decimal(cents).scaleb(-2)
    return cents * 10 ** (scale - 2) if scale >= 2 else int(Decimal(cents).scaleb(scale - 2).quantize(1, ROUND_HALF_UP))


def _shares(final: np.ndarray, line: np.ndarray, total: np.ndarray, scale: int | None) -> np.ndarray:
    """``final * line / total`` in units of ``scale`` places (None: as Decimal); 0 (None: None) where the total is 0."""
    some = np.flatnonzero(total != 0)
    if scale is None:
        out = np.full(len(line), None, object)
        divide = np.frompyfunc(lambda f, x, t: _CTX.divide(_CTX.multiply(Decimal(f).scaleb(-2), Decimal(x)), Decimal(t)), 3, 1)
        out[some] = divide(*(x[some].astype(object) for x in (final, line, total)))
        return out
    # cents * cents / cents, in units of the scale: rounded half away from zero
    top = _product(_product(final[some], line[some]), np.asarray([10 ** max(0, scale - 2)]))
    bottom = _product(total[some], np.asarray([10 ** max(0, 2 - scale)]))
    size = np.abs(bottom)
    quotient = (2 * np.abs(top) + size) // (2 * size)
    out = np.zeros(len(line), quotient.dtype)
    out[some] = np.where((top < 0) == (bottom < 0), quotient, -quotient)
    return out


class _Frames:
    """Works off frames of lines: fills ``out_col`` and takes the orders' sums on."""

    def __init__(self, scale: int | None, order_col: str, time_col: str, out_col: str):
        self.scale, self.order_col, self.time_col, self.out_col = scale, order_col, time_col, out_col
        self.unit, self.number = (Decimal(1), Decimal) if scale is None else (Decimal(1).scaleb(-scale), int)

    def work_off(self, pdf: pd.DataFrame, codes: np.ndarray, keys: list[str], held: dict[str, list]) -> pd.DataFrame:
        """``codes``: each line's order, as a place in ``keys``; ``held``: of each key the sums of lines and shares and the last time."""
        order = np.lexsort((pdf[self.order_col].to_numpy(), codes))
        codes = codes[order]
        column = lambda name: pdf[name].to_numpy()[order]
        starts = np.flatnonzero(np.diff(codes, prepend=-1))
        final, total = _all_cents(column("final_total_amount")), _all_cents(column("original_total_amount"))
        number = column("sku_num")
        line = _product(_all_cents(column("sku_price")), number if number.dtype.kind == "i" else number.astype(object))
        share = _shares(final, line, total, self.scale)
        here = [keys[c] for c in codes[starts]]
        before = [held.get(k, ("0", "0", 0)) for k in here]
        last = np.maximum.reduceat(column(self.time_col).astype("datetime64[ms]").astype(np.int64), starts)
        work = self._by_columns if self._fits(final, line, total, share, before) else self._by_orders
        value, lines, shares = work(final, line, total, share, starts, before)
        for k, (_, _, seen), x, y, ms in zip(here, before, lines, shares, last.tolist(), strict=True):
            held[k] = [str(x), str(y), max(seen, ms)]
        given = np.empty(len(pdf), np.float64)
        given[order] = value
        pdf = pdf.copy(deep=False)
        pdf[self.out_col] = given
        return pdf

    def _fits(self, final, line, total, share, before) -> bool:
        """Whether the sums below hold in 64 bits, and their quotients by the scale are exact."""
        if self.scale is None or not 2 <= self.scale <= 8 or any(x.dtype == object for x in (final, line, total, share)):
            return False
        most = max((abs(int(v)) for b in before for v in b[:2]), default=0)
        sums = [float(np.abs(line).sum(dtype=np.float64)), float(np.abs(share).sum(dtype=np.float64)),
                float(np.abs(final).max(initial=0)) * 10 ** (self.scale - 2)]
        return most + 2 * sum(sums) < _EXACT

    def _by_columns(self, final, line, total, share, starts, before):
        """Each line's value, and each order's sums of lines and shares, by cumulative sums over all orders."""
        size = np.diff(starts, append=len(line))
        lines, shares = (np.array([int(b[i]) for b in before], np.int64) for i in (0, 1))
        so_far = lambda x, first: (c := np.cumsum(x)) + np.repeat(first - c[starts] + x[starts], size)
        running, given = so_far(line, lines), so_far(share, shares)
        # a line without an amount never completes an order, so it can't take a second remainder
        hits = np.flatnonzero((total != 0) & (line != 0) & (running == total))
        value = share.copy()
        value[hits] = final[hits] * 10 ** (self.scale - 2) - (given[hits] - share[hits])
        order = np.repeat(np.arange(len(starts)), size)[hits]
        again = np.flatnonzero(np.diff(order, prepend=-1) == 0)
        for j in again:  # lines below nothing let an order be completed once more: the earlier remainder counts
            i = hits[j]
            value[i] -= (value[starts[order[j]]:i] - share[starts[order[j]]:i]).sum()
        lines, shares = lines + np.add.reduceat(line, starts), shares + np.add.reduceat(value, starts)
        return np.where(total != 0, value / 10 ** self.scale, np.nan), lines.tolist(), shares.tolist()

    def _by_orders(self, final, line, total, share, starts, before):
        """As ``_by_columns``, order by order, with numbers of any size."""
        line, value = line.astype(object), np.where(total != 0, share.astype(object), None)
        may = np.array([v is not None for v in value], bool) & (line != 0).astype(bool)
        lines_after, shares_after = [], []
        for a, b, (lines, shares, _) in zip(starts, [*starts[1:], len(line)], before, strict=True):
            running, shares, at = np.cumsum(line[a:b]) + int(lines), self.number(shares), a
            for i in a + np.flatnonzero(may[a:b] & (running == total[a:b]).astype(bool)):
                shares += sum(v for v in value[at:i] if v is not None)
                value[i] = _whole(int(final[i]), self.scale) - shares
                at = i
            shares += sum(v for v in value[at:b] if v is not None)
            lines_after.append(running[-1])
            shares_after.append(shares)
        return [np.nan if v is None else float(v * self.unit) for v in value], lines_after, shares_after


def make_state_fn(scale: int | None, retention_s: int, order_col: str = "order_detail_id",
                  time_col: str = "arrive_ts", out_col: str = "final_detail_amount"):
    """The function of a stream that is grouped by the order; its state: lines and shares as text, last_ms."""
    frames = _Frames(scale, order_col, time_col, out_col)

    def fn(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        held = {"": list(state.get)} if state.exists else {}
        for pdf in pdfs:
            if len(pdf):
                yield frames.work_off(pdf, np.zeros(len(pdf), np.int64), [""], held)
        lines, shares, last_ms = held.get("", ("0", "0", 0))
        state.update((lines, shares, last_ms))
        state.setTimeoutTimestamp(last_ms + retention_s * 1000)

    return fn


def make_bucket_fn(scale: int | None, retention_s: int, key_col: str = "order_id", order_col: str = "order_detail_id",
                   time_col: str = "arrive_ts", out_col: str = "final_detail_amount"):
    """The function of a stream that is grouped by buckets of orders; its state is ``STATE_SCHEMA``."""
    frames = _Frames(scale, order_col, time_col, out_col)

    def fn(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = json.loads(state.get[0]) if state.exists else {}
        seen: set[str] = set()
        for pdf in pdfs:
            if not len(pdf):
                continue
            codes, orders = pd.factorize(pdf[key_col], use_na_sentinel=False)
            keys = ["" if pd.isna(k) else str(k) for k in orders]
            seen.update(keys)
            yield frames.work_off(pdf.drop(columns=_BUCKET), codes, keys, held)
        # as Spark does with keys of their own: an order that expired goes, unless this batch has lines of it
        mark, stay_ms = state.getCurrentWatermarkMs(), retention_s * 1000
        live = {k: v for k, v in held.items() if k in seen or v[2] + stay_ms >= mark}
        if not live:
            state.remove()
            return
        state.update((json.dumps(live),))
        state.setTimeoutTimestamp(max(min(v[2] for v in live.values()) + stay_ms, mark + 1))

    return fn


def apportion_stream(wide: DataFrame, scale: int | None = 2, retention_s: int = 600,
                     time_col: str = "arrive_ts", delay: str | None = "10 minutes", buckets: int = BUCKETS) -> DataFrame:
    """D6 on a stream of OrderWide rows carrying an event-time column ``time_col``.

    ``delay=None`` when ``time_col`` already carries a watermark (e.g. after a join).
    """
    cols = [c for c in wide.columns if c != "final_detail_amount"]
    src = wide.select(*cols)
    if delay is not None:
        src = src.withWatermark(time_col, delay)
    out_schema = T.StructType([*src.schema.fields, T.StructField("final_detail_amount", T.DoubleType())])
    fn = make_bucket_fn(scale, retention_s, time_col=time_col)
    # lines without an order have a bucket of their own: beside nulls, pandas would turn the others' ids into doubles
    bucket = F.when(F.col("order_id").isNull(), F.lit(buckets)).otherwise(F.pmod(F.xxhash64("order_id"), F.lit(buckets)))
    return src.withColumn(_BUCKET, bucket.cast("int")).groupBy(_BUCKET).applyInPandasWithState(
        fn, out_schema, STATE_SCHEMA, "append", GroupStateTimeout.EventTimeTimeout
    ).select(*wide.columns if "final_detail_amount" in wide.columns else [*wide.columns, "final_detail_amount"])
