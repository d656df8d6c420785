"""Exact money arithmetic.

Amounts travel as doubles on the wire and are summed and divided as decimals.
Sums and products are decimals; quotients are formed from whole cents, where no
digit is lost (SURVEY T11).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.functions.dates import ColumnOrName, _c

MONEY = "decimal(18,2)"
QTY = "decimal(10,0)"
CENTS = "decimal(20,0)"


def money(x: ColumnOrName) -> Column:
    """Double amount -> ``decimal(18,2)`` (half-up to cents)."""
    return _c(x).cast(MONEY)


def cents(x: Column) -> Column:
    """A ``decimal(.,2)`` amount as whole cents."""
    return (x * 100).cast(CENTS)


def line_amount(price: ColumnOrName, qty: ColumnOrName) -> Column:
    """Price x quantity, exact."""
    return (money(price) * _c(qty).cast(QTY)).cast("decimal(20,2)")


def _div(a: Column, b: Column) -> Column:
    """Whole quotient of two whole decimals, towards zero (a long)."""
    return F.call_function("div", a, b)


def share_of(amount: Column, part: Column, whole: Column) -> Column:
    """C11: ``amount x part / whole`` to 12 places, cut off; null when ``whole`` is 0.

    The quotient is taken in whole cents, then the remainder's: both are exact,
    and rounding the result half-up to fewer places rounds the true quotient.
    """
    a, p = cents(amount), cents(part)
    w = F.when(whole != 0, cents(whole))
    product = (a * p).cast("decimal(38,0)")
    quotient = _div(product, w)
    rest = (product - quotient.cast(CENTS) * w).cast(CENTS)
    tail = _div((rest * F.lit(10_000_000_000).cast("decimal(11,0)")).cast("decimal(38,0)"), w)
    hundredths = quotient.cast("decimal(20,0)") * F.lit("0.01").cast("decimal(2,2)")
    return (hundredths + tail.cast("decimal(11,0)") * F.lit("1E-12").cast("decimal(12,12)")).cast("decimal(38,12)")


def sum_money(x: ColumnOrName) -> Column:
    """Exact sum of a double amount column (each value rounded to cents first)."""
    return F.sum(money(x))
