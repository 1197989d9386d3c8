"""Scalar helpers whose semantics must not drift between engines."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_away(x: Column, digits: int) -> Column:
    """Round a double to ``digits`` decimals, ties away from zero, on the binary value.

    ``F.round`` rounds the *decimal text* of the double half-up, so
    ``round(0.285, 2)`` gives 0.29 although the stored double is
    0.28499999999999998; the reference engine scales by ``10**digits`` and
    rounds the binary product (0.28). This helper does the latter exactly:
    ``y = |x| * 10**digits``; ``r = y - (y % 1)`` is ``floor(y)`` without a
    cast to ``bigint`` (no overflow for large values); add one when the exact
    fractional part is at least one half; restore the sign and scale back.
    NULL stays NULL. Decimal columns need no helper: ``F.round`` on a decimal
    is exact and already rounds ties away from zero.
    """
    scale = float(10**digits)
    x = x.cast("double")
    y = F.abs(x) * F.lit(scale)
    whole = y - (y % F.lit(1.0))
    rounded = F.when(y - whole >= F.lit(0.5), whole + F.lit(1.0)).otherwise(whole)
    return F.signum(x) * rounded / F.lit(scale)


def day_diff(start: Column, end: Column) -> Column:
    """Calendar days from ``start`` to ``end`` (midnights crossed), as ``int``.

    23:00 -> 01:00 the next day is 1. Spark's three-argument
    ``datediff(DAY, a, b)`` would count elapsed 24-hour periods (0) instead.
    """
    return F.datediff(end, start)


def month_start(ts: Column) -> Column:
    """First instant of the month of a ``timestamp_ntz``, still ``timestamp_ntz``.

    Goes through ``date`` so no session time zone is involved.
    """
    return F.trunc(ts.cast("date"), "month").cast("timestamp_ntz")


def month_label(ts: Column) -> Column:
    """``yyyy-MM`` label of a month."""
    return F.date_format(ts, "yyyy-MM")


def safe_div(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator`` as double, NULL when the denominator is 0 or NULL."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def ts_literal(day: _dt.datetime) -> Column:
    """A ``timestamp_ntz`` literal built from text, independent of any time zone."""
    if day.tzinfo is not None:
        raise ValueError(f"{day} has a time zone; the tables' timestamps have none")
    return F.lit(day.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def to_cents(money: Column) -> Column:
    """A ``decimal(p,2)`` amount as ``long`` cents, exact.

    ``rint(double(x) * 100)``: the decimal -> double conversion and the
    product each round once, so the result is within ``c * 2**-52`` of the
    integer ``c`` and ``rint`` recovers it exactly for any amount below
    2**51 cents (22 trillion units). Unlike ``x * 100`` on a decimal, this
    stays in primitive doubles (no BigDecimal per row), and sums of cents
    use a 64-bit buffer instead of a wide decimal. Sums beyond 92
    quadrillion units raise under ANSI mode.
    """
    return F.rint(money.cast("double") * F.lit(100.0)).cast("long")


def cents_to_double(cents: Column) -> Column:
    """Cents as a double amount: ``double(cents) / 100``, the same value as
    casting the exact decimal amount to double (correctly rounded)."""
    return cents.cast("double") / F.lit(100.0)
