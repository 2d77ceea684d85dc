"""Scalar column expressions shared by the operators (all JVM-side, no UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


#: Scales under this many machine epsilons count as constant, as in the reference's scalers.
ZERO_SCALE = 10 * 2.220446049250313e-16


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def seconds_between(start, end) -> Column:
    """``end - start`` in seconds as double.

    ``timestamp_diff`` works on both ``timestamp`` and ``timestamp_ntz``;
    microseconds keep the fraction exact before the single division.
    """
    return (F.timestamp_diff("MICROSECOND", col_(start), col_(end)).cast("double")
            / F.lit(1_000_000.0))


def valid_price(price="price") -> Column:
    """``price > 0`` with pandas semantics: NaN and null fail (M1)."""
    p = col_(price)
    return (p > 0) & ~F.isnan(p)


def ratio_plus_one(num, den) -> Column:
    """``num / (den + 1)`` as double."""
    return col_(num).cast("double") / (col_(den).cast("double") + F.lit(1.0))


def finite_or(c, default) -> Column:
    """Replace NaN / +-inf / null by ``default``."""
    x = col_(c).cast("double")
    bad = x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    return F.when(bad, F.lit(default)).otherwise(x)


def finite_or_null(c) -> Column:
    x = col_(c).cast("double")
    bad = F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    return F.when(bad, F.lit(None).cast("double")).otherwise(x)


def per_minute(count, seconds) -> Column:
    """``count / (seconds / 60)``; x/0, inf and null become 0."""
    return F.coalesce(
        F.try_divide(col_(count).cast("double"), col_(seconds) / F.lit(60.0)),
        F.lit(0.0))


def fmt_int_half_even(c) -> Column:
    """Python ``f"{x:.0f}"`` (M17): Java's formatter rounds ties up, Python
    rounds the binary value half-even, so ``rint`` first."""
    return F.format_string("%.0f", F.rint(col_(c)))


def flag(cond: Column) -> Column:
    """Boolean -> 0/1 int (F8); null counts as 0."""
    return F.coalesce(cond.cast("int"), F.lit(0))
