"""Exact rounding of ratios.

Averages and shares are rounded half-up on integers (``div`` is Spark's
integral division), so the result does not depend on floating point order or
on how an engine widens decimals.  Inputs are non-negative integral columns:
counts, or money in cents.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def half_up_ratio(numerator: Column, denominator: Column, digits: int = 2) -> Column:
    """round_half_up(numerator / denominator, digits) as DOUBLE; NULL when denominator is 0."""
    scale = 10**digits
    num = numerator.cast("decimal(38,0)")
    den = denominator.cast("decimal(38,0)")
    q = _div(num * (2 * scale) + den, den * 2)
    return F.when(den != 0, q.cast("double") / F.lit(float(scale)))


def cents(money: Column) -> Column:
    """A decimal money value with scale <= 2 as an exact integer number of cents."""
    return (money * 100).cast("decimal(38,0)")


def half_up_signed(x: Column, digits: int = 2) -> Column:
    """Symmetric half-up rounding of a DOUBLE that may be negative (growth rates)."""
    scale = float(10**digits)
    return F.signum(x) * F.floor(F.abs(x) * scale + 0.5).cast("double") / F.lit(scale)


def money(total: Column) -> Column:
    """round(decimal total, 2) emitted as DOUBLE at the edge."""
    return F.round(total, 2).cast("double")
