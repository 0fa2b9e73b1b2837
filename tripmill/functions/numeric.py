"""Rounding that is exact on integers.

Engines disagree on ROUND over binary fractions, so money stays in cents and distance in
hundredths of a kilometre until the last step. Ties round away from zero.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_up(x: Column) -> Column:
    """Nearest whole number of a double, ties away from zero, as BIGINT."""
    x = x.cast("double")
    return F.when(x < 0, -F.floor(0.5 - x)).otherwise(F.floor(x + 0.5)).cast("bigint")


def mean(total: Column, n: Column, digits_held: int = 0) -> Column:
    """Rounded mean of an integer total; NULL for no rows. `digits_held` moves the point back."""
    rounded = half_up(total.cast("double") / F.nullif(n, F.lit(0)).cast("double")).cast("double")
    return rounded / F.lit(float(10**digits_held)) if digits_held else rounded


def hundredths(x: Column) -> Column:
    """A two-digit decimal held in a double, as a whole number of hundredths."""
    return half_up(x * F.lit(100.0))


def from_hundredths(x: Column) -> Column:
    return x.cast("double") / F.lit(100.0)


def km_hundredths(metres: Column) -> Column:
    return half_up(metres.cast("double") / F.lit(10.0))


def km(metres: Column) -> Column:
    """Kilometres with two digits."""
    return from_hundredths(km_hundredths(metres))


def usd(cents: Column) -> Column:
    return cents.cast("double") / F.lit(100.0)


def round_to(x: Column, digits: int) -> Column:
    scale = F.lit(float(10**digits))
    return half_up(x * scale).cast("double") / scale
