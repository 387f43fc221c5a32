"""Sums and means that do not depend on row order, and two-decimal formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def summable(value: Column, scale: int | None) -> Column:
    """The value as whole units of 10**-scale, so that its sum is exact in any row order.

    Nothing is rounded: a value with more decimals fails the job. With no scale the value is
    summed as it is; DECIMAL columns are exact that way too.
    """
    if scale is None:
        return value
    units = F.rint(value * F.lit(float(10**scale)))
    exact = units / F.lit(float(10**scale)) == value.cast("double")
    refused = F.raise_error(F.lit(f"a value has more than {scale} decimals")).cast("bigint")
    return F.when(value.isNull() | exact, units.cast("bigint")).otherwise(refused)


def unscaled(total: Column, scale: int | None) -> Column:
    """A sum of `summable` values as a double."""
    return total.cast("double") if scale is None else total / F.lit(float(10**scale))


def mean(total: Column, n: Column, scale: int | None) -> Column:
    """Mean from a (sum, count) pair; null for an empty group."""
    return unscaled(total, scale) / F.nullif(n, F.lit(0))


def two_decimals(value: Column, ties: str = "up") -> Column:
    """Text with two decimals; null stays null.

    `ties="up"` rounds the shortest decimal form half up, as `%.2f` does on the JVM.
    `ties="even"` rounds the exact binary value, exact ties to even, as Python and C do, for
    values whose hundredths stay below 2**53 (beyond, doubles have no decimals to round).
    """
    if ties == "up":
        rounded = value.cast("double")
    elif ties == "even":
        rounded = _exact_hundredths(value.cast("double")) / F.lit(100.0)
    else:
        raise ValueError("ties must be 'up' or 'even'")
    return F.when(value.isNotNull(), F.format_string("%.2f", rounded))


def _exact_hundredths(x: Column) -> Column:
    # x * 100 = product + error exactly: x is split in two halves of at most 26 bits.
    wide = x * F.lit(134217729.0)
    high = wide - (wide - x)
    product = x * F.lit(100.0)
    error = (high * F.lit(100.0) - product) + (x - high) * F.lit(100.0)
    below = F.floor(product)
    is_half = (product - below) == F.lit(0.5)
    return (
        F.when(is_half & (error > 0), below + F.lit(1.0))
        .when(is_half & (error < 0), below.cast("double"))
        .otherwise(F.rint(product))
    )
