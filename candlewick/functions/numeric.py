"""Rounding and division that do not depend on the ANSI setting."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def round_half_up(value: Column, digits: int) -> Column:
    """Round a double with plain double arithmetic: floor(x * 10^d + 0.5) / 10^d.

    Spark's floor returns a long; from 2^52 on a double has no fraction to cut, so it is left out there. NaN stays NaN."""
    scale = float(10**digits)
    scaled = value * F.lit(scale) + F.lit(0.5)
    return F.when(F.abs(scaled) < float(1 << 52), F.floor(scaled).cast("double")).otherwise(scaled) / F.lit(scale)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient, NULL where the denominator is zero."""
    return F.try_divide(numerator, denominator)


def truthy(value: Column) -> Column:
    """True where a number is present and not zero."""
    return F.coalesce(value != 0, F.lit(False))
