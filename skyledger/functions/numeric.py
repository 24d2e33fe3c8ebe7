"""Rounding, guarded division and number formatting."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def round_half_up(value: Column, digits: int) -> Column:
    """Spark's ``ROUND``: ties of the printed decimal go away from zero."""
    return F.round(value, digits)


def round_half_even(value: Column, digits: int) -> Column:
    """Correctly rounded decimal: ties are judged on the exact binary value, to even.

    The product with a power of ten is itself rounded, so its rounding error (found
    without loss by splitting the value into two halves) decides when the product lands
    on a tie: 2.675 is stored slightly below the tie and gives 2.67, while ``ROUND``
    gives 2.68. Values too large to have such digits are returned as they are. Negative
    zero comes out as zero.
    """
    scale = float(10**digits)
    scaled = value * scale
    spread = value * 134217729.0  # 2**27 + 1 splits a double into two exact halves
    high = spread - (spread - value)
    error = (high * scale - scaled) + (value - high) * scale
    whole = F.floor(scaled).cast("double")
    above_tie = (scaled - whole) - 0.5
    up = (above_tie > 0) | (
        (above_tie == 0) & ((error > 0) | ((error == 0) & (F.pmod(whole, F.lit(2.0)) == 1.0)))
    )
    rounded = (whole + F.when(up, 1.0).otherwise(0.0)) / scale
    return F.when(F.abs(value) < float(2**52) / scale, rounded).otherwise(value)


def safe_divide(total: Column, count: Column, default: float | None = None) -> Column:
    """``total / count``, or ``default`` (NULL when None) unless the count is positive."""
    return F.when(count > 0, total / count).otherwise(F.lit(default).cast("double"))


def number_text(value: Column) -> Column:
    """Decimal text with at least one decimal and no exponent: ``0.0005``, ``-44.0``.

    Every digit that the double needs is written; 340 decimals, the most that the format
    takes, are enough for any double.
    """
    return F.call_function("format_number", value, F.lit("0.0" + "#" * 339))
