"""Exact money arithmetic on decimals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Sums of money keep two decimals; 28 digits before the point hold any sum of
# two-decimal amounts a cluster can add up, and leave room for the factor below.
_AMOUNT = "decimal(30,2)"


def amount(quantity: Column, unit: Column) -> Column:
    """Quantity times unit price, to the cent (half away from zero)."""
    return F.round(quantity * unit, 2)


def ratio(numerator: Column, denominator: Column, scale: int = 1) -> Column:
    """``scale * numerator / denominator`` to two places; NULL when dividing by zero.

    Both sides must be whole numbers or decimals of at most two places. Spark
    cuts the scale of wide decimal quotients, so rounding such a quotient rounds
    twice and can miss by a cent. Here the quotient is taken in whole hundredths:
    ``(2*100*scale*|n| + |d|) div (2*|d|)`` rounds half away from zero exactly.
    """
    top = F.abs(numerator.cast(_AMOUNT)) * F.lit(2 * 100 * scale) + F.abs(denominator.cast(_AMOUNT))
    bottom = F.abs(F.nullif(denominator.cast(_AMOUNT), F.lit(0).cast(_AMOUNT))) * F.lit(2)
    # The difference is a multiple of ``bottom``, so this division leaves no rest.
    hundredths = ((top - top % bottom) / bottom).cast("decimal(30,0)")
    negative = (numerator < 0) != (denominator < 0)
    return (F.when(negative, -hundredths).otherwise(hundredths) / F.lit(100)).cast(_AMOUNT)


def percent(part: Column, whole: Column) -> Column:
    return ratio(part, whole, scale=100)
