"""Text cleaning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def cleaned(column: str) -> Column:
    """Leading and trailing spaces off; tabs and inner spaces stay."""
    return F.trim(F.col(column)).alias(column)


def cleaned_lower(column: str) -> Column:
    return F.lower(F.trim(F.col(column))).alias(column)
