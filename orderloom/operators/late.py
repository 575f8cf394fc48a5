"""Late data: flagged, never dropped."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.functions.dates import days_between
from orderloom.schemas import LATE_AFTER_DAYS


def flag_late(
    df: DataFrame,
    event: str,
    arrival: str,
    days: int = LATE_AFTER_DAYS,
    flag: str = "is_late_arriving",
) -> DataFrame:
    """True when a row arrived more than ``days`` days after its event; NULL if either is."""
    return df.withColumn(flag, days_between(F.col(event), F.col(arrival)) > days)
