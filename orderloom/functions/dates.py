"""Date parsing and calendar helpers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_by_source(source: Column, text: Column, patterns: Mapping[str, str]) -> Column:
    """Read ``text`` with the pattern its source system writes.

    NULL for an unknown source, for text that does not fit the source's pattern
    and for days that do not exist. The not-null check on the result reports them.
    """
    parsed = F.lit(None).cast("date")
    for name, pattern in patterns.items():
        parsed = F.when(source == name, F.try_to_date(text, pattern)).otherwise(parsed)
    return parsed


def month_of(day: Column) -> Column:
    """First day of the month, as a date."""
    return F.trunc(day, "month")


def days_between(earlier: Column, later: Column) -> Column:
    """Whole days from ``earlier`` to ``later``; times of day do not count."""
    return F.date_diff(F.to_date(later), F.to_date(earlier))
