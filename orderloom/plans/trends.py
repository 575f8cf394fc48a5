"""Daily revenue and its trailing 7 and 30 day trends."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.operators.rolling import rolling_days, rolling_rows
from orderloom.schemas import TREND_FRAMES

_NAMES = ("revenue_rolling_{}", "avg_daily_revenue_{}")


def daily_revenue(orders: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Revenue and orders per day, optionally per segment."""
    return orders.groupBy(*by, "order_date").agg(
        F.sum("revenue").alias("daily_revenue"),
        F.count("order_id").alias("daily_order_count"),
    )


def revenue_trends(orders: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Trends over days with sales, per segment if ``by`` is given.

    The window sees one row per day, not per order. Dates have four-digit years,
    so even the ungrouped window is bounded by the calendar whatever the order
    volume; a century of sales is 36,525 rows.
    """
    return trends_of_days(daily_revenue(orders, by), by)


def trends_of_days(daily: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The trends of daily revenue that has been summed before."""
    return rolling_rows(daily, "order_date", "daily_revenue", TREND_FRAMES, _NAMES, by)


def revenue_trends_calendar(orders: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The same over calendar days, which differs where days without sales lie between."""
    return rolling_days(daily_revenue(orders, by), "order_date", "daily_revenue", TREND_FRAMES, _NAMES, by)
