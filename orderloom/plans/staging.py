"""Staging: one cleaned, typed table per raw table. No row is judged here."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.functions.dates import parse_by_source
from orderloom.functions.text import cleaned, cleaned_lower
from orderloom.operators.dedup import dedup_earliest
from orderloom.operators.late import flag_late
from orderloom.schemas import DATE_PATTERNS, RAW_ORDERS

_PRICE = "decimal(10,2)"


def stg_customers(raw: DataFrame) -> DataFrame:
    """Trimmed names and region, lower-case mail address, signup as a date.

    Unreadable signup dates and prices (below) fail the job.
    """
    return raw.select(
        "customer_id",
        cleaned("first_name"),
        cleaned("last_name"),
        cleaned_lower("email"),
        cleaned("region"),
        F.col("signup_date").cast("date").alias("signup_date"),
    )


def stg_products(raw: DataFrame) -> DataFrame:
    return raw.select(
        "product_id",
        cleaned("product_name"),
        cleaned("category"),
        F.col("unit_cost").cast(_PRICE).alias("unit_cost"),
        F.col("unit_price").cast(_PRICE).alias("unit_price"),
    )


def _one_per_order(raw: DataFrame) -> DataFrame:
    """The first write of each order; dates still as text, so ties never parse them."""
    return dedup_earliest(raw.select(*RAW_ORDERS.names), keys=["order_id"], arrival="load_timestamp")


def _parsed_date():
    return parse_by_source(F.col("source_system"), F.col("order_date"), DATE_PATTERNS)


# What the source wrote as the date of an order, kept beside it in stored tables.
DATE_TEXT = "order_date_text"


def stg_orders(raw: DataFrame, keep_text: bool = False) -> DataFrame:
    """One row per order: retries dropped, dates in one type, late rows flagged.

    With ``keep_text`` the date as delivered stays as ``order_date_text``; :func:`as_delivered` turns such rows back.
    """
    first = _one_per_order(raw)
    if keep_text:
        first = first.withColumn(DATE_TEXT, F.col("order_date"))
    dated = first.withColumn("order_date", _parsed_date())
    return flag_late(dated, "order_date", "load_timestamp")


def as_delivered(staged: DataFrame) -> DataFrame:
    """Staged orders in the shape of the raw table, to be staged again with later deliveries."""
    return staged.drop("order_date").withColumnRenamed(DATE_TEXT, "order_date").select(*RAW_ORDERS.names)


def bad_dates(raw: DataFrame) -> DataFrame:
    """Staged orders without a usable date, with what was delivered and why it failed."""
    known = F.col("source_system").isin(*DATE_PATTERNS)
    reason = (
        F.when(F.col("order_date").isNull(), "missing")
        .when(F.coalesce(known, F.lit(False)), "unparseable")
        .otherwise("unknown source")
    )
    return (
        _one_per_order(raw)
        .filter(_parsed_date().isNull())
        .select("order_id", "source_system", F.col("order_date").alias("raw_date"), reason.alias("reason"))
    )
