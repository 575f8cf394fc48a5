"""BI summaries over segments.

A segments table has ``region``, ``category``, ``total_revenue``, ``gross_margin``
and ``order_count``, any number of rows per segment. ``segments_of_months`` takes
it from the stored monthly mart, so a dashboard reads kilobytes and never the
orders; ``segments_of_orders`` computes it from a fact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.functions.money import percent, ratio


def segments_of_orders(orders: DataFrame) -> DataFrame:
    return orders.groupBy("region", "category").agg(
        F.sum("revenue").alias("total_revenue"),
        F.sum("gross_margin").alias("gross_margin"),
        F.count("order_id").alias("order_count"),
    )


def segments_of_months(monthly: DataFrame) -> DataFrame:
    """An order has one month, region and category, so monthly figures add up exactly."""
    return monthly.select(
        "region", "category", "total_revenue", F.col("total_gross_margin").alias("gross_margin"), "order_count"
    )


def _sums() -> list[Column]:
    return [
        F.sum("total_revenue").alias("total_revenue"),
        F.sum("gross_margin").alias("gross_margin"),
        F.coalesce(F.sum("order_count"), F.lit(0).cast("long")).alias("order_count"),
    ]


def _margin_pct() -> Column:
    return percent(F.col("gross_margin"), F.col("total_revenue"))


def kpi_scorecard(segments: DataFrame) -> DataFrame:
    """Revenue, orders, margin and average order value over everything, in one row."""
    return segments.agg(*_sums()).select(
        "total_revenue",
        "order_count",
        "gross_margin",
        _margin_pct().alias("margin_pct"),
        ratio(F.col("total_revenue"), F.col("order_count")).alias("avg_order_value"),
    )


def margin_vs_revenue(segments: DataFrame) -> DataFrame:
    """Margin against revenue per category, with two average lines.

    ``overall_margin_pct`` is total margin over total revenue;
    ``mean_category_margin_pct`` weighs every category alike. ``distance`` is
    measured from the former.
    """
    categories = segments.groupBy("category").agg(*_sums()).withColumn("margin_pct", _margin_pct())
    # One row of totals, read as a scalar rather than joined.
    lines = categories.agg(
        F.struct(
            percent(F.sum("gross_margin"), F.sum("total_revenue")).alias("overall"),
            ratio(F.sum("margin_pct"), F.count("margin_pct")).alias("mean"),
        )
    ).scalar()
    measured = categories.withColumn("lines", lines)
    return measured.select(
        "category",
        "total_revenue",
        "gross_margin",
        "margin_pct",
        F.col("lines.overall").alias("overall_margin_pct"),
        F.col("lines.mean").alias("mean_category_margin_pct"),
        (F.col("margin_pct") - F.col("lines.overall")).alias("distance"),
    )


def categories_of(products: DataFrame) -> list[str]:
    """The categories of the product dimension, in order. Runs a job on it."""
    found = products.select("category").filter(F.col("category").isNotNull()).distinct()
    return sorted(row[0] for row in found.collect())


def region_category_heatmap(segments: DataFrame, categories: Sequence[str] | None = None) -> DataFrame:
    """Revenue by region (rows) and category (columns).

    Naming the categories fixes the columns and saves the job that finds them;
    all others, and segments without one, then add up in the column ``others``.
    Without them every category in the data gets a column.
    """
    if not categories:
        return segments.groupBy("region").pivot("category").agg(F.sum("total_revenue"))
    known = F.when(F.col("category").isin(*categories), F.col("category")).otherwise("others")
    cells = segments.withColumn("category", known).groupBy("region").pivot("category", [*categories, "others"])
    return cells.agg(F.sum("total_revenue"))


def kpi_breakdowns(segments: DataFrame) -> DataFrame:
    """Totals by region, by category and overall. ``grouping_level``: region, category or total."""
    level = (
        F.when((F.grouping("region") == 0), "region").when(F.grouping("category") == 0, "category").otherwise("total")
    )
    return (
        segments.groupingSets([["region"], ["category"], []], "region", "category")
        .agg(level.alias("grouping_level"), *_sums())
        .select("region", "category", "grouping_level", "total_revenue", "order_count")
    )


def conditional_totals(segments: DataFrame, regions: Sequence[str]) -> DataFrame:
    """Revenue per category with one conditional sum per listed region, and the total."""
    sums = [F.sum(F.when(F.col("region") == r, F.col("total_revenue"))).alias(r) for r in regions]
    return segments.groupBy("category").agg(*sums, F.sum("total_revenue").alias("total_revenue"))


def top_bottom_performers(segments: DataFrame) -> DataFrame:
    """Best and worst region and category by revenue, margin, margin percent and orders.

    Ties go to the name that sorts first. Segments without a name or a measure
    cannot be best or worst.
    """
    measures = ["total_revenue", "gross_margin", "margin_pct", "order_count"]
    is_region = F.grouping("region") == 0
    totals = (
        segments.groupingSets([["region"], ["category"]], "region", "category")
        .agg(
            F.when(is_region, "region").otherwise("category").alias("dimension"),
            F.when(is_region, F.col("region")).otherwise(F.col("category")).alias("name"),
            *_sums(),
        )
        .withColumn("margin_pct", _margin_pct())
    )
    long = totals.select("dimension", "name", *[F.col(m).cast("decimal(38,2)").alias(m) for m in measures]).unpivot(
        ["dimension", "name"], measures, "measure", "value"
    )
    # The smallest (value, name) pair, with the value negated for the top: one
    # combinable aggregate each instead of two sorts.
    best = F.min(F.struct(-F.col("value"), F.col("name"))).getField("name")
    worst = F.min(F.struct(F.col("value"), F.col("name"))).getField("name")
    return (
        long.filter("name is not null and value is not null")
        .groupBy("dimension", "measure")
        .agg(best.alias("top_name"), worst.alias("bottom_name"))
    )


def top_categories_by_region(segments: DataFrame, n: int = 2) -> DataFrame:
    """The ``n`` categories with the most revenue in each region, ties by name."""
    order = Window.partitionBy("region").orderBy(F.desc("total_revenue"), "category")
    totals = segments.groupBy("region", "category").agg(F.sum("total_revenue").alias("total_revenue"))
    return totals.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)


def consistent_top_categories(segments: DataFrame, n: int = 2) -> DataFrame:
    """Categories among the top ``n`` of every region. Orders without a region count as one more region."""
    top = top_categories_by_region(segments, n)
    # A struct is never NULL, so a missing region is counted like any other.
    regions = top.agg(F.count_distinct(F.struct("region"))).scalar()
    counted = top.groupBy("category").agg(F.count("*").alias("regions"))
    return counted.filter(F.col("regions") == regions).select("category")
