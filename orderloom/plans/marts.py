"""Validated orders, dimensions, the order fact and its monthly summary."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.functions.dates import month_of
from orderloom.functions.money import amount, percent
from orderloom.operators.checks import all_unique
from orderloom.operators.lookup import BROADCAST_LIMIT, lookup
from orderloom.plans.staging import stg_customers, stg_orders, stg_products


def int_orders_validated(
    orders: DataFrame, customers: DataFrame, products: DataFrame, limit_bytes: int = BROADCAST_LIMIT
) -> DataFrame:
    """Staged orders with the attributes of their customer and product.

    Orders with an unknown customer or product stay, marked by the two flags.
    """
    with_region = lookup(orders, customers, "customer_id", ["region"], "is_valid_customer", limit_bytes)
    joined = lookup(
        with_region, products, "product_id", ["category", "unit_price", "unit_cost"], "is_valid_product", limit_bytes
    )
    flags = ["is_valid_customer", "is_valid_product"]
    return joined.select(*orders.columns, *flags, "category", "unit_price", "unit_cost", "region")


def dim_customers(customers: DataFrame) -> DataFrame:
    return customers


def dim_products(products: DataFrame) -> DataFrame:
    return products


def fct_orders(validated: DataFrame) -> DataFrame:
    """Orders with a known customer and product, with revenue and gross margin.

    Category and region are carried along because every report slices by them.
    """
    quantity, price, cost = F.col("quantity"), F.col("unit_price"), F.col("unit_cost")
    return validated.filter(F.col("is_valid_customer") & F.col("is_valid_product")).select(
        "order_id",
        "customer_id",
        "product_id",
        "order_date",
        "source_system",
        "is_late_arriving",
        "category",
        "region",
        "quantity",
        "unit_price",
        "unit_cost",
        amount(quantity, price).alias("revenue"),
        amount(quantity, price - cost).alias("gross_margin"),
    )


def mart_monthly_kpis(orders: DataFrame, unique_orders: bool = False) -> DataFrame:
    """Orders, units, revenue and margin by month, region and category.

    ``unique_orders`` states that no order occurs twice, as the uniqueness check
    or ``one_row_per_order`` has shown. Counting rows then equals counting
    distinct orders, and only the groups are shuffled; without it every order id is.
    """
    order_count = F.count("order_id") if unique_orders else F.count_distinct("order_id")
    revenue, margin = F.sum("revenue"), F.sum("gross_margin")
    return orders.groupBy(month_of(F.col("order_date")).alias("order_month"), "region", "category").agg(
        order_count.alias("order_count"),
        F.sum("quantity").alias("units_sold"),
        F.round(revenue, 2).alias("total_revenue"),
        F.round(margin, 2).alias("total_gross_margin"),
        percent(margin, revenue).alias("margin_pct"),
    )


def one_row_per_order(customers: DataFrame, products: DataFrame) -> bool:
    """Whether the fact built with these dimensions holds each order at most once.

    Staging leaves one row per order, and a join to unique keys adds none, so
    checking the two dimensions spares a check of all orders. Runs a job on them.
    """
    return all_unique([(customers, "customer_id"), (products, "product_id")])


def build_models(raw: Mapping[str, DataFrame], limit_bytes: int = BROADCAST_LIMIT) -> dict[str, DataFrame]:
    """All models over raw tables, as views that feed each other.

    Only the dimensions are read here, to measure them and to check their keys.
    """
    customers = stg_customers(raw["customers"])
    products = stg_products(raw["products"])
    orders = stg_orders(raw["orders_raw"])
    validated = int_orders_validated(orders, customers, products, limit_bytes)
    fact = fct_orders(validated)
    return {
        "stg_customers": customers,
        "stg_products": products,
        "stg_orders": orders,
        "int_orders_validated": validated,
        "dim_customers": dim_customers(customers),
        "dim_products": dim_products(products),
        "fct_orders": fact,
        "mart_monthly_kpis": mart_monthly_kpis(fact, one_row_per_order(customers, products)),
    }
