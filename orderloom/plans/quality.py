"""Reports on what the models flagged, dropped or excluded, and the declared tests."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions.dates import month_of
from orderloom.operators import checks
from orderloom.operators.lookup import BROADCAST_LIMIT


def orphan_metrics() -> list[Column]:
    """The counts of :func:`orphan_audit`, to be taken in an aggregate or on the way to a table."""
    customer, product = F.col("is_valid_customer"), F.col("is_valid_product")
    return [
        F.count(F.lit(1)).alias("staged"),
        F.count_if(~customer).alias("orphan_customer"),
        F.count_if(~product).alias("orphan_product"),
        F.count_if(~customer & ~product).alias("orphan_both"),
        F.count_if(customer & product).alias("valid"),
    ]


def orphan_audit(validated: DataFrame) -> DataFrame:
    """How many staged orders were excluded, and for which missing key."""
    return validated.agg(*orphan_metrics())


def order_key_failures(validated: DataFrame) -> DataFrame:
    """One row: repeated and missing order ids among all orders and among those of the fact.

    The staged, the validated and the fact table hold the same orders, the fact fewer of them, so one grouping by
    order id answers for all three.
    """
    valid = F.col("is_valid_customer") & F.col("is_valid_product")
    per_key = validated.groupBy("order_id").agg(F.count("*").alias("n"), F.count_if(valid).alias("valid"))
    present, none = F.col("order_id").isNotNull(), F.lit(0).cast("long")
    return per_key.agg(
        F.count_if(present & (F.col("n") > 1)).alias("unique_orders"),
        F.count_if(present & (F.col("valid") > 1)).alias("unique_fact"),
        F.coalesce(F.sum(F.when(~present, F.col("n"))), none).alias("null_orders"),
        F.coalesce(F.sum(F.when(~present, F.col("valid"))), none).alias("null_fact"),
    )


def late_arrivals(orders: DataFrame) -> DataFrame:
    """Orders and late orders by source and month."""
    return orders.groupBy("source_system", month_of(F.col("order_date")).alias("order_month")).agg(
        F.count("*").alias("orders"),
        F.count_if("is_late_arriving").alias("late_orders"),
    )


@dataclass(frozen=True)
class Relationship:
    table: str
    column: str
    parent: str
    parent_column: str


# The declared tests of the pipeline: seven unique, eight not-null, two relationships.
KEYS = {
    "stg_customers": "customer_id",
    "stg_products": "product_id",
    "stg_orders": "order_id",
    "int_orders_validated": "order_id",
    "dim_customers": "customer_id",
    "dim_products": "product_id",
    "fct_orders": "order_id",
}
NOT_NULL = {"stg_orders": ["order_date"]}
RELATIONSHIPS = [
    Relationship("fct_orders", "customer_id", "dim_customers", "customer_id"),
    Relationship("fct_orders", "product_id", "dim_products", "product_id"),
]


def run_tests(models: Mapping[str, DataFrame], limit_bytes: int = BROADCAST_LIMIT) -> DataFrame:
    """All declared tests as ``table_name, test, column_name, failures``, 17 rows.

    Unique and not-null on the same key share one grouping. Give it written
    tables: every row here is a separate read of its model.
    """
    parts = []
    for table, key in KEYS.items():
        both = checks.key_failures(models[table], key)
        parts.append(
            both.select(
                F.lit(table).alias("table_name"),
                F.lit(key).alias("column_name"),
                F.explode(
                    F.create_map(
                        F.lit("unique"), F.col("unique_failures"), F.lit("not_null"), F.col("null_failures")
                    )
                ).alias("test", "failures"),
            )
        )
    for table, columns in NOT_NULL.items():
        counts = checks.null_counts(models[table], columns)
        parts.append(
            counts.select(F.lit(table).alias("table_name"), "column_name", F.lit("not_null").alias("test"), "failures")
        )
    for rule in RELATIONSHIPS:
        parent = models[rule.parent]
        failing = checks.relationships(models[rule.table], rule.column, parent, rule.parent_column, limit_bytes)
        parts.append(
            failing.agg(F.count("*").alias("failures")).select(
                F.lit(rule.table).alias("table_name"),
                F.lit(rule.column).alias("column_name"),
                F.lit("relationships").alias("test"),
                "failures",
            )
        )
    return reduce(DataFrame.unionByName, parts).select("table_name", "test", "column_name", "failures")


@dataclass(frozen=True)
class Failures:
    """What the writing passes of a run have counted."""

    unique: Mapping[str, int]
    not_null: Mapping[str, int]
    null_dates: int
    relationships: Mapping[str, int]


def test_rows(found: Failures) -> list[tuple[str, str, str, int]]:
    """The declared tests as rows ``table_name, test, column_name, failures``, the same 17 as :func:`run_tests`."""
    rows = []
    for table, key in KEYS.items():
        rows += [(table, "unique", key, found.unique[table]), (table, "not_null", key, found.not_null[table])]
    rows += [(table, "not_null", column, found.null_dates) for table, columns in NOT_NULL.items() for column in columns]
    return rows + [(r.table, "relationships", r.column, found.relationships[r.column]) for r in RELATIONSHIPS]
