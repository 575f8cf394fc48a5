"""Raw tables derived from the TPC-H-like test tables.

The test tables are clean, so the faults the engine must handle (two date
formats, retry duplicates, unknown keys, late arrivals) are injected by fixed
arithmetic on the order key. Everything is one pass over ``orders``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_ORPHAN_OFFSET = 10_000_000


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table. Its schema is read from the file once, as a catalog would keep it."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with padded names and mixed-case mail addresses."""
    regions = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    named = table(spark, sf_dir, "customer").join(regions, F.col("c_nationkey") == F.col("n_nationkey"))
    days = (F.col("c_custkey") % 900).cast("int")
    signup = F.date_add(F.lit("2024-01-01").cast("date"), days)
    return named.select(
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.concat(F.lit(" "), F.split_part("c_name", F.lit("#"), F.lit(1))).alias("first_name"),
        F.concat(F.split_part("c_name", F.lit("#"), F.lit(2)), F.lit("  ")).alias("last_name"),
        F.concat(F.lit("  "), "c_name", F.lit("@Example.COM ")).alias("email"),
        F.concat("r_name", F.lit(" ")).alias("region"),
        signup.cast("string").alias("signup_date"),
    )


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products with a cost between 30 % and 109 % of the price."""
    cents = F.round(F.col("p_retailprice") * 100).cast("long")
    cost = F.floor(cents * (30 + F.col("p_partkey") % 80) / F.lit(100))
    wide = "decimal(38,18)"
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.concat(F.lit(" "), "p_name", F.lit("  ")).alias("product_name"),
        F.concat("p_type", F.lit(" ")).alias("category"),
        (cost.cast("decimal(18,0)") / 100).cast(wide).alias("unit_cost"),
        (cents.cast("decimal(18,0)") / 100).cast(wide).alias("unit_price"),
    )


def _orders_with_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    parts = table(spark, sf_dir, "part").agg(F.count("*")).scalar()
    keyed = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), "o_custkey", "o_orderdate")
    legacy = k % 20 < 7

    hours = F.when(k % 33 == 0, (35 + k % 36) * 24).when(k % 101 == 50, F.lit(30 * 24)).otherwise(k % 5)
    # A retry writes the same order again some seconds later. Exploding the
    # copies reads the table once, where a union would read it twice.
    retry = (5 + k % 86).cast("int")
    none = F.lit(0)
    copies = F.when(legacy & (k % 40 == 5), F.array(none, retry)).otherwise(F.array(none))
    sent = keyed.withColumn("retry_after", F.explode(copies))
    delay = F.make_dt_interval(F.lit(0), hours.cast("int"), F.lit(0), F.col("retry_after").cast("decimal(18,6)"))

    customer = F.when(~legacy & (k % 97 == 8), F.col("o_custkey") + _ORPHAN_OFFSET).otherwise(F.col("o_custkey"))
    product = F.when(~legacy & (k % 89 == 9), k + _ORPHAN_OFFSET).otherwise(k % parts)
    written = F.when(legacy, F.date_format("o_orderdate", "MM/dd/yyyy")).otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd")
    )
    return sent.select(
        "k",
        k.cast("string").alias("order_id"),
        customer.cast("string").alias("customer_id"),
        product.cast("string").alias("product_id"),
        (1 + k % 5).cast("int").alias("quantity"),
        written.alias("order_date"),
        (F.col("o_orderdate") + delay).alias("load_timestamp"),
        F.when(legacy, "legacy_pos").otherwise("web_platform").alias("source_system"),
    )


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders_with_key(spark, sf_dir).drop("k")


# Fixed value: orders that arrive from here on are a second delivery.
SECOND_DELIVERY = "2001-01-01 00:00:00"


def raw_deliveries(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """``raw_orders`` in two deliveries by arrival; the second has late orders of earlier months."""
    orders = raw_orders(spark, sf_dir)
    second = F.col("load_timestamp") >= F.lit(SECOND_DELIVERY).cast("timestamp_ntz")
    return orders.filter(~second), orders.filter(second)


def raw_orders_bad(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``raw_orders`` with unreadable dates, missing dates and an unknown source added."""
    k = F.col("k")
    broken = F.when(k % 509 == 1, F.lit("13/45/2024")).when(k % 499 == 3, F.lit(None)).otherwise(F.col("order_date"))
    source = F.when(k % 503 == 2, F.lit("kiosk")).otherwise(F.col("source_system"))
    orders = _orders_with_key(spark, sf_dir)
    return orders.withColumns({"order_date": broken, "source_system": source}).drop("k")


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "customers": raw_customers(spark, sf_dir),
        "products": raw_products(spark, sf_dir),
        "orders_raw": raw_orders(spark, sf_dir),
    }
