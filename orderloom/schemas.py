"""Declared schemas of the raw layer and column lists of the layers above it."""

from __future__ import annotations

from pyspark.sql import types as T

# Dates arrive as text because the source systems disagree on their format.
RAW_CUSTOMERS = T.StructType(
    [
        T.StructField("customer_id", T.StringType()),
        T.StructField("first_name", T.StringType()),
        T.StructField("last_name", T.StringType()),
        T.StructField("email", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("signup_date", T.StringType()),
    ]
)

# Raw money is unbounded at the source; Spark's widest decimal stands in for it.
RAW_PRODUCTS = T.StructType(
    [
        T.StructField("product_id", T.StringType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("unit_cost", T.DecimalType(38, 18)),
        T.StructField("unit_price", T.DecimalType(38, 18)),
    ]
)

RAW_ORDERS = T.StructType(
    [
        T.StructField("order_id", T.StringType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("order_date", T.StringType()),
        T.StructField("load_timestamp", T.TimestampNTZType()),
        T.StructField("source_system", T.StringType()),
    ]
)

RAW = {"customers": RAW_CUSTOMERS, "products": RAW_PRODUCTS, "orders_raw": RAW_ORDERS}

LOADED_AT = "_loaded_at"

# How each source system writes its dates. The one-letter fields
# accept one or two digits.
DATE_PATTERNS = {"legacy_pos": "M/d/yyyy", "web_platform": "yyyy-M-d"}

# Fixed value: more days than this between order and arrival makes a row late.
LATE_AFTER_DAYS = 30

# Rolling trend frames, in days with sales (or calendar days).
TREND_FRAMES = {"7d": 7, "30d": 30}
