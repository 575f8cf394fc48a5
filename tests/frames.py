"""Small hand-written frames in the declared schemas."""

import datetime
import decimal

from orderloom import schemas


def ts(text):
    return None if text is None else datetime.datetime.fromisoformat(text)


def day(text):
    return datetime.date.fromisoformat(text)


def dec(text):
    return decimal.Decimal(text)


def raw_orders(spark, *rows):
    """Rows as (order_id, customer_id, product_id, quantity, order_date, load_timestamp, source_system)."""
    return spark.createDataFrame([(*r[:5], ts(r[5]), r[6]) for r in rows], schemas.RAW_ORDERS)


def order(
    order_id="1",
    date="2024-01-05",
    load="2024-01-05 10:00:00",
    source="web_platform",
    customer="c1",
    product="p1",
    quantity=1,
):
    return (order_id, customer, product, quantity, date, load, source)


def raw_customers(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.RAW_CUSTOMERS)


def raw_products(spark, *rows):
    return spark.createDataFrame([(*r[:3], dec(r[3]), dec(r[4])) for r in rows], schemas.RAW_PRODUCTS)


CUSTOMER = ("c1", " Ann ", " Lee", " Ann@Example.COM ", " West ", "2024-02-03")
PRODUCT = ("p1", " Lamp ", " Home ", "4.10", "10.25")
