"""Every check is shown both to pass and to fail."""

import pytest
from frames import CUSTOMER, PRODUCT, day, order, raw_customers, raw_orders, raw_products
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.operators import checks
from orderloom.plans import marts, quality, staging
from orderloom.schemas import RAW_ORDERS, RAW_PRODUCTS


def keys(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "k string")


def test_unique(spark):
    found = checks.unique(keys(spark, "a", "a", "b", None, None), "k").collect()
    assert [tuple(r) for r in found] == [("a", 2)]
    assert checks.unique(keys(spark, "a", "b"), "k").count() == 0


def test_all_unique(spark):
    good, bad = keys(spark, "a", "b", None, None), keys(spark, "a", "a")
    assert checks.all_unique([(good, "k"), (good, "k")])
    assert not checks.all_unique([(good, "k"), (bad, "k")])
    assert not checks.all_unique([(bad, "k"), (good, "k")])


def test_null_counts(spark):
    df = spark.createDataFrame([("a", None), (None, None)], "x string, y int")
    assert {r.column_name: r.failures for r in checks.null_counts(df, ["x", "y"]).collect()} == {"x": 1, "y": 2}
    assert checks.null_counts(df.limit(0), ["x"]).first().failures == 0


def test_relationships(spark):
    child = spark.createDataFrame([("1", "a"), ("2", "z"), ("3", None)], "id string, fk string")
    for limit in (0, 1 << 20):
        found = checks.relationships(child, "fk", keys(spark, "a", "a", None), "k", limit).collect()
        assert [tuple(r) for r in found] == [("2", "z")]


def test_key_failures_are_those_of_the_two_checks(spark):
    failures = checks.key_failures(keys(spark, "a", "a", "a", "b", None, None), "k").first()
    assert tuple(failures) == (1, 2)
    assert tuple(checks.key_failures(keys(spark, "a"), "k").first()) == (0, 0)
    assert tuple(checks.key_failures(keys(spark, "a").limit(0), "k").first()) == (0, 0)


def test_duplicates(spark):
    df = spark.createDataFrame([("s", "1"), ("s", "1"), ("t", "1"), ("t", "2"), ("t", None)], "src string, id string")
    assert tuple(checks.duplicates(df, "id").first()) == (5, 2, 3)
    by = {r.src: (r.raw_rows, r.distinct_ids, r.duplicates) for r in checks.duplicates(df, "id", ["src"]).collect()}
    assert by == {"s": (2, 1, 1), "t": (3, 2, 1)}
    assert tuple(checks.duplicates(df.limit(0), "id").first()) == (0, 0, 0)


def test_reconcile(spark):
    rows = checks.reconcile(
        {"same": (spark.range(3), spark.range(3)), "short": (spark.range(3), spark.range(2))}
    ).collect()
    assert {r.table_name: (r.expected_rows, r.actual_rows, r.status) for r in rows} == {
        "same": (3, 3, "OK"),
        "short": (3, 2, "MISMATCH"),
    }
    with pytest.raises(ValueError, match="at least one"):
        checks.reconcile({})


def test_schema_drift():
    assert checks.schema_drift(RAW_ORDERS, RAW_ORDERS) == []
    renamed = T.StructType([T.StructField("sku", T.StringType()), *RAW_PRODUCTS.fields[1:]])
    assert checks.schema_drift(renamed, RAW_PRODUCTS) == ["missing column product_id", "unexpected column sku"]
    retyped = T.StructType([*RAW_PRODUCTS.fields[:-1], T.StructField("unit_price", T.DoubleType())])
    assert checks.schema_drift(retyped, RAW_PRODUCTS) == [
        "column unit_price is double, declared decimal(38,18)"
    ]


@pytest.fixture(scope="module")
def raw(spark):
    return {
        "customers": raw_customers(spark, CUSTOMER),
        "products": raw_products(spark, PRODUCT),
        "orders_raw": raw_orders(
            spark,
            order("1"),
            order("1", load="2024-01-05 10:00:09"),
            order("2", customer="x", date="2024-01-06"),
            order("3", product="x", load="2024-03-01 00:00:00"),
            order("4", customer="x", product="x"),
        ),
    }


def test_orphan_audit(spark, raw):
    validated = marts.build_models(raw)["int_orders_validated"]
    assert tuple(quality.orphan_audit(validated).first()) == (4, 2, 2, 1, 1)


def test_late_arrivals(spark, raw):
    rows = quality.late_arrivals(staging.stg_orders(raw["orders_raw"])).collect()
    assert [tuple(r) for r in rows] == [("web_platform", day("2024-01-01"), 4, 1)]


def results(models):
    return {(r.table_name, r.test, r.column_name): r.failures for r in quality.run_tests(models).collect()}


def test_declared_tests_pass_on_the_models(spark, raw):
    found = results(marts.build_models(raw))
    assert len(found) == 17 and not any(found.values())
    kinds = [test for _, test, _ in found]
    assert {k: kinds.count(k) for k in set(kinds)} == {"unique": 7, "not_null": 8, "relationships": 2}


def test_each_declared_test_can_fail(spark, raw):
    """Break one model at a time and see exactly its tests fail."""
    models = marts.build_models(raw)
    for table, key in quality.KEYS.items():
        doubled = models[table].unionByName(models[table])
        assert results({**models, table: doubled})[(table, "unique", key)] > 0
        blank = models[table].withColumn(key, F.lit(None).cast("string"))
        assert results({**models, table: blank})[(table, "not_null", key)] > 0
    undated = models["stg_orders"].withColumn("order_date", F.lit(None).cast("date"))
    assert results({**models, "stg_orders": undated})[("stg_orders", "not_null", "order_date")] == 4
    for column in ("customer_id", "product_id"):
        unknown = models["fct_orders"].withColumn(column, F.lit("nobody"))
        assert results({**models, "fct_orders": unknown})[("fct_orders", "relationships", column)] == 1
