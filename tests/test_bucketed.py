"""Tables stored by key, and joins on them that shuffle nothing."""

import pytest

from orderloom.operators.lookup import lookup
from orderloom.sources.bucketed import bucketed, bucketed_lookup, bucketed_orphans
from tests.test_plans import plan_of

BUCKETS = 8


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Of 3,000 orders a third has one customer, some an unknown hot one, some none."""
    folder = str(tmp_path_factory.mktemp("bucketed"))
    customer = "CASE WHEN id % 3 = 0 THEN 'c1' WHEN id % 4 = 1 THEN 'lost' WHEN id % 50 = 2 THEN NULL ELSE 'c' || id % 400 END"
    orders = spark.range(3000).selectExpr("id AS order_id", f"{customer} AS customer_id", "'o' AS note")
    customers = spark.range(300).selectExpr("'c' || id AS customer_id", "'r' || id % 5 AS region")
    return orders, customers, *[bucketed(df, "customer_id", BUCKETS, folder) for df in (orders, customers)]


def rows(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=str)


@pytest.fixture
def no_broadcast_by_estimate(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_lookup_is_that_of_plain_tables(tables):
    orders, customers, facts, dimension = tables
    columns = ("order_id", "customer_id", "note", "region", "known")
    want = lookup(orders, customers, "customer_id", ["region"], "known")
    for limit in (0, 1 << 20):
        assert rows(bucketed_lookup(facts, dimension, ["region"], "known", limit), *columns) == rows(want, *columns)
    lost = [(o, c) for o, c, _, _, known in rows(want, *columns) if c is not None and not known]
    assert rows(bucketed_orphans(facts, dimension), "order_id", "customer_id") == sorted(lost, key=str)


def test_hot_and_null_keys_lie_outside_of_the_buckets(tables):
    _, _, facts, dimension = tables
    assert {r[0] for r in facts.hot_keys.collect()} == {"c1", "lost"}
    assert {r[0] for r in facts.hot.select("customer_id").distinct().collect()} == {"c1", "lost", None}
    assert facts.rows.count() + facts.hot.count() == 3000
    assert facts.rows.groupBy("customer_id").count().agg({"count": "max"}).first()[0] <= 3000 // BUCKETS
    assert dimension.hot.count() == dimension.hot_keys.count() == 0


def test_no_shuffle_of_the_buckets(spark, tables, no_broadcast_by_estimate):
    _, _, facts, dimension = tables
    for df in (bucketed_lookup(facts, dimension, ["region"], "known"), bucketed_orphans(facts, dimension)):
        plan = plan_of(df)
        assert "Exchange hashpartitioning" not in plan and "Exchange Round" not in plan
        assert plan.count("SortMergeJoin") == 1


def test_tables_that_do_not_fit(spark, tables, tmp_path):
    orders, customers, facts, _ = tables
    other = bucketed(customers, "customer_id", 4, str(tmp_path))
    with pytest.raises(ValueError, match="same buckets"):
        bucketed_lookup(facts, other, ["region"], "known")
    with pytest.raises(ValueError, match="repeats"):
        bucketed_orphans(facts, facts)
    none = bucketed(orders.limit(0), "customer_id", 4, str(tmp_path))
    assert bucketed_lookup(none, other, ["region"], "known").count() == bucketed_orphans(none, other).count() == 0
