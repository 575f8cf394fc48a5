import datetime

import pytest
from frames import CUSTOMER, PRODUCT, day, dec, order, raw_customers, raw_orders, raw_products
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from orderloom.functions.money import percent, ratio
from orderloom.operators import lookup as joins
from orderloom.plans import marts
from orderloom.sources import testdata

TINY = "/root/testdata/sf0.001"


def models(spark, orders, customers=(CUSTOMER,), products=(PRODUCT,), limit=joins.BROADCAST_LIMIT):
    return marts.build_models(
        {
            "customers": raw_customers(spark, *customers),
            "products": raw_products(spark, *products),
            "orders_raw": raw_orders(spark, *orders),
        },
        limit,
    )


def test_orphans_are_flagged_and_left_out_of_the_fact(spark):
    built = models(
        spark,
        [
            order("ok"),
            order("no customer", customer="x"),
            order("no product", product="x"),
            order("neither", customer="x", product="x"),
            order("null customer", customer=None),
        ],
    )
    flags = {
        r.order_id: (r.is_valid_customer, r.is_valid_product, r.region, r.category)
        for r in built["int_orders_validated"].collect()
    }
    assert flags == {
        "ok": (True, True, "West", "Home"),
        "no customer": (False, True, None, "Home"),
        "no product": (True, False, "West", None),
        "neither": (False, False, None, None),
        "null customer": (False, True, None, "Home"),
    }
    assert [r.order_id for r in built["fct_orders"].collect()] == ["ok"]


def test_null_dimension_key_matches_nothing(spark):
    built = models(spark, [order(customer=None)], customers=[(None, *CUSTOMER[1:]), CUSTOMER])
    assert built["int_orders_validated"].first().is_valid_customer is False


def test_duplicate_dimension_key_fans_out(spark):
    """The left join multiplies, as any join does; distinct counting still sees one order."""
    built = models(spark, [order(quantity=2)], customers=[CUSTOMER, CUSTOMER])
    assert built["fct_orders"].count() == 2
    monthly = built["mart_monthly_kpis"].first()
    assert (monthly.order_count, monthly.units_sold) == (1, 4)


def test_revenue_and_margin(spark):
    row = models(spark, [order(quantity=3)], products=[("p1", "a", "b", "12.34", "10.25")])["fct_orders"].first()
    assert (row.revenue, row.gross_margin) == (dec("30.75"), dec("-6.27"))


def test_fact_columns(spark):
    assert models(spark, [order()])["fct_orders"].columns == [
        "order_id", "customer_id", "product_id", "order_date", "source_system", "is_late_arriving", "category",
        "region", "quantity", "unit_price", "unit_cost", "revenue", "gross_margin",
    ]


def test_monthly_summary(spark):
    orders = [order("1", "2024-01-05", quantity=2), order("2", "2024-01-31"), order("3", "2024-02-01")]
    rows = {r.order_month: r for r in models(spark, orders)["mart_monthly_kpis"].collect()}
    january = rows[day("2024-01-01")]
    assert (january.order_count, january.units_sold) == (2, 3)
    assert (january.total_revenue, january.total_gross_margin) == (dec("30.75"), dec("18.45"))
    assert january.margin_pct == dec("60.00")
    assert set(rows) == {day("2024-01-01"), day("2024-02-01")}


def test_unique_counting_is_the_same_where_orders_are_unique(spark):
    fact = marts.build_models(testdata.raw_tables(spark, TINY))["fct_orders"]
    exact = marts.mart_monthly_kpis(fact)
    fast = marts.mart_monthly_kpis(fact, unique_orders=True)
    assert exact.exceptAll(fast).count() == 0 and fast.exceptAll(exact).count() == 0


def test_monthly_summary_adds_up_to_the_fact(spark):
    built = marts.build_models(testdata.raw_tables(spark, TINY))
    total = built["mart_monthly_kpis"].agg(F.sum("total_revenue"), F.sum("units_sold"), F.sum("order_count")).first()
    fact = built["fct_orders"].agg(F.sum("revenue"), F.sum("quantity"), F.count("*")).first()
    assert tuple(total) == tuple(fact)
    flags = built["int_orders_validated"].filter("not (is_valid_customer and is_valid_product)").count()
    assert fact[2] + flags == built["stg_orders"].count()


@pytest.mark.parametrize(
    ("part", "whole", "expected"),
    [
        ("1.00", "0.00", None),
        ("0.00", "5.00", "0.00"),
        (None, "5.00", None),
        ("5.00", None, None),
        ("-1.00", "3.00", "-33.33"),
        ("1.00", "-3.00", "-33.33"),
        ("-1.00", "-3.00", "33.33"),
        # 12.344996 %: a quotient cut to six places would round to 12.35 in two steps.
        ("12344996.00", "100000000.00", "12.34"),
        ("12345000.00", "100000000.00", "12.35"),
        ("-12345000.00", "100000000.00", "-12.35"),
    ],
)
def test_percent(spark, part, whole, expected):
    values = [(part and dec(part), whole and dec(whole))]
    df = spark.createDataFrame(values, "a decimal(31,2), b decimal(31,2)")
    assert df.select(percent(F.col("a"), F.col("b"))).first()[0] == (expected and dec(expected))


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(st.integers(-(10**22), 10**22), st.integers(-(10**22), 10**22)),
        min_size=1,
        max_size=60,
    )
)
def test_ratio_is_exact(spark, pairs):
    table = [(i, dec(a) / 100, dec(b) / 100) for i, (a, b) in enumerate(pairs)]
    df = spark.createDataFrame(table, "i int, a decimal(30,2), b decimal(30,2)")
    got = {r.i: r.x for r in df.select("i", ratio(F.col("a"), F.col("b")).alias("x")).collect()}
    for i, (a, b) in enumerate(pairs):
        if b == 0:
            assert got[i] is None
            continue
        hundredths = (2 * 100 * abs(a) + abs(b)) // (2 * abs(b))
        sign = -1 if (a < 0) != (b < 0) else 1
        assert int(got[i] * 100) == sign * hundredths


def test_rounding_is_half_away_from_zero(spark):
    df = spark.createDataFrame([(dec("2.345"),), (dec("-2.345"),)], "x decimal(10,3)")
    assert [r[0] for r in df.select(F.round("x", 2)).collect()] == [dec("2.35"), dec("-2.35")]


def strategies_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_small_dimensions_are_broadcast_and_joins_become_inner(spark):
    plan = strategies_of(marts.build_models(testdata.raw_tables(spark, TINY))["fct_orders"])
    assert "BroadcastHashJoin" in plan and "LeftOuter" not in plan
    # The only full shuffle of orders is the one that finds repeats.
    assert plan.count("Exchange hashpartitioning") == 1


def test_measured_size_decides_the_broadcast(spark):
    dimension = spark.createDataFrame([(str(i), "x" * 100) for i in range(1000)], "k string, v string")
    size = joins.measured_bytes(dimension)
    assert 100_000 < size < 300_000
    hinted = joins.broadcast_if_small(dimension, size)
    plain = joins.broadcast_if_small(dimension, size - 1)
    assert "broadcast" in hinted._jdf.queryExecution().logical().toString()
    assert "broadcast" not in plain._jdf.queryExecution().logical().toString()
    assert joins.measured_bytes(dimension.limit(0)) == 0


@pytest.fixture
def shuffled(spark):
    """Settings under which nothing is broadcast and small partitions count as skewed."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.mark.parametrize("hot", ["7", None, "nobody"])
def test_large_dimensions_are_shuffled_and_hot_keys_split(spark, shuffled, hot):
    """A third of the orders share one key: known, NULL or unknown."""
    base = testdata.raw_orders(spark, "/root/testdata/sf0.01").repartition(16)
    skewed = F.when(F.col("order_id").cast("long") % 3 == 0, F.lit(hot)).otherwise(F.col("customer_id"))
    orders = base.dropDuplicates(["order_id"]).withColumn("customer_id", skewed).repartition(16)
    customers = testdata.raw_customers(spark, "/root/testdata/sf0.01")
    joined = joins.lookup(orders, customers, "customer_id", ["region"], "known", limit_bytes=0)
    plan = strategies_of(joined)
    assert "skew=true" in plan and "Broadcast" not in plan
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    plain = orders.join(F.broadcast(customers.select("customer_id", "region")), "customer_id", "left")
    assert joined.select("order_id", "region").exceptAll(plain.select("order_id", "region")).count() == 0
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    assert joined.count() == orders.count()


DATES = {
    "legacy_pos": {"01/05/2024": "2024-01-05", "2/9/2024": "2024-02-09", "13/45/2024": None, "2024-01-05": None},
    "web_platform": {"2024-01-05": "2024-01-05", "2024-2-9": "2024-02-09", "01/05/2024": None, None: None},
    "kiosk": {"2024-01-05": None},
}
CUSTOMERS = [("c1", "A", "B", "C", "east", None), ("c2", "A", "B", "C", "west", None)]
PRODUCTS = [("p1", "x", "toys", "4.10", "10.25"), ("p2", "y", "books", "12.00", "9.99")]

raw_rows = st.lists(
    st.sampled_from(sorted(DATES)).flatmap(
        lambda source: st.tuples(
            st.sampled_from("123456"),
            st.sampled_from(["c1", "c2", "c9", None]),
            st.sampled_from(["p1", "p2", "p9"]),
            st.integers(-2, 5),
            st.sampled_from(list(DATES[source])),
            st.integers(0, 60 * 24 * 60).map(lambda m: datetime.datetime(2024, 1, 5) + datetime.timedelta(minutes=m)),
            st.just(source),
        )
    ),
    min_size=1,
    max_size=30,
)


def expected_models(rows):
    """The whole chain by hand: staged orders, fact and monthly figures."""
    staged = {}
    for row in rows:
        rank = (row[5], *[(v is not None, v) for v in (row[1], row[2], row[3], row[4], row[6])])
        if row[0] not in staged or rank < staged[row[0]][0]:
            staged[row[0]] = (rank, row)
    regions = {c[0]: c[4] for c in CUSTOMERS}
    prices = {p[0]: (p[2], dec(p[3]), dec(p[4])) for p in PRODUCTS}
    fact, months = {}, {}
    for order_id, (_, (_, customer, product, quantity, text, load, source)) in staged.items():
        if customer not in regions or product not in prices:
            continue
        date = DATES[source][text] and day(DATES[source][text])
        category, cost, price = prices[product]
        late = None if date is None else (load.date() - date).days > 30
        revenue, margin = quantity * price, quantity * (price - cost)
        fact[order_id] = (date, late, regions[customer], category, revenue, margin)
        key = (date and date.replace(day=1), regions[customer], category)
        n, units, r, m = months.get(key, (0, 0, 0, 0))
        months[key] = (n + 1, units + quantity, r + revenue, m + margin)
    return len(staged), fact, months


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(raw_rows)
def test_whole_chain_matches_brute_force(spark, rows):
    built = models(spark, [(*r[:5], r[5].isoformat(), r[6]) for r in rows], CUSTOMERS, PRODUCTS)
    staged, fact, months = expected_models(rows)
    assert built["stg_orders"].count() == staged
    got = built["fct_orders"].collect()
    assert {
        r.order_id: (r.order_date, r.is_late_arriving, r.region, r.category, r.revenue, r.gross_margin) for r in got
    } == fact and len(got) == len(fact)
    monthly = {
        (r.order_month, r.region, r.category): (r.order_count, r.units_sold, r.total_revenue, r.total_gross_margin)
        for r in built["mart_monthly_kpis"].collect()
    }
    assert monthly == months
