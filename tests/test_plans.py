"""The shape of the plans: what is read, shuffled and joined, and how."""

import re

import pytest

import __spark_entry__ as contract

TINY = "/root/testdata/sf0.001"
# The corpus operators' own tests say which of them do without Python.
QUERIES = {name: query for name, query in contract.queries().items() if name not in contract.CORPUS_QUERIES}


def plan_of(df):
    """The physical plan as it was run, without the plan it started from."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


WRITTEN = {name for name in QUERIES if name.startswith("published_")} | {"stream_raw_load", "stream_retry_dedup"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITTEN))
def test_no_query_needs_python_or_a_product_of_tables(spark, name):
    plan = plan_of(QUERIES[name](spark, TINY))
    for operator in ("CartesianProduct", "NestedLoopJoin", "Python", "Pandas", "rangepartitioning"):
        assert operator not in plan


def read_schemas(plan):
    found = {}
    for table, columns in re.findall(r"sf0\.001/(\w+)\.parquet\].*?ReadSchema: struct<(.*?)>", plan):
        found[table] = sorted(c.split(":")[0] for c in columns.split(",") if c)
    return found



def test_scans_read_only_the_columns_in_use(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    try:
        plan = QUERIES["daily_revenue"](spark, TINY)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    read = read_schemas(plan)
    assert read["orders"] == ["o_custkey", "o_orderdate", "o_orderkey"]
    assert read["customer"] == ["c_custkey", "c_nationkey"]
    assert read["part"] in (["p_partkey", "p_retailprice"], [])


# Full shuffles of orders: exchanges below which no aggregate by month, day or segment lies.
@pytest.mark.parametrize(
    ("name", "exchanges"),
    [
        ("stg_orders", 1),
        ("int_orders_validated", 1),
        ("fct_orders", 1),
        ("test_unique", 1),
        ("test_relationships", 1),
        ("bad_date_report", 1),
        ("late_arrival_report", 2),
        ("mart_monthly_kpis", 2),
        ("daily_revenue", 2),
        ("kpi_scorecard", 2),
    ],
)
def test_shuffles(spark, name, exchanges):
    plan = plan_of(QUERIES[name](spark, TINY))
    assert plan.count("Exchange hashpartitioning") == exchanges


def test_combining_precedes_every_shuffle(spark):
    """Below each exchange of the monthly mart lies the partial step of its aggregate."""
    plan = QUERIES["mart_monthly_kpis"](spark, TINY)._jdf.queryExecution().executedPlan().toString()
    below = [plan[m.end() :] for m in re.finditer("Exchange hashpartitioning", plan)]
    for rest in below:
        first = re.search(r"(Hash|Sort)Aggregate\(.*", rest)
        assert first and "partial_" in first.group(0)


def test_totals_are_computed_once(spark):
    """Both uses of the category totals share one exchange."""
    assert "ReusedExchange" in plan_of(QUERIES["margin_vs_revenue"](spark, TINY))
