"""Every registered query against its SQL oracle: names, types and exact values."""

import os

import pytest
from comparison import differences

import __spark_entry__ as contract

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
QUERIES = contract.queries()
ORACLE = contract.oracle_sql()


def test_every_query_has_an_oracle():
    corpus = set(contract.CORPUS_QUERIES)
    assert set(QUERIES) - corpus == set(ORACLE) - corpus
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, name):
    problems, _ = differences(QUERIES[name](spark, SF_DIR), SF_DIR, ORACLE[name])
    assert not problems


def test_entry(spark):
    assert contract.entry(spark).limit(1).count() == 1


# Figures at sf0.01, checked by both engines.
CHECKED = {
    "raw_orders_scan": 15375,
    "stg_orders": 15000,
    "fct_orders": 14790,
    "mart_monthly_kpis": 2366,
    "revenue_trends": 2399,
    "test_unique": 375,
    "test_relationships": 101,
    "test_relationships_product": 110,
    "bad_date_report": 91,
    "late_arrival_report": 159,
}


@pytest.mark.parametrize("name", sorted(CHECKED))
def test_known_row_counts(spark, name):
    assert QUERIES[name](spark, "/root/testdata/sf0.01").count() == CHECKED[name]


def test_known_totals(spark):
    row = QUERIES["kpi_scorecard"](spark, "/root/testdata/sf0.01").first()
    assert (row.total_revenue, row.gross_margin, row.avg_order_value) == (42104572.90, 12594734.60, 2846.83)
    audit = QUERIES["orphan_audit"](spark, "/root/testdata/sf0.01").first()
    assert tuple(audit) == (15000, 101, 110, 1, 14790)
