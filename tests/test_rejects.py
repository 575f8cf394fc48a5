"""Rows that do not fit their schema."""

import pytest

from orderloom.plans import pipeline
from orderloom.schemas import LOADED_AT, RAW_ORDERS
from orderloom.sources import rejects
from orderloom.sources.csv_files import delivered_rows

HEADER = "order_id,customer_id,product_id,quantity,order_date,load_timestamp,source_system\n"
GOOD = "1,c1,p1,2,2024-01-05,2024-01-05 10:00:00,web_platform\n"
BAD = {
    "2,c1,p1,2.5,2024-01-05,2024-01-05 10:00:00,web_platform": "quantity is no int",
    "3,c1,p1,2,2024-01-05,yesterday,web_platform": "load_timestamp is no timestamp_ntz",
    "4,c1,p1,2": "not 7 fields",
    "5,c1,p1,2,2024-01-05,2024-01-05 10:00:00,web_platform,more": "not 7 fields",
    '6,"c,1",p1,x,2024-01-05,2024-01-05 10:00:00,web_platform': "quantity is no int",
}


@pytest.fixture
def feed(tmp_path):
    folder = tmp_path / "feed"
    folder.mkdir()
    lines = [f"{line}\n" for line in BAD]
    (folder / "a.csv").write_text(HEADER + GOOD + "".join(lines[:2]) + GOOD)
    (folder / "b.csv").write_text(HEADER + "".join(lines[2:]) + GOOD.replace("c1", "").replace("2,", "7,", 1))
    return str(folder)


def test_every_row_is_landed_or_listed(spark, feed, tmp_path):
    rows = rejects.read_permissive(spark, feed, RAW_ORDERS)
    landed = rejects.load_with_rejects(rows, RAW_ORDERS, str(tmp_path / "landed"), most=5)
    listed = landed.rejects.collect()
    assert {r.record: r.reason for r in listed} == BAD
    assert [r.file.rsplit("/", 1)[1] for r in sorted(listed, key=lambda r: r.record)] == ["a.csv"] * 2 + ["b.csv"] * 3
    assert landed.good.columns == [*RAW_ORDERS.names, LOADED_AT] and landed.good.count() == landed.good_rows == 3
    assert landed.good_rows + landed.rejected_rows == delivered_rows(spark, feed) == 8
    assert landed.good.schema[3].dataType == RAW_ORDERS[3].dataType


def test_too_many_rejects_stop_the_load(spark, feed, tmp_path):
    rows = rejects.read_permissive(spark, feed, RAW_ORDERS)
    with pytest.raises(rejects.TooManyRejects, match="5 of 8 rows do not fit, 4 are allowed"):
        rejects.load_with_rejects(rows, RAW_ORDERS, str(tmp_path / "landed"), most=4)


def test_a_feed_without_faults(spark, tmp_path):
    (tmp_path / "a.csv").write_text(HEADER + GOOD)
    rows = rejects.read_permissive(spark, str(tmp_path / "a.csv"), RAW_ORDERS)
    landed = rejects.load_with_rejects(rows, RAW_ORDERS, str(tmp_path / "landed"), most=0)
    assert landed.good_rows == 1 and landed.rejects.collect() == []
    (tmp_path / "none.csv").write_text(HEADER)
    rows = rejects.read_permissive(spark, str(tmp_path / "none.csv"), RAW_ORDERS)
    landed = rejects.load_with_rejects(rows, RAW_ORDERS, str(tmp_path / "landed-2"), most=0)
    assert landed.good_rows == landed.rejected_rows == landed.good.count() == 0


def _paths(tmp_path, feed):
    (tmp_path / "customers.csv").write_text(
        "customer_id,first_name,last_name,email,region,signup_date\nc1,A,B,a@b.c,West,2024-01-01\n"
    )
    (tmp_path / "products.csv").write_text("product_id,product_name,category,unit_cost,unit_price\np1,L,H,4.1,10.25\n")
    return {"customers": str(tmp_path / "customers.csv"), "products": str(tmp_path / "products.csv"), "orders_raw": feed}


def test_the_pipeline_publishes_what_it_left_out(spark, feed, tmp_path):
    root = str(tmp_path / "w")
    feeds = pipeline.csv_feeds(spark, _paths(tmp_path, feed), most_rejects=5)
    run = pipeline.run_pipeline(spark, feeds, root, "r1")
    assert {(load.table, load.status) for load in run.loads} == {("customers", "OK"), ("products", "OK"), ("orders_raw", "OK")}
    assert pipeline.read_current(spark, root, "orders_raw_rejects").count() == 5
    assert pipeline.read_current(spark, root, "int_orders_validated").count() == 1
    with pytest.raises(pipeline.PipelineStopped, match="4 are allowed"):
        strict = pipeline.csv_feeds(spark, _paths(tmp_path, feed), most_rejects=4)
        pipeline.run_pipeline(spark, strict, root, "r2")
    assert pipeline.tables_of(spark, root) >= {"fct_orders", "orders_raw_rejects"}
