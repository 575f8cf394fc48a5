import pytest
from frames import CUSTOMER, PRODUCT, order, raw_customers, raw_orders, raw_products

from orderloom.sources.csv_files import CsvFeeds, delivered_rows, read_csv
from orderloom.plans import marts, pipeline, trends
from orderloom.schemas import LOADED_AT, RAW
from orderloom.session import MOST_PARTITIONS, sized_shuffles
from orderloom.sources import testdata

TINY = "/root/testdata/sf0.001"


def feeds_of(spark, *orders, customers=(CUSTOMER,), products=(PRODUCT,)):
    return {
        "customers": raw_customers(spark, *customers),
        "products": raw_products(spark, *products),
        "orders_raw": raw_orders(spark, *orders),
    }


@pytest.fixture(scope="module")
def feeds(spark, tmp_path_factory):
    """The derived raw tables, delivered as CSV."""
    folder = tmp_path_factory.mktemp("feeds")
    paths = {}
    for name, df in testdata.raw_tables(spark, TINY).items():
        paths[name] = str(folder / name)
        df.write.option("header", True).option("ignoreLeadingWhiteSpace", False).option(
            "ignoreTrailingWhiteSpace", False
        ).csv(paths[name])
    return pipeline.csv_feeds(spark, paths)


def same(left, right):
    right = right.select(*left.columns)
    return left.exceptAll(right).count() == 0 and right.exceptAll(left).count() == 0


def test_published_tables_equal_the_models(spark, feeds, tmp_path):
    stages = []
    run = pipeline.run_pipeline(spark, feeds, str(tmp_path), "r1", on_stage=stages.append)
    assert tuple(stages) == pipeline.STAGES
    assert [load.status for load in run.loads] == ["OK"] * 3 and len(run.tests) == 17
    assert LOADED_AT in run.read(spark, "orders_raw").columns
    models = marts.build_models(testdata.raw_tables(spark, TINY))
    for table in ("dim_customers", "dim_products", "fct_orders", "mart_monthly_kpis"):
        assert same(models[table], pipeline.read_current(spark, str(tmp_path), table)), table
    assert same(
        trends.revenue_trends(models["fct_orders"]), pipeline.read_current(spark, str(tmp_path), "revenue_trends")
    )
    audit = pipeline.read_current(spark, str(tmp_path), "orphan_audit").first()
    assert audit.valid == models["fct_orders"].count() and audit.staged > audit.valid
    assert {r.failures for r in pipeline.read_current(spark, str(tmp_path), "test_results").collect()} == {0}


def test_running_twice_changes_nothing(spark, feeds, tmp_path):
    """The second attempt gives the same rows, and leaves alone what readers of the first still hold."""
    root = str(tmp_path)
    first = pipeline.run_pipeline(spark, feeds, root, "r1")
    once = pipeline.read_current(spark, root, "fct_orders")
    rows = once.count()
    second = pipeline.run_pipeline(spark, feeds, root, "r1")
    assert not set(first.tables.values()) & set(second.tables.values())
    assert same(once, pipeline.read_current(spark, root, "fct_orders")) and once.count() == rows


def test_broadcast_limit_reaches_the_tests(spark, feeds, tmp_path, monkeypatch):
    limits = []
    lookup = pipeline.lookup
    monkeypatch.setattr(pipeline, "lookup", lambda *how: limits.append(how[-1]) or lookup(*how))
    run = pipeline.run_pipeline(spark, feeds, str(tmp_path), "r1", limit_bytes=0)
    assert limits == [0, 0] and {r.failures for r in run.tests} == {0}


def test_pruning_by_month_reaches_the_files(spark, feeds, tmp_path):
    pipeline.run_pipeline(spark, feeds, str(tmp_path), "r1")
    fact = pipeline.read_current(spark, str(tmp_path), "fct_orders").filter("order_month = date'1996-03-01'")
    plan = fact._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_month" in plan


BROKEN = {
    "duplicate customer": ("models", dict(customers=[CUSTOMER, CUSTOMER])),
    "duplicate product": ("models", dict(products=[PRODUCT, PRODUCT])),
    "bad date": ("tests", dict(orders=[order("1"), order("2", date="13/45/2024")])),
    "unknown source": ("tests", dict(orders=[order("1", source="kiosk")])),
    "missing order id": ("tests", dict(orders=[order(None)])),
    "missing customer id": ("tests", dict(customers=[CUSTOMER, (None, *CUSTOMER[1:])])),
}


@pytest.mark.parametrize("case", BROKEN)
def test_a_failed_check_publishes_nothing(spark, tmp_path, case):
    root = str(tmp_path)
    pipeline.run_pipeline(spark, feeds_of(spark, order("1"), order("2")), root, "good")
    stage, change = BROKEN[case]
    bad = feeds_of(spark, *change.pop("orders", [order("1")]), **change)
    with pytest.raises(pipeline.PipelineStopped) as stopped:
        pipeline.run_pipeline(spark, bad, root, "bad")
    assert stopped.value.stage == stage and stopped.value.problems
    assert pipeline.read_current(spark, root, "fct_orders").count() == 2


def test_shuffles_grow_with_the_orders(spark):
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    with sized_shuffles(spark, rows=10) as few:
        assert str(few) == before == spark.conf.get(key)
    with pytest.raises(ZeroDivisionError), sized_shuffles(spark, rows=10**9) as many:
        # 128 GB in pieces of 256 MB.
        assert many == 477 and spark.conf.get(key) == "477"
        raise ZeroDivisionError
    assert spark.conf.get(key) == before
    with sized_shuffles(spark, rows=10**13) as most:
        assert most == MOST_PARTITIONS


def test_drifted_feed_stops_the_load(spark, tmp_path):
    feeds = feeds_of(spark, order("1"))
    feeds["orders_raw"] = feeds["orders_raw"].withColumnRenamed("quantity", "qty")
    with pytest.raises(pipeline.PipelineStopped, match="missing column quantity"):
        pipeline.run_pipeline(spark, feeds, str(tmp_path), "r1")


def test_short_load_stops_the_run(spark, tmp_path):
    """A delivered line that the reader leaves out is a row too few."""
    header = ",".join(RAW["products"].names)
    path = tmp_path / "products.csv"
    path.write_text(f"{header}\np1,Lamp,Home,4.10,10.25\n\np2,Desk,Home,4.10,10.25\n")
    feeds = feeds_of(spark, order("1")) | {"products": read_csv(spark, str(path), RAW["products"])}
    delivered = {"products": delivered_rows(spark, str(path)), "orders_raw": 1}
    assert delivered["products"] == 3
    counted = CsvFeeds(feeds, {"products": str(path)})
    with pytest.raises(pipeline.PipelineStopped, match="products: expected 3 rows, table has 2"):
        pipeline.run_pipeline(spark, counted, str(tmp_path / "out"), "r0")
    with pytest.raises(pipeline.PipelineStopped, match="products: expected 3 rows, table has 2"):
        pipeline.run_pipeline(spark, feeds, str(tmp_path / "out"), "r1", delivered=delivered)


def test_feeds_cover_the_declared_tables(spark, feeds):
    assert {name: df.schema for name, df in feeds.items()} == RAW


def test_trends_in_database(spark, monkeypatch):
    """The database itself is stood in for: what is read from it and written to it is checked."""
    fact = marts.build_models(testdata.raw_tables(spark, TINY))["fct_orders"]
    calls = []
    monkeypatch.setattr(pipeline.jdbc, "read_table", lambda *how: calls.append(how[2:]) or fact)
    monkeypatch.setattr(pipeline.jdbc, "replace_table", lambda df, c, table, connections: calls.append((df, table)))
    split = pipeline.jdbc.Split("order_date", "1995-01-01", "2001-08-01", 8)
    pipeline.trends_in_database(spark, pipeline.jdbc.Connection("u", "d"), "marts.fct", "marts.trends", split)
    assert calls[0] == ("marts.fct", split)
    assert calls[1][1] == "marts.trends" and same(calls[1][0], trends.revenue_trends(fact))
