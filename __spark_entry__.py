"""

``entry`` runs the monthly KPI mart; ``queries`` lists every operator as a query
over the test tables; ``oracle_sql`` gives the same as SQL. Money and percentages
leave here as DOUBLE, rounded exactly before, and counts as BIGINT.
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

sys.path.insert(0, str(Path(__file__).resolve().parent))

import duckdb_oracle  # noqa: E402
from orderloom.functions.dates import month_of  # noqa: E402
from orderloom.operators import checks  # noqa: E402
from orderloom.operators.dedup import dedup_earliest  # noqa: E402
from orderloom.operators.distinct import distinct_bitmaps, rolled_up  # noqa: E402
from orderloom.operators.rolling import rolling_rows_in_pieces  # noqa: E402
from orderloom.plans import marts, pipeline, quality, reports, staging, trends  # noqa: E402
from orderloom.schemas import LOADED_AT, RAW, RAW_ORDERS  # noqa: E402
from orderloom.session import shared_dir  # noqa: E402
from orderloom.sources import schema_log, testdata  # noqa: E402
from orderloom.sources.bucketed import bucketed, bucketed_lookup, bucketed_orphans  # noqa: E402
from orderloom.sources.csv_files import delivered_rows, read_csv, stamped  # noqa: E402
from orderloom.sources.rejects import load_with_rejects, read_permissive  # noqa: E402
from orderloom.sources.tables import load_table, written  # noqa: E402
from orderloom.streaming import arrivals  # noqa: E402

# The corpus operators and their pipeline may be taken out together, or lack a library they need.
try:
    import corpus_pipeline
    from orderloom.llm import queries as llm_queries
except ImportError as missing:
    print(f"corpus queries left out: {missing}", file=sys.stderr)
    CORPUS_QUERIES, CORPUS_SQL = {}, {}
else:
    CORPUS_QUERIES = llm_queries.queries() | {"pipeline": corpus_pipeline.run}
    CORPUS_SQL = llm_queries.oracle_sql()
    if corpus_pipeline.ORACLE_SQL is not None:
        CORPUS_SQL["pipeline"] = corpus_pipeline.ORACLE_SQL

# The categories and regions of the test tables.
CATEGORIES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]


def _portable(df: DataFrame) -> DataFrame:
    """Decimals as doubles and ranks as bigints, the types both engines share."""
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double").alias(field.name)
        elif isinstance(field.dataType, T.IntegerType) and field.name == "rank":
            column = column.cast("long").alias(field.name)
        columns.append(column)
    return df.select(*columns)


Query = Callable[[SparkSession, str], DataFrame]


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stg_customers(testdata.raw_customers(spark, sf_dir))


def _products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stg_products(testdata.raw_products(spark, sf_dir))


def _staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stg_orders(testdata.raw_orders(spark, sf_dir))


def _validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.int_orders_validated(_staged(spark, sf_dir), _customers(spark, sf_dir), _products(spark, sf_dir))


def _on_fact(query: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: query(marts.fct_orders(_validated(spark, sf_dir)))


def _on_segments(query: Callable[[DataFrame], DataFrame]) -> Query:
    return _on_fact(lambda fact: query(reports.segments_of_orders(fact)))


def _monthly_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers, products = _customers(spark, sf_dir), _products(spark, sf_dir)
    fact = marts.fct_orders(marts.int_orders_validated(_staged(spark, sf_dir), customers, products))
    return marts.mart_monthly_kpis(fact, marts.one_row_per_order(customers, products))


def _dedup_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = testdata.table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "ts")
    return dedup_earliest(events, ["user_id", "event_type"], "ts")


def _not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = staging.stg_orders(testdata.raw_orders_bad(spark, sf_dir))
    return checks.null_counts(staged, RAW_ORDERS.names)


def _orphans(key: str, parents: Query) -> Query:
    return lambda spark, sf_dir: checks.relationships(
        _staged(spark, sf_dir).select("order_id", key), key, parents(spark, sf_dir), key
    )


def _test_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The declared tests over models written once, since each test reads its model again."""
    root = shared_dir(spark, "models")
    customers = written(_customers(spark, sf_dir), f"{root}/dim_customers")
    products = written(_products(spark, sf_dir), f"{root}/dim_products")
    validated = written(
        marts.int_orders_validated(_staged(spark, sf_dir), customers, products), f"{root}/int_orders_validated"
    )
    return quality.run_tests(
        pipeline.written_models(validated, customers, products, marts.fct_orders(validated))
    )


def _reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = testdata.raw_tables(spark, sf_dir)
    delivered = {"customers": "customer", "products": "part", "orders_raw": "orders"}
    return checks.reconcile(
        {name: (testdata.table(spark, sf_dir, source), raw[name]) for name, source in delivered.items()}
    )


def _csv_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the raw orders as a CSV feed, then load that feed."""
    feed = shared_dir(spark, "orders-feed")
    testdata.raw_orders(spark, sf_dir).write.option("header", True).csv(feed)
    return read_csv(spark, feed, RAW_ORDERS)


def _reloaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw orders loaded twice into one table: each row once, and all with the load time of the second load."""
    target = shared_dir(spark, "reloaded")
    for _ in range(2):
        started = spark.range(1).select(F.localtimestamp()).first()[0]
        load_table(stamped(testdata.raw_orders(spark, sf_dir)), "orders_raw", target)
    landed = spark.read.parquet(target)
    return landed.withColumn("of_last_load", F.col(LOADED_AT) >= F.lit(started)).drop(LOADED_AT)


def _csv_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of a delivered CSV feed against the rows that its load landed."""
    feed = shared_dir(spark, "orders-feed")
    testdata.raw_orders(spark, sf_dir).write.option("header", True).csv(feed)
    landed = read_csv(spark, feed, RAW_ORDERS)
    load = load_table(landed, "orders_raw", shared_dir(spark, "landed"), delivered_rows(spark, feed))
    rows = [(load.table, load.expected, load.actual, load.status)]
    return spark.createDataFrame(rows, "table_name string, expected_rows long, actual_rows long, status string")


def _quoted_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products with line breaks in their names: records delivered, and rows landed whole and a hundredth short."""
    feed = shared_dir(spark, "products-feed")
    broken = F.when(F.col("product_id").cast("long") % 3 == 0, F.concat(F.lit('a "b"\n,\n'), "product_name"))
    named = testdata.raw_products(spark, sf_dir).withColumn("product_name", F.coalesce(broken, "product_name"))
    named.write.option("header", True).option("escape", '"').csv(feed)
    landed = read_csv(spark, feed, RAW["products"], multiline=True)
    short = landed.filter(F.col("product_id").cast("long") % 100 != 7)
    count = delivered_rows(spark, feed)
    loads = [load_table(df, name, shared_dir(spark, name), count) for name, df in (("products", landed), ("short", short))]
    rows = [(load.table, load.expected, load.actual, load.status) for load in loads]
    return spark.createDataFrame(rows, "table_name string, expected_rows long, actual_rows long, status string")


def _rejected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An order feed with quantities and load times that are none: what its load leaves out, and why."""
    feed, k = shared_dir(spark, "orders-feed"), F.col("order_id").cast("long")
    text = {"quantity": F.when(k % 499 == 3, "2.5"), "load_timestamp": F.when(k % 509 == 1, "yesterday")}
    orders = testdata.raw_orders(spark, sf_dir)
    faulty = orders.withColumns({c: F.coalesce(wrong, F.col(c).cast("string")) for c, wrong in text.items()})
    faulty.write.option("header", True).csv(feed)
    rows = read_permissive(spark, feed, RAW_ORDERS)
    landed = load_with_rejects(rows, RAW_ORDERS, shared_dir(spark, "landed"), most=delivered_rows(spark, feed))
    good = landed.good.agg(F.lit("landed").alias("order_id"), F.count("*").cast("string").alias("reason"))
    return landed.rejects.select(F.split_part("record", F.lit(","), F.lit(1)).alias("order_id"), "reason").unionAll(good)


def _event_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trailing sums over single events, all of them in one order."""
    events = testdata.table(spark, sf_dir, "events")
    cents = F.floor(F.col("value") * 100).cast("decimal(18,0)")
    amounts = events.select("event_id", "ts", (cents / 100).cast("decimal(18,2)").alias("amount"))
    frames, names = {"7": 7, "30": 30}, ("amount_rolling_{}", "avg_amount_{}")
    folder = shared_dir(spark, "event-trends")
    return rolling_rows_in_pieces(amounts, ["ts", "event_id"], "amount", frames, names, folder, piece_rows=20_000)


def _heatmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The categories come from the small product dimension, so the orders are gone through once."""
    customers, products = _customers(spark, sf_dir), _products(spark, sf_dir)
    fact = marts.fct_orders(marts.int_orders_validated(_staged(spark, sf_dir), customers, products))
    return reports.region_category_heatmap(reports.segments_of_orders(fact), reports.categories_of(products))


def _customers_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct customers of a year and region, from bitmaps of its months and categories."""
    fact = marts.fct_orders(_validated(spark, sf_dir))
    monthly = fact.withColumn("order_month", month_of(F.col("order_date")))
    by = ["order_month", "region", "category"]
    bitmaps = distinct_bitmaps(monthly, "customer_id", by, shared_dir(spark, "customer-bitmaps"))
    yearly = bitmaps.withColumn("order_year", F.year("order_month").cast("long"))
    return rolled_up(yearly, ["order_year", "region"], "customers")


def _bucketed(query: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    """A query on staged orders and customers that were both stored by customer."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder = shared_dir(spark, "by-customer")
        tables = (_staged(spark, sf_dir), _customers(spark, sf_dir))
        return query(*[bucketed(df, "customer_id", 16, folder) for df in tables])

    return run


def _schema_versions(report: Callable[[SparkSession, str, str], DataFrame]) -> Query:
    """Orders in three deliveries: the second moves a column and adds one, the third renames one and leaves one out."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        root, k = shared_dir(spark, "deliveries"), F.col("order_id").cast("long")
        orders = testdata.raw_orders(spark, sf_dir)
        channel = F.concat(F.lit("channel "), (k % 7).cast("string"))
        moved = ["quantity", *[c for c in orders.columns if c != "quantity"], "channel"]
        later = orders.withColumn("channel", channel).select(*moved)
        third = later.filter(k % 3 == 2).withColumnRenamed("customer_id", "client_id").drop("source_system")
        schema_log.land(orders.filter(k % 3 == 0), root, "orders")
        schema_log.land(later.filter(k % 3 == 1), root, "orders")
        schema_log.land(third, root, "orders", renames={"client_id": "customer_id"})
        return report(spark, root, "orders")

    return query


def _published(table: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = shared_dir(spark, "warehouse")
        feeds = {name: df.to(RAW[name]) for name, df in testdata.raw_tables(spark, sf_dir).items()}
        pipeline.run_pipeline(spark, feeds, root, "run-1")
        return pipeline.read_current(spark, root, table)

    return query


def _delivered(table: str, run_id: str | None = None) -> Query:
    """The whole pipeline over a first delivery, then only the months that a second one touches."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = shared_dir(spark, "warehouse")
        dimensions = {name: getattr(testdata, f"raw_{name}")(spark, sf_dir).to(RAW[name]) for name in ("customers", "products")}
        first, second = (df.to(RAW_ORDERS) for df in testdata.raw_deliveries(spark, sf_dir))
        pipeline.run_pipeline(spark, dimensions | {"orders_raw": first}, root, "run-1")
        pipeline.run_delivery(spark, dimensions | {"orders_raw": second}, root, "run-2")
        return pipeline.read_current(spark, root, table, run_id)

    return query


def _stream(dedup: bool) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        feed, target, marks = (shared_dir(spark, name) for name in ("feed", "landed", "marks"))
        # Rows are dealt to the files at random, so retries come in any order and any batch.
        raw = testdata.raw_orders(spark, sf_dir)
        (raw.repartition(8) if dedup else raw).write.option("header", True).csv(feed)
        stream = arrivals.stream_csv(spark, feed, RAW_ORDERS, max_files=2)
        load = arrivals.load_without_retries if dedup else arrivals.load_available
        arrivals.finish(load(stream, target, marks))
        landed = spark.read.parquet(target)
        # Which copy of a retried order is seen first is open, so its arrival time is too.
        return landed.select(*[c for c in RAW_ORDERS.names if not (dedup and c == "load_timestamp")])

    return query


def _two_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two streams into one table, sharing a tenth of their rows; then the first once more, its checkpoint lost."""
    raw = testdata.raw_orders(spark, sf_dir)
    part = F.pmod(F.xxhash64("order_id", "load_timestamp"), F.lit(10))
    target = shared_dir(spark, "landed")
    feeds = [shared_dir(spark, "feed") for _ in range(2)]
    for feed, rows in zip(feeds, (raw.filter(part <= 5), raw.filter(part >= 5)), strict=True):
        rows.repartition(4).write.option("header", True).csv(feed)
    for feed in (feeds[0], feeds[1], feeds[0]):
        stream = arrivals.stream_csv(spark, feed, RAW_ORDERS, max_files=2)
        arrivals.finish(arrivals.load_without_retries(stream, target, shared_dir(spark, "marks")))
    landed = spark.read.parquet(target)
    return landed.select(*[c for c in RAW_ORDERS.names if c != "load_timestamp"])


def entry(spark: SparkSession) -> DataFrame:
    """The monthly KPI mart from raw tables: every model of the engine in one plan."""
    return queries()["mart_monthly_kpis"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    found = {
        "raw_orders_scan": testdata.raw_orders,
        "csv_load": _csv_load,
        "csv_reconciliation": _csv_reconciliation,
        "reloaded_orders": _reloaded,
        "rejected_rows": _rejected_rows,
        "csv_quoted_reconciliation": _quoted_reconciliation,
        "stg_customers": _customers,
        "stg_products": _products,
        "stg_orders": _staged,
        "dedup_events": _dedup_events,
        "int_orders_validated": _validated,
        "dim_customers": lambda spark, sf_dir: marts.dim_customers(_customers(spark, sf_dir)),
        "dim_products": lambda spark, sf_dir: marts.dim_products(_products(spark, sf_dir)),
        "fct_orders": _on_fact(lambda f: f),
        "mart_monthly_kpis": _monthly_kpis,
        "daily_revenue": _on_fact(trends.daily_revenue),
        "revenue_trends": _on_fact(trends.revenue_trends),
        "revenue_trends_calendar": _on_fact(trends.revenue_trends_calendar),
        "revenue_trends_by_segment": _on_fact(lambda f: trends.revenue_trends(f, by=("region", "category"))),
        "test_unique": lambda spark, sf_dir: checks.unique(testdata.raw_orders(spark, sf_dir), "order_id"),
        "test_not_null": _not_null,
        "test_relationships": _orphans("customer_id", _customers),
        "test_relationships_product": _orphans("product_id", _products),
        "test_suite": _test_suite,
        "load_reconciliation": _reconciliation,
        "orphan_audit": lambda spark, sf_dir: quality.orphan_audit(_validated(spark, sf_dir)),
        "duplicate_audit": lambda spark, sf_dir: checks.duplicates(
            testdata.raw_orders(spark, sf_dir), "order_id", by=("source_system",)
        ),
        "duplicate_total": lambda spark, sf_dir: checks.duplicates(testdata.raw_orders(spark, sf_dir), "order_id"),
        "late_arrival_report": lambda spark, sf_dir: quality.late_arrivals(_staged(spark, sf_dir)),
        "bad_date_report": lambda spark, sf_dir: staging.bad_dates(testdata.raw_orders_bad(spark, sf_dir)),
        "kpi_scorecard": _on_segments(reports.kpi_scorecard),
        "margin_vs_revenue": _on_segments(reports.margin_vs_revenue),
        "region_category_heatmap": _heatmap,
        "event_trends": _event_trends,
        "customers_by_year": _customers_by_year,
        "conditional_totals": _on_segments(lambda s: reports.conditional_totals(s, REGIONS)),
        "kpi_breakdowns": _on_segments(reports.kpi_breakdowns),
        "top_bottom_performers": _on_segments(reports.top_bottom_performers),
        "top_categories_by_region": _on_segments(reports.top_categories_by_region),
        "consistent_top_categories": _on_segments(lambda s: reports.consistent_top_categories(s, n=4)),
        "bucketed_customers": _bucketed(
            lambda orders, customers: bucketed_lookup(orders, customers, ["region"], "is_valid_customer").select(
                "order_id", "customer_id", "region", "is_valid_customer"
            )
        ),
        "bucketed_relationships": _bucketed(lambda o, c: bucketed_orphans(o, c).select("order_id", "customer_id")),
        "schema_drift": _schema_versions(schema_log.drift_report),
        "schema_versions_merged": _schema_versions(schema_log.read_landed),
        "published_monthly_kpis": _published("mart_monthly_kpis"),
        "published_revenue_trends": _published("revenue_trends"),
        "published_orphan_audit": _published("orphan_audit"),
        "published_test_results": _published("test_results"),
        "incremental_monthly_kpis": _delivered("mart_monthly_kpis"),
        "incremental_revenue_trends": _delivered("revenue_trends"),
        "published_as_of": _delivered("mart_monthly_kpis", "run-1"),
        "stream_raw_load": _stream(dedup=False),
        "stream_retry_dedup": _stream(dedup=True),
        "stream_two_feeds": _two_feeds,
    }
    registered = {name: _as_portable(query) for name, query in found.items()}
    return registered | CORPUS_QUERIES


def _as_portable(query: Query) -> Query:
    return lambda spark, sf_dir: _portable(query(spark, sf_dir))


def oracle_sql() -> dict[str, str]:
    return duckdb_oracle.oracle_sql(CATEGORIES, REGIONS) | CORPUS_SQL
