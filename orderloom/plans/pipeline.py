"""The daily run: load, build models, test them, compute trends, then publish.

A stage that fails stops the run before anything is published, and readers keep
seeing the previous run. Expensive models are written once and read back, so a
lost executor costs its own tasks and not the whole chain of joins.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from orderloom.functions.dates import month_of
from orderloom.operators import checks
from orderloom.operators.lookup import BROADCAST_LIMIT, broadcast_if_small, lookup
from orderloom.plans import marts, quality, staging
from orderloom.plans.trends import daily_revenue, revenue_trends, trends_of_days
from orderloom.schemas import RAW, RAW_ORDERS
from orderloom.session import sized_shuffles
from orderloom.sources import jdbc
from orderloom.sources.csv_files import CsvFeeds, read_csv, stamped
from orderloom.sources.folders import partitions_of
from orderloom.sources.rejects import TooManyRejects, load_with_rejects, read_permissive
from orderloom.sources.tables import (
    Load,
    Part,
    load_table,
    publish,
    published_parts,
    published_tables,
    read_parts,
    read_published,
    spread,
    written,
)

STAGES = ("load", "models", "tests", "trends")
MONTH = "order_month"
# Tables with a folder for each month; a later run may replace some of them only.
MONTHLY = ("int_orders_validated", "fct_orders")
PUBLISHED = (
    "dim_customers",
    "dim_products",
    *MONTHLY,
    "mart_monthly_kpis",
    "daily_revenue",
    "revenue_trends",
    "orphan_audit",
    "test_results",
)


class PipelineStopped(RuntimeError):
    """A stage failed; ``stage`` names it and nothing was published."""

    def __init__(self, stage: str, problems: list[str]):
        super().__init__(f"stage {stage!r} failed: " + "; ".join(problems))
        self.stage = stage
        self.problems = problems


@dataclass
class Run:
    """What a finished run did."""

    run_id: str
    folder: str
    loads: list[Load] = field(default_factory=list)
    tests: list[Row] = field(default_factory=list)
    tables: dict[str, str] = field(default_factory=dict)

    def landed(self, table: str) -> int:
        return next(load.actual for load in self.loads if load.table == table)

    def rejects(self) -> list[str]:
        """The tables of rows that were left out, where some may be."""
        return [name for name in self.tables if name.endswith("_rejects")]

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        return spark.read.parquet(self.tables[table])


def csv_feeds(
    spark: SparkSession,
    paths: Mapping[str, str],
    multiline: bool = False,
    check_header: bool = True,
    most_rejects: int | None = None,
) -> CsvFeeds:
    """The three raw feeds from CSV files, by table name; renamed or moved columns fail.

    A row that does not fit its schema fails the load. With ``most_rejects`` up to so many rows of each feed are left
    out instead, and published with the reason as ``<table>_rejects``; such feeds have no line breaks between quotes.
    """
    if most_rejects is None:
        feeds = {name: read_csv(spark, paths[name], schema, multiline, check_header) for name, schema in RAW.items()}
    else:
        feeds = {name: read_permissive(spark, paths[name], schema, check_header) for name, schema in RAW.items()}
    return CsvFeeds(feeds, paths, most_rejects)


def run_pipeline(
    spark: SparkSession,
    feeds: Mapping[str, DataFrame],
    root: str,
    run_id: str,
    limit_bytes: int = BROADCAST_LIMIT,
    on_stage: Callable[[str], None] = lambda stage: None,
    delivered: Mapping[str, int] | None = None,
) -> Run:
    """Run all stages over ``feeds`` and publish under ``root``, a folder all executors share.

    ``delivered`` has the rows that the sources hold, by table, as a manifest counts them; a load that lands others
    stops the run. For feeds of :func:`csv_feeds` the lines of the files are counted where it says nothing.

    The orders are shuffled three times: to drop retries, to gather months, and by order id for the tests. All
    other tests and the audit are counted while tables are written.

    Every attempt writes to a folder of its own, also when a ``run_id`` is used
    again, so what readers see is never overwritten. ``tables.remove_unreferenced`` removes folders of
    replaced and failed attempts.
    """
    attempt = _Attempt(spark, root, run_id, limit_bytes)
    on_stage("load")
    raw = _load(spark, feeds, attempt.run, _expected(spark, feeds, delivered))

    on_stage("models")
    attempt.dimensions(raw)
    landed = attempt.run.landed("orders_raw")
    with sized_shuffles(spark, landed):
        attempt.orders(raw["orders_raw"], landed)
        on_stage("tests")
        attempt.tests()
        on_stage("trends")
        # The tests have shown order ids to be unique, so the summary need not shuffle them.
        attempt.stored("mart_monthly_kpis", marts.mart_monthly_kpis(attempt.fact, unique_orders=True))
        daily = attempt.stored("daily_revenue", daily_revenue(attempt.fact))
    attempt.stored("revenue_trends", trends_of_days(daily))
    attempt.stored("orphan_audit", spark.createDataFrame([attempt.audit], _AUDIT))
    publish(spark, root, run_id, {name: [attempt.part(name)] for name in (*PUBLISHED, *attempt.run.rejects())})
    return attempt.run


def run_delivery(
    spark: SparkSession,
    feeds: Mapping[str, DataFrame],
    root: str,
    run_id: str,
    limit_bytes: int = BROADCAST_LIMIT,
    on_stage: Callable[[str], None] = lambda stage: None,
    delivered: Mapping[str, int] | None = None,
) -> Run:
    """Bring the published tables up to date with more orders, rebuilding only the months they touch.

    ``feeds`` has the orders that arrived since, and the customers and products as they are now. The result equals
    a run over all orders delivered so far. A month is touched when an order of the delivery belongs to
    it, when it holds an order that the delivery repeats, and when it holds an order of a customer or product
    that was added, removed or changed. Touched months are staged again from their orders and the delivery's,
    written to a folder of this run, and published beside the untouched folders of earlier runs, which are neither
    copied nor read, but for the columns of their keys.

    Tests cover the months rebuilt: an order of the delivery can be in no other month, and the others
    passed when they were built.
    """
    attempt = _Attempt(spark, root, run_id, limit_bytes)
    before = {name: published_parts(spark, root, name) for name in PUBLISHED}
    on_stage("load")
    raw = _load(spark, feeds, attempt.run, _expected(spark, feeds, delivered))

    on_stage("models")
    attempt.dimensions(raw)
    old = read_parts(spark, before["int_orders_validated"])
    months = attempt.touched_months(old, raw["orders_raw"], before)
    touched = F.col(MONTH).isin(months) if months else F.lit(False)
    again = old.filter(touched)
    size = attempt.run.landed("orders_raw") + again.count()
    with sized_shuffles(spark, size):
        delivery = raw["orders_raw"].select(*RAW_ORDERS.names)
        attempt.orders(staging.as_delivered(again).unionByName(delivery), size)
        on_stage("tests")
        attempt.tests()
        on_stage("trends")
        kept = read_parts(spark, before["mart_monthly_kpis"]).filter(~touched)
        monthly = marts.mart_monthly_kpis(attempt.fact, unique_orders=True)
        attempt.stored("mart_monthly_kpis", kept.unionByName(monthly))
        days = read_parts(spark, before["daily_revenue"]).withColumn(MONTH, month_of(F.col("order_date")))
        days = days.filter(~touched).drop(MONTH)
        daily = attempt.stored("daily_revenue", days.unionByName(daily_revenue(attempt.fact)))
    attempt.stored("revenue_trends", trends_of_days(daily))

    names = (*PUBLISHED, *attempt.run.rejects())
    parts = {name: [attempt.part(name)] for name in names if name in attempt.run.tables}
    gone = {f"{MONTH}={month.isoformat()}" for month in months}
    for name in MONTHLY:
        for part in before[name]:
            left = tuple(p for p in part.partitions or () if p not in gone)
            if left:
                parts[name].append(Part(part.path, left))
    # Two columns of every order, read without a shuffle.
    attempt.stored("orphan_audit", quality.orphan_audit(read_parts(spark, parts["int_orders_validated"])))
    publish(spark, root, run_id, parts | {"orphan_audit": [attempt.part("orphan_audit")]})
    return attempt.run


def read_current(spark: SparkSession, root: str, table: str, run_id: str | None = None) -> DataFrame:
    """A table of the last published run, or as the run of that id left it."""
    return read_published(spark, root, table, run_id)


def tables_of(spark: SparkSession, root: str) -> set[str]:
    """The tables that can be read with :func:`read_current`."""
    return published_tables(spark, root)


def trends_in_database(
    spark: SparkSession,
    connection: jdbc.Connection,
    source: str,
    target: str,
    split: jdbc.Split | list[str],
) -> None:
    """Rolling trends from an order fact kept in a database to a table beside it.

    The fact is read once, by as many tasks as ``split`` says (there is no reading it in one), and only the columns the trends
    use are fetched. The target is replaced in one transaction, after all trends were written beside it.
    """
    fact = jdbc.read_table(spark, connection, source, split)
    jdbc.replace_table(revenue_trends(fact), connection, target, connections=1)


_AUDIT = "staged long, orphan_customer long, orphan_product long, orphan_both long, valid long"
_TESTS = "table_name string, test string, column_name string, failures long"
_LAYERS = {"int_orders_validated": "intermediate"}


class _Attempt:
    """The tables that one attempt of a run writes, and what it counts on the way."""

    def __init__(self, spark: SparkSession, root: str, run_id: str, limit_bytes: int):
        self.spark, self.limit_bytes = spark, limit_bytes
        self.run = Run(run_id, f"{root}/{run_id}/{uuid.uuid4().hex}")

    def stored(self, table: str, df: DataFrame, partition_by: tuple[str, ...] = ()) -> DataFrame:
        self.run.tables[table] = f"{self.run.folder}/{_LAYERS.get(table, 'marts')}/{table}"
        return written(df, self.run.tables[table], partition_by)

    def part(self, table: str) -> Part:
        path = self.run.tables[table]
        return Part(path, tuple(partitions_of(self.spark, path, MONTH)) if table in MONTHLY else None)

    def dimensions(self, raw: Mapping[str, DataFrame]) -> None:
        """Write both dimensions. Duplicate keys multiply the fact, so they stop the run before the join."""
        self.customers = self.stored("dim_customers", staging.stg_customers(raw["customers"]))
        self.products = self.stored("dim_products", staging.stg_products(raw["products"]))
        keys = {"customers": (self.customers, "customer_id"), "products": (self.products, "product_id")}
        both = [checks.key_failures(df, key).withColumn("name", F.lit(name)) for name, (df, key) in keys.items()]
        self.keys = {row["name"]: row for row in both[0].unionAll(both[1]).collect()}
        problems = [
            f"dim_{name}.{keys[name][1]}: {found['unique_failures']} values occur more than once"
            for name, found in self.keys.items()
            if found["unique_failures"]
        ]
        if problems:
            raise PipelineStopped("models", problems)

    def orders(self, raw_orders: DataFrame, rows: int) -> None:
        """Write the validated orders by month, with the orphans in them, and the fact in the same layout.

        ``rows`` is how many raw orders there are.
        """
        staged = staging.stg_orders(raw_orders, keep_text=True)
        joined = marts.int_orders_validated(staged, self.customers, self.products, self.limit_bytes)
        seen = Observation("validated orders")
        dates = F.count_if(F.col("order_date").isNull()).alias("null_dates")
        counted = joined.observe(seen, *quality.orphan_metrics(), dates).withColumn(MONTH, month_of(F.col("order_date")))
        self.validated = self.stored("int_orders_validated", spread(counted, MONTH), (MONTH,))

        fact = marts.fct_orders(self.validated)
        columns = [*fact.columns, month_of(F.col("order_date")).alias(MONTH)]
        missing = []
        for key, parent in (("customer_id", self.customers), ("product_id", self.products)):
            fact = lookup(fact, parent.select(key), key, [], f"_{key}_known", self.limit_bytes)
            missing.append(F.count_if(F.col(key).isNotNull() & ~F.col(f"_{key}_known")).alias(key))
        met = Observation("fact orders")
        self.fact = self.stored("fct_orders", fact.observe(met, *missing).select(*columns), (MONTH,))

        names = ("staged", "orphan_customer", "orphan_product", "orphan_both", "valid")
        # Spark leaves a count out of a plan that it finds to be without rows.
        counts = seen.get if rows else dict.fromkeys((*names, "null_dates"), 0)
        self.null_dates = counts["null_dates"]
        self.audit = tuple(counts[name] for name in names)
        self.orphans = met.get if counts["valid"] else dict.fromkeys(("customer_id", "product_id"), 0)

    def tests(self) -> None:
        """Store the results of the declared tests, and stop when one failed."""
        orders = quality.order_key_failures(self.validated).first()
        tables = {"stg_orders": "orders", "int_orders_validated": "orders", "fct_orders": "fact"}
        unique = {table: orders[f"unique_{kind}"] for table, kind in tables.items()}
        not_null = {table: orders[f"null_{kind}"] for table, kind in tables.items()}
        for name, found in self.keys.items():
            for layer in ("stg", "dim"):
                unique[f"{layer}_{name}"], not_null[f"{layer}_{name}"] = found["unique_failures"], found["null_failures"]
        rows = quality.test_rows(quality.Failures(unique, not_null, self.null_dates, self.orphans))
        self.stored("test_results", self.spark.createDataFrame(rows, _TESTS).coalesce(1))
        self.run.tests = [Row(table_name=t, test=test, column_name=c, failures=n) for t, test, c, n in rows]
        _require_passed(self.run.tests)

    def touched_months(self, old: DataFrame, raw_orders: DataFrame, before: Mapping[str, list[Part]]) -> list[date]:
        """The months that a delivery changes; there are as many as the calendar has, whatever the orders."""
        found = [staging.stg_orders(raw_orders).select(month_of(F.col("order_date")).alias(MONTH))]
        keys = {"order_id": raw_orders.select("order_id").distinct()}
        for table, key, now in (("dim_customers", "customer_id", self.customers), ("dim_products", "product_id", self.products)):
            keys[key] = _changed_keys(read_parts(self.spark, before[table]), now, key)
        for key, values in keys.items():
            few = broadcast_if_small(values.select(F.col(key).alias("_changed")), self.limit_bytes)
            found.append(old.select(key, MONTH).join(few, F.col(key) == F.col("_changed"), "left_semi").select(MONTH))
        months: set[date] = set()
        for part in found:
            months.update(row[0] for row in part.distinct().collect() if row[0] is not None)
        return sorted(months)


def _changed_keys(before: DataFrame, now: DataFrame, key: str) -> DataFrame:
    """Keys of a dimension that were added, removed, or have other attributes."""
    columns = [c for c in now.columns if c != key]

    def rows(df: DataFrame, name: str) -> DataFrame:
        return df.select(F.col(key).alias(f"{key}_{name}"), F.struct(*columns).alias(name))

    both = rows(before, "old").join(rows(now, "new"), F.col(f"{key}_old") == F.col(f"{key}_new"), "full_outer")
    return both.filter(~F.col("old").eqNullSafe(F.col("new"))).select(F.coalesce(f"{key}_old", f"{key}_new").alias(key))


def _expected(
    spark: SparkSession, feeds: Mapping[str, DataFrame], delivered: Mapping[str, int] | None
) -> dict[str, int]:
    """The rows that the sources say they hold, counted in the files where nobody says."""
    counted = feeds.delivered(spark) if isinstance(feeds, CsvFeeds) else {}
    return counted | dict(delivered or {})


def _load(
    spark: SparkSession, feeds: Mapping[str, DataFrame], run: Run, delivered: Mapping[str, int]
) -> dict[str, DataFrame]:
    """Land every feed in the raw layer and compare row counts."""
    raw = {}
    most_rejects = feeds.most_rejects if isinstance(feeds, CsvFeeds) else None
    for table, declared in RAW.items():
        path = f"{run.folder}/raw/{table}"
        if most_rejects is not None:
            try:
                landed = load_with_rejects(feeds[table], declared, path, most_rejects)
            except TooManyRejects as stop:
                raise PipelineStopped("load", [f"{table}: {stop}"]) from stop
            rows = landed.good_rows + landed.rejected_rows
            run.loads.append(Load(table, path, delivered.get(table, rows), rows))
            run.tables[f"{table}_rejects"] = f"{run.folder}/raw/{table}_rejects"
            written(landed.rejects, run.tables[f"{table}_rejects"])
            raw[table] = landed.good
            continue
        drift = checks.schema_drift(feeds[table].schema, declared)
        if drift:
            raise PipelineStopped("load", [f"{table}: {line}" for line in drift])
        feed = stamped(feeds[table])
        run.loads.append(load_table(feed, table, path, delivered.get(table)))
        run.tables[table] = path
        raw[table] = spark.read.schema(feed.schema).parquet(path)
    wrong = [
        f"{load.table}: expected {load.expected} rows, table has {load.actual}"
        for load in run.loads
        if load.status != "OK"
    ]
    if wrong:
        raise PipelineStopped("load", wrong)
    return raw


def written_models(
    validated: DataFrame, customers: DataFrame, products: DataFrame, fact: DataFrame
) -> dict[str, DataFrame]:
    """The written tables under the names of the models they hold, for the tests.

    ``stg_orders`` is tested on the validated table, which holds each staged
    order once, so that staging is not computed again.
    """
    return {
        "stg_customers": customers,
        "stg_products": products,
        "stg_orders": validated,
        "int_orders_validated": validated,
        "dim_customers": customers,
        "dim_products": products,
        "fct_orders": fact,
    }


def _require_passed(results: list[Row]) -> None:
    problems = [
        f"{r['test']} {r['table_name']}.{r['column_name']}: {r['failures']} failures" for r in results if r["failures"]
    ]
    if problems:
        raise PipelineStopped("tests", problems)
