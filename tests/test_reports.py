import pytest
from frames import day, dec
from pyspark.sql import functions as F

from orderloom.plans import marts, reports

ROWS = [
    # region, category, revenue, margin
    ("east", "toys", "100.00", "10.00"),
    ("east", "toys", "50.00", "5.00"),
    ("east", "books", "150.00", "-30.00"),
    ("west", "books", "80.00", "40.00"),
    ("west", "games", "10.00", "9.00"),
]


@pytest.fixture(scope="module")
def orders(spark):
    table = [(str(i), r, c, dec(v), dec(m)) for i, (r, c, v, m) in enumerate(ROWS)]
    return spark.createDataFrame(
        table, "order_id string, region string, category string, revenue decimal(21,2), gross_margin decimal(22,2)"
    )


@pytest.fixture(scope="module")
def segments(orders):
    return reports.segments_of_orders(orders)


def test_scorecard(segments):
    assert tuple(reports.kpi_scorecard(segments).first()) == (dec("390.00"), 5, dec("34.00"), dec("8.72"), dec("78.00"))


def test_scorecard_of_nothing(segments):
    row = reports.kpi_scorecard(segments.limit(0)).first()
    assert (row.order_count, row.margin_pct, row.avg_order_value) == (0, None, None)


def test_margin_vs_revenue(segments):
    rows = {r.category: r for r in reports.margin_vs_revenue(segments).collect()}
    assert rows["books"].margin_pct == dec("4.35") and rows["games"].margin_pct == dec("90.00")
    assert {r.overall_margin_pct for r in rows.values()} == {dec("8.72")}
    assert {r.mean_category_margin_pct for r in rows.values()} == {dec("34.78")}
    assert rows["toys"].distance == dec("1.28")


def test_heatmap_with_and_without_named_columns(segments):
    named = reports.region_category_heatmap(segments, ["books", "toys"])
    assert named.columns == ["region", "books", "toys", "others"]
    assert {r.region: r.others for r in named.collect()} == {"east": None, "west": dec("10.00")}
    found = reports.region_category_heatmap(segments)
    assert found.columns == ["region", "books", "games", "toys"]
    assert {r.region: (r.books, r.games, r.toys) for r in found.collect()} == {
        "east": (dec("150.00"), None, dec("150.00")),
        "west": (dec("80.00"), dec("10.00"), None),
    }


def test_breakdowns(segments):
    rows = {(r.grouping_level, r.region, r.category): r for r in reports.kpi_breakdowns(segments).collect()}
    assert rows[("total", None, None)].total_revenue == dec("390.00")
    assert rows[("region", "east", None)].order_count == 3
    assert rows[("category", None, "games")].total_revenue == dec("10.00")
    assert len(rows) == 6


def test_breakdowns_keep_unnamed_segments_apart_from_totals(segments):
    unnamed = segments.withColumn("region", F.when(F.col("region") == "east", F.col("region")))
    rows = reports.kpi_breakdowns(unnamed).filter("region is null and category is null").collect()
    assert {r.grouping_level: r.total_revenue for r in rows} == {"region": dec("90.00"), "total": dec("390.00")}


def test_conditional_totals(segments):
    found = reports.conditional_totals(segments, ["east", "west"]).collect()
    rows = {r.category: (r.east, r.west, r.total_revenue) for r in found}
    assert rows["books"] == (dec("150.00"), dec("80.00"), dec("230.00"))
    assert rows["toys"] == (dec("150.00"), None, dec("150.00"))


def test_top_and_bottom(segments):
    found = reports.top_bottom_performers(segments).collect()
    rows = {(r.dimension, r.measure): (r.top_name, r.bottom_name) for r in found}
    assert rows[("region", "total_revenue")] == ("east", "west")
    assert rows[("region", "gross_margin")] == ("west", "east")
    assert rows[("category", "margin_pct")] == ("games", "books")
    # Books and toys tie on orders for the top: the name that sorts first wins.
    assert rows[("category", "order_count")] == ("books", "games")
    assert len(rows) == 8


def test_top_categories(segments):
    rows = {(r.region, r.rank): r.category for r in reports.top_categories_by_region(segments).collect()}
    # A tie in the east, decided by name.
    assert rows == {("east", 1): "books", ("east", 2): "toys", ("west", 1): "books", ("west", 2): "games"}
    assert [r.category for r in reports.consistent_top_categories(segments, 2).collect()] == ["books"]
    assert reports.consistent_top_categories(segments.filter("category <> 'books'"), 2).count() == 0


def test_orders_without_a_region_are_a_region_of_their_own(spark):
    cells = [("R1", "A", 9), ("R1", "B", 5), ("R2", "A", 9), ("R2", "B", 5), (None, "A", 9), (None, "C", 5)]
    segments = spark.createDataFrame(cells, "region string, category string, total_revenue long")
    assert [r.category for r in reports.consistent_top_categories(segments, 1).collect()] == ["A"]
    assert [r.category for r in reports.consistent_top_categories(segments, 2).collect()] == ["A"]


def test_reports_reduce_before_they_expand(segments):
    """Grouping sets must multiply segments, not orders: Expand lies above an aggregate."""
    plan = reports.kpi_breakdowns(segments)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Expand") < plan.rindex("Exchange hashpartitioning(region")


REPORTS = [
    reports.kpi_scorecard,
    reports.margin_vs_revenue,
    reports.region_category_heatmap,
    reports.kpi_breakdowns,
    lambda s: reports.conditional_totals(s, ["east", "west"]),
    reports.top_bottom_performers,
    reports.top_categories_by_region,
    reports.consistent_top_categories,
]


@pytest.mark.parametrize("report", REPORTS)
def test_reports_on_the_monthly_mart_equal_those_on_orders(orders, report):
    dated = orders.withColumns(
        {
            "order_date": F.lit(day("2024-01-05")) + F.col("order_id").cast("int") * 20,
            "quantity": F.lit(1),
        }
    )
    monthly = marts.mart_monthly_kpis(dated)
    assert monthly.select("order_month").distinct().count() > 1
    from_mart = sorted(map(repr, report(reports.segments_of_months(monthly)).collect()))
    assert from_mart == sorted(map(repr, report(reports.segments_of_orders(orders)).collect()))
