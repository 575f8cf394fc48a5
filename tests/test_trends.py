import datetime

from frames import day, dec
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from orderloom.functions.dates import days_between, month_of
from orderloom.operators.rolling import rolling_days, rolling_rows
from orderloom.plans import trends

START = datetime.date(2024, 1, 1)
NAMES = ("sum_{}", "avg_{}")


def fact(spark, rows):
    """Rows as (days after START, revenue, region, category)."""
    table = [
        (str(i), START + datetime.timedelta(days=d), dec(v).quantize(dec("0.01")), r, c)
        for i, (d, v, r, c) in enumerate(rows)
    ]
    schema = "order_id string, order_date date, revenue decimal(21,2), region string, category string"
    return spark.createDataFrame(table, schema)


def test_daily_revenue(spark):
    orders = fact(spark, [(0, "1.10", "r", "c"), (0, "2.20", "r", "c"), (3, "5", "r", "c")])
    rows = sorted(tuple(r) for r in trends.daily_revenue(orders).collect())
    assert rows == [(day("2024-01-01"), dec("3.30"), 2), (day("2024-01-04"), dec("5.00"), 1)]


def test_short_frames_average_over_the_rows_present(spark):
    orders = fact(spark, [(i, "3", "r", "c") for i in range(3)])
    rows = trends.revenue_trends(orders).orderBy("order_date").collect()
    assert [r.revenue_rolling_7d for r in rows] == [3, 6, 9]
    assert [r.avg_daily_revenue_30d for r in rows] == [3, 3, 3]


def test_rows_and_calendar_differ_over_gaps(spark):
    orders = fact(spark, [(0, "1", "r", "c"), (10, "2", "r", "c")])
    by_row = trends.revenue_trends(orders).orderBy("order_date").collect()[-1]
    by_day = trends.revenue_trends_calendar(orders).orderBy("order_date").collect()[-1]
    assert (by_row.revenue_rolling_7d, by_day.revenue_rolling_7d) == (3, 2)
    assert by_row.revenue_rolling_30d == by_day.revenue_rolling_30d == 3


def test_columns(spark):
    expected = [
        "order_date", "daily_revenue", "daily_order_count", "revenue_rolling_7d", "revenue_rolling_30d",
        "avg_daily_revenue_7d", "avg_daily_revenue_30d",
    ]
    orders = fact(spark, [(0, "1", "r", "c")])
    assert trends.revenue_trends(orders).columns == expected
    assert trends.revenue_trends_calendar(orders).columns == expected
    assert trends.revenue_trends(orders, by=("region",)).columns == ["region", *expected]


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.dictionaries(st.tuples(st.integers(0, 20), st.sampled_from("ab")), st.integers(-500, 500), min_size=1),
)
def test_rolling_matches_brute_force(spark, values):
    table = [(s, START + datetime.timedelta(days=d), dec(v) / 100) for (d, s), v in values.items()]
    df = spark.createDataFrame(table, "s string, d date, v decimal(10,2)")
    rows = rolling_rows(df, "d", "v", {"x": 3}, NAMES, ["s"]).collect()
    days = rolling_days(df, "d", "v", {"x": 3}, NAMES, ["s"]).collect()
    for r in rows:
        seen = [v for s, d, v in sorted(table, key=lambda t: t[1]) if s == r.s and d <= r.d]
        assert r.sum_x == sum(seen[-3:])
    for r in days:
        seen = [v for s, d, v in table if s == r.s and 0 <= (r.d - d).days < 3]
        assert r.sum_x == sum(seen)
        average = (sum(seen) / len(seen)).quantize(dec("0.000001")).quantize(dec("0.01"), rounding="ROUND_HALF_UP")
        assert r.avg_x == average


def test_all_frames_share_one_window(spark):
    plan = trends.revenue_trends(fact(spark, [(0, "1", "r", "c")]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window [") == 1 and "rangepartitioning" not in plan


def test_segments_have_their_own_windows(spark):
    orders = fact(spark, [(0, "1", "r", "c"), (1, "2", "r", "c"), (1, "5", "q", "c")])
    rows = {
        (r.region, r.order_date): r.revenue_rolling_7d for r in trends.revenue_trends(orders, by=("region",)).collect()
    }
    assert rows[("r", day("2024-01-02"))] == 3 and rows[("q", day("2024-01-02"))] == 5


def test_calendar_helpers(spark):
    df = spark.createDataFrame(
        [(day("2024-02-29"), datetime.datetime(2024, 3, 1, 23, 59))], "d date, t timestamp_ntz"
    )
    row = df.select(month_of(df.d).alias("m"), days_between(df.d, df.t).alias("n")).first()
    assert (row.m, row.n) == (day("2024-02-01"), 1)
