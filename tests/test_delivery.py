"""Later deliveries against full rebuilds, and the log of published runs."""

import datetime
import pathlib
import random
from datetime import timedelta

import pytest
from frames import CUSTOMER, PRODUCT, order, raw_customers, raw_orders, raw_products

from orderloom import session
from orderloom.plans import pipeline
from orderloom.sources import tables
from orderloom.sources.tables import Part

PRODUCTS = [PRODUCT, ("p2", "Desk", "Home", "40.00", "90.00")]
CUSTOMERS = [CUSTOMER, ("c2", "Bob", "Ray", "b@x.com", "East", "2024-02-03")]


def feeds_of(spark, orders, customers=CUSTOMERS, products=PRODUCTS):
    return {
        "customers": raw_customers(spark, *customers),
        "products": raw_products(spark, *products),
        "orders_raw": raw_orders(spark, *orders),
    }


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def same_tables(spark, left, right, but=("test_results",)):
    for table in pipeline.PUBLISHED:
        if table not in but:
            assert rows(pipeline.read_current(spark, left, table)) == rows(pipeline.read_current(spark, right, table)), table


def months_read(spark, root):
    """The folder of every live month of the fact."""
    return {
        name: part.path for part in tables.published_parts(spark, root, "fct_orders") for name in part.partitions
    }


def month_orders(n, months, load="10:00:00", **kind):
    return [order(f"{m}-{i}", f"2024-{m:02d}-05", f"2024-{m:02d}-05 {load}", **kind) for m in months for i in range(n)]


def test_untouched_months_keep_their_files(spark, tmp_path):
    root = str(tmp_path / "w")
    first = month_orders(3, range(1, 7))
    second = [order("2-9", "2024-02-09", "2024-06-01 00:00:00"), order("7-0", "2024-07-01", "2024-07-01 00:00:00")]
    # Repeats an order of April that arrived earlier than the copy landed before, with another quantity and month.
    second.append(order("4-1", "2024-05-20", "2024-04-05 09:00:00", quantity=5))
    pipeline.run_pipeline(spark, feeds_of(spark, first), root, "r1")
    before = months_read(spark, root)
    files = {p: p.stat().st_mtime_ns for p in pathlib.Path(root).rglob("*.parquet")}
    stages = []
    pipeline.run_delivery(spark, feeds_of(spark, second), root, "r2", on_stage=stages.append)
    assert tuple(stages) == pipeline.STAGES
    after = months_read(spark, root)
    changed = {name for name in after if after[name] != before.get(name)}
    assert changed == {f"order_month=2024-{m:02d}-01" for m in (2, 4, 5, 7)}
    assert all(p.stat().st_mtime_ns == when for p, when in files.items())
    whole = str(tmp_path / "whole")
    pipeline.run_pipeline(spark, feeds_of(spark, first + second), whole, "r")
    same_tables(spark, root, whole)


def test_changed_dimensions_touch_the_months_of_their_orders(spark, tmp_path):
    root, whole = str(tmp_path / "w"), str(tmp_path / "whole")
    first = month_orders(1, [1]) + month_orders(1, [2], customer="c2") + month_orders(1, [3], product="p2")
    first += month_orders(1, [4], customer="new") + month_orders(1, [5])
    pipeline.run_pipeline(spark, feeds_of(spark, first), root, "r1")
    before = months_read(spark, root)
    customers = [CUSTOMER, ("new", "N", "N", "n@x.com", "North", "2024-02-03"), (*CUSTOMERS[1][:4], "West", "2024-02-03")]
    products = [PRODUCT]
    second = month_orders(1, [6])
    pipeline.run_delivery(spark, feeds_of(spark, second, customers, products), root, "r2")
    after = months_read(spark, root)
    changed = {name for name in after if after[name] != before.get(name)}
    # March has no valid order left, April has its first one.
    assert changed == {f"order_month=2024-{m:02d}-01" for m in (2, 4, 6)} and "order_month=2024-03-01" not in after
    pipeline.run_pipeline(spark, feeds_of(spark, first + second, customers, products), whole, "r")
    same_tables(spark, root, whole)


@pytest.mark.parametrize("seed", range(2))
def test_random_deliveries_equal_a_rebuild(spark, tmp_path, seed):
    rng = random.Random(seed)

    def some(n):
        found = []
        for _ in range(n):
            month, day = rng.randint(1, 5), rng.randint(1, 28)
            legacy = rng.random() < 0.5
            date = f"{month}/{day}/2024" if legacy else f"2024-{month:02d}-{day:02d}"
            load = f"2024-06-{rng.randint(1, 3):02d} 00:00:0{rng.randint(0, 2)}"
            keys = rng.choice(["c1", "c2", "x"]), rng.choice(["p1", "p2", "y"])
            source = "legacy_pos" if legacy else "web_platform"
            found.append(order(str(rng.randint(0, 25)), date, load, source, *keys, rng.randint(1, 3)))
        return found

    root, whole, seen = str(tmp_path / "w"), str(tmp_path / "whole"), some(30)
    pipeline.run_pipeline(spark, feeds_of(spark, seen), root, "r0")
    for k in (1, 2):
        more = some(6)
        seen = seen + more
        pipeline.run_delivery(spark, feeds_of(spark, more), root, f"r{k}")
    pipeline.run_pipeline(spark, feeds_of(spark, seen), whole, "r")
    same_tables(spark, root, whole)


def test_an_empty_or_a_bad_delivery_changes_nothing(spark, tmp_path):
    root = str(tmp_path / "w")
    pipeline.run_pipeline(spark, feeds_of(spark, month_orders(2, [1, 2])), root, "r1")
    before = rows(pipeline.read_current(spark, root, "mart_monthly_kpis"))
    pipeline.run_delivery(spark, feeds_of(spark, []), root, "r2")
    assert rows(pipeline.read_current(spark, root, "mart_monthly_kpis")) == before
    with pytest.raises(pipeline.PipelineStopped, match="order_date"):
        pipeline.run_delivery(spark, feeds_of(spark, [order("9", "13/45/2024")]), root, "r3")
    assert rows(pipeline.read_current(spark, root, "mart_monthly_kpis")) == before
    assert tables.published_runs(spark, root).count() == 2


def test_earlier_runs_stay_readable_until_they_are_dropped(spark, tmp_path):
    root = str(tmp_path / "w")
    pipeline.run_pipeline(spark, feeds_of(spark, month_orders(2, [1, 2])), root, "r1")
    pipeline.run_delivery(spark, feeds_of(spark, month_orders(2, [2, 3], load="09:00:00")), root, "r2")
    with pytest.raises(pipeline.PipelineStopped):
        pipeline.run_delivery(spark, feeds_of(spark, [order("9", "no date")]), root, "failed")
    counts = {r: pipeline.read_current(spark, root, "fct_orders", r).count() for r in ("r1", "r2")}
    assert counts == {"r1": 4, "r2": 6}
    now = timedelta(0)
    # Everything of both runs is in use; the failed attempt is not, unless it is too young.
    assert tables.unreferenced(spark, root, timedelta(days=1)) == []
    assert [p.split("/")[-2] for p in tables.remove_unreferenced(spark, root, now)] == ["failed"]
    assert {r: pipeline.read_current(spark, root, "fct_orders", r).count() for r in counts} == counts
    assert tables.compact_log(spark, root, keep_versions=1) == 1
    with pytest.raises(LookupError, match="r1"):
        pipeline.read_current(spark, root, "fct_orders", "r1")
    live = {p: pathlib.Path(path, p) for p, path in months_read(spark, root).items()}
    gone = tables.remove_unreferenced(spark, root, now)
    # February of the first run was replaced; its January is still part of the table.
    assert sorted(p.split("/")[-1] for p in gone) == ["order_month=2024-02-01"] * 2
    assert all(path.exists() for path in live.values())
    assert pipeline.read_current(spark, root, "fct_orders").count() == 6
    assert len(list(pathlib.Path(root, "_published").glob("part-*"))) == 1


def test_a_log_compacted_half_way_reads_the_same(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    for k in range(3):
        spark.range(k).write.parquet(f"{root}/r{k}/a/t")
        tables.publish(spark, root, f"r{k}", {"t": f"{root}/r{k}/a/t"})
    monkeypatch.setattr(tables.folders, "remove", lambda spark, paths: None)
    tables.compact_log(spark, root, 2)
    assert [tables.read_published(spark, root, "t", r).count() for r in (None, "r0", "r2")] == [2, 0, 2]
    assert tables.publish(spark, root, "r3", {"t": [Part(f"{root}/r1/a/t")]}) == 4
    assert tables.read_published(spark, root, "t").count() == 1
    with pytest.raises(ValueError):
        tables.compact_log(spark, root, 0)


def test_old_shared_folders_go(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "_shared_root", lambda spark: str(tmp_path))
    mine = session.shared_dir(spark, "feed")
    spark.range(1).write.parquet(mine)
    (tmp_path / "something-else").mkdir()
    assert session.remove_shared_dirs(spark, timedelta(days=1)) == []
    assert session.remove_shared_dirs(spark, timedelta(0)) == [mine]
    assert [p.name for p in tmp_path.iterdir()] == ["something-else"]


def test_the_pipeline_shuffles_its_orders_three_times(spark, tmp_path, monkeypatch):
    """Retries, months and order ids; all other tests and the audit are counted on the way."""
    rows_of = {"orders": 400}
    orders = [order(str(i), f"2024-{1 + i % 3:02d}-05", f"2024-{1 + i % 3:02d}-05 10:00:00") for i in range(rows_of["orders"])]
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    store = spark._jsparkSession.sharedState().statusStore()

    def executions():
        found = store.executionsList()
        return [found.apply(k).executionId() for k in range(found.size())]

    # Old ones drop out of the list, so they are told by their numbers.
    done = max(executions(), default=-1)
    pipeline.run_pipeline(spark, feeds_of(spark, orders), str(tmp_path), "r1")
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    large = 0
    for number in filter(lambda n: n > done, executions()):
        metrics, graph = store.executionMetrics(number), store.planGraph(number)
        nodes = graph.allNodes()
        for i in range(nodes.size()):
            node = nodes.apply(i)
            if node.name() == "Exchange":
                for j in range(node.metrics().size()):
                    metric = node.metrics().apply(j)
                    if metric.name() == "shuffle records written":
                        value = metrics.get(metric.accumulatorId())
                        large += value.isDefined() and int(value.get().replace(",", "")) >= rows_of["orders"]
    assert large == 3
    assert datetime.date(2024, 1, 1) in {
        r[0] for r in pipeline.read_current(spark, str(tmp_path), "fct_orders").select("order_month").distinct().collect()
    }
