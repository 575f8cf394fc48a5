"""The jobs that a scheduler starts, and how they end."""

import subprocess
import sys

import pytest

from orderloom.__main__ import main
from orderloom.plans import pipeline
from orderloom.sources import testdata
from tests.conftest import ROOT

TINY = "/root/testdata/sf0.001"


def test_jobs_publish_and_report(spark, tmp_path, capsys, monkeypatch):
    first, second = testdata.raw_deliveries(spark, TINY)
    dims = {"customers": testdata.raw_customers(spark, TINY), "products": testdata.raw_products(spark, TINY)}
    paths = {name: str(tmp_path / name) for name in (*dims, "first", "second")}
    for name, df in (dims | {"first": first, "second": second}).items():
        df.write.option("header", True).csv(paths[name])
    root = str(tmp_path / "warehouse")

    def job(name, orders, run_id):
        feeds = ["--customers", paths["customers"], "--products", paths["products"], "--orders", paths[orders]]
        return main([name, *feeds, "--root", root, "--run-id", run_id], spark)

    assert job("run", "first", "day-1") == 0
    assert job("deliver", "second", "day-2") == 0
    printed = capsys.readouterr()
    assert "published day-2" in printed.out and "orders_raw" in printed.out and "stage trends" in printed.err
    total = pipeline.read_current(spark, root, "int_orders_validated").count()
    assert total == testdata.raw_orders(spark, TINY).select("order_id").distinct().count()

    testdata.raw_orders_bad(spark, TINY).write.option("header", True).csv(str(tmp_path / "bad"))
    paths["bad"] = str(tmp_path / "bad")
    assert job("run", "bad", "day-3") == 1
    assert "not_null" in capsys.readouterr().err
    assert pipeline.read_current(spark, root, "int_orders_validated").count() == total

    calls = []
    monkeypatch.setattr(pipeline, "trends_in_database", lambda *how: calls.append(how[2:]))
    assert main(["trends", "--source", "a", "--target", "b", "--hash", "h(id)", "--tasks", "2"], spark) == 0
    assert calls[0][:2] == ("a", "b") and len(calls[0][2]) == 2
    with pytest.raises(SystemExit) as wrong:
        main(["run"], spark)
    assert wrong.value.code == 2


@pytest.mark.parametrize("how", [["-m", "orderloom"], [str(ROOT / "orderloom" / "__main__.py")]])
def test_jobs_can_be_started_by_module_and_by_path(how):
    done = subprocess.run([sys.executable, *how, "run"], cwd=ROOT, capture_output=True, text=True, timeout=60, check=False)
    assert done.returncode == 2 and "--customers" in done.stderr
