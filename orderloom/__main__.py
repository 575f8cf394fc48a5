"""Jobs for ``spark-submit orderloom/__main__.py`` or ``python -m orderloom``; the exit code tells how they ended.

0: done and published. 1: a stage stopped the run, nothing was published. 2: wrong arguments. Any other failure raises,
which ends with 1 as well.
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence
from pathlib import Path

if __package__ in (None, ""):
    # spark-submit runs this file by its path.
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pyspark.sql import SparkSession  # noqa: E402

from orderloom.plans import pipeline  # noqa: E402
from orderloom.session import get_session  # noqa: E402
from orderloom.sources import jdbc  # noqa: E402


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="orderloom")
    jobs = parser.add_subparsers(dest="job", required=True)
    for job, text in (("run", "all stages over whole feeds"), ("deliver", "more orders; touched months only")):
        feeds = jobs.add_parser(job, help=text)
        for name in ("customers", "products", "orders"):
            feeds.add_argument(f"--{name}", required=True, help="CSV file, folder or pattern")
        feeds.add_argument("--root", required=True, help="warehouse folder that all executors share")
        feeds.add_argument("--run-id", required=True)
        feeds.add_argument("--most-rejects", type=int, help="rows of a feed that may be left out")
        feeds.add_argument("--multiline", action="store_true", help="fields may hold line breaks")
        feeds.add_argument("--no-header-check", action="store_true", help="take columns by position")
    trends = jobs.add_parser("trends", help="rolling trends from a database table to another; connection by PG* variables")
    trends.add_argument("--source", required=True)
    trends.add_argument("--target", required=True)
    trends.add_argument("--hash", required=True, help="integer SQL expression that deals the source's rows to tasks")
    trends.add_argument("--tasks", type=int, default=16)
    return parser


def main(args: Sequence[str] | None = None, spark: SparkSession | None = None) -> int:
    """Run the job that ``args`` name, in ``spark`` or a session of its own."""
    given = arguments().parse_args(args)
    own = spark is None
    spark = spark or get_session(f"orderloom-{given.job}")
    try:
        if given.job == "trends":
            split = jdbc.hash_predicates(given.hash, given.tasks)
            pipeline.trends_in_database(spark, jdbc.Connection.from_environment(), given.source, given.target, split)
            return 0
        paths = {"customers": given.customers, "products": given.products, "orders_raw": given.orders}
        feeds = pipeline.csv_feeds(spark, paths, given.multiline, not given.no_header_check, given.most_rejects)
        job = pipeline.run_pipeline if given.job == "run" else pipeline.run_delivery
        done = job(spark, feeds, given.root, given.run_id, on_stage=lambda stage: print(f"stage {stage}", file=sys.stderr))
        for load in done.loads:
            print(f"{load.table}: {load.actual} rows, {load.status}")
        print(f"published {done.run_id}")
        return 0
    except pipeline.PipelineStopped as stop:
        print(stop, file=sys.stderr)
        return 1
    finally:
        if own:
            spark.stop()


if __name__ == "__main__":
    sys.exit(main())
