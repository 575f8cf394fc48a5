"""Windows without a partition, dealt to many tasks."""

import pytest
from pyspark.sql import functions as F

from orderloom.operators.rolling import rolling_rows, rolling_rows_in_pieces
from orderloom.session import shared_dir

FRAMES, NAMES = {"3": 3, "30": 30}, ("sum_{}", "avg_{}")


def frame(spark, rows):
    value = (F.xxhash64("id") % 1000).cast("decimal(18,2)").alias("value")
    # Neither the files nor the ids are in the order of the days.
    return spark.range(rows).select(((F.col("id") * 7919) % rows).alias("day"), value).repartition(8)


@pytest.mark.parametrize("rows, piece", [(1000, 29), (1000, 100), (20, 64), (0, 64)])
def test_pieces_equal_one_window(spark, rows, piece):
    df = frame(spark, rows)
    got = rolling_rows_in_pieces(df, ["day"], "value", FRAMES, NAMES, shared_dir(spark, "pieces"), piece)
    want = rolling_rows(df, "day", "value", FRAMES, NAMES)
    assert got.columns == want.columns and sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_no_task_gets_all_rows(spark):
    got = rolling_rows_in_pieces(frame(spark, 1000), ["day"], "value", FRAMES, NAMES, shared_dir(spark, "pieces"), 100)
    plan = got._jdf.queryExecution().executedPlan().toString()
    window = plan[plan.index("Window [") :]
    # What meets in one task is a row for each writing task, sent to all others.
    assert "SinglePartition" not in window[: window.index("BroadcastExchange")]
    assert "hashpartitioning(_into" in window


def test_pieces_hold_a_frame(spark):
    with pytest.raises(ValueError, match="shorter than a frame"):
        rolling_rows_in_pieces(frame(spark, 10), ["day"], "value", FRAMES, NAMES, shared_dir(spark, "pieces"), 28)
