"""Positions of rows in a total order, dealt to as many tasks as there are ranges."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderloom.sources.tables import written

# Of an id that Spark gives to a row, the lower bits are its place in the partition.
_PLACE_BITS = 33


def numbered(df: DataFrame, order: list, folder: str, into: str) -> DataFrame:
    """``df`` with the position of each row in ``order``, from 0, as ``into``.

    Rows are dealt by ranges of ``order`` and sorted within them; the sizes of the ranges,
    a row for each writing task, give what stands before. The rows are written to ``folder``
    first, so that a repeated task can not number them anew. End ``order`` with a column
    that differs from row to row, or rows that tie in all of it meet in one task.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = written(ranged.withColumn("_at", F.monotonically_increasing_id()), folder)
    part = F.shiftright("_at", _PLACE_BITS)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_size"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_size").over(earlier), F.lit(0).cast("long")).alias("_start"))
    # One row per writing task, which the number of partitions bounds.
    found = placed.withColumn("_part", part).join(F.broadcast(starts), "_part")
    place = F.col("_start") + F.col("_at").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    return found.withColumn(into, place).drop("_part", "_at", "_start")
