"""Distinct counts that add up: exact bitmaps of numbered keys, merged for any roll-up."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.sources.tables import written

# Numbers that one bitmap of Spark's bitmap functions holds.
_NUMBERS_BITS = 15

BITS, BUCKET = "bits", "bucket"


def distinct_bitmaps(df: DataFrame, key: str, by: Sequence[str], folder: str) -> DataFrame:
    """``by, bucket, bits``: which values of ``key`` each group has, as bitmaps, written to ``folder``.

    Every distinct value gets a number of its own, in one shuffle; a hot value combines before it and
    brings along the groups it is in, of which there are no more than groups. Numbers run on within a task, so bitmaps are
    full. They are written before they are used: a repeated task could number otherwise. NULL keys are not counted.
    """
    groups = F.collect_set(F.struct(*by)).alias("_groups")
    values = df.filter(F.col(key).isNotNull()).groupBy(key).agg(groups)
    numbered = written(values.select(F.monotonically_increasing_id().alias("_number"), "_groups"), f"{folder}/numbers")
    places = numbered.select("_number", F.explode("_groups").alias("_group")).select("_number", "_group.*")
    bucket = F.shiftright("_number", _NUMBERS_BITS).alias(BUCKET)
    bit = F.col("_number").bitwiseAND(F.lit((1 << _NUMBERS_BITS) - 1))
    bitmaps = places.groupBy(*by, bucket).agg(F.bitmap_construct_agg(bit).alias(BITS))
    return written(bitmaps, f"{folder}/bitmaps")


def rolled_up(bitmaps: DataFrame, by: Sequence[str], into: str) -> DataFrame:
    """``by, into``: the exact number of distinct values of each group of groups, from the bitmaps alone.

    Bitmaps merge before they are shuffled, so a value that several groups share counts once.
    """
    merged = bitmaps.groupBy(*by, BUCKET).agg(F.bitmap_or_agg(BITS).alias(BITS))
    counts = merged.groupBy(*by).agg(F.sum(F.bitmap_count(BITS)).alias(into))
    return counts.select(*by, F.coalesce(into, F.lit(0).cast("long")).alias(into))
