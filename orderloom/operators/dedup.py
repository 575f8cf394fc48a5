"""Keep one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedup_earliest(
    df: DataFrame, keys: Sequence[str], arrival: str, ties: Sequence[str] | None = None
) -> DataFrame:
    """The earliest row per key by ``arrival``; a missing arrival time loses.

    Equal arrival times are decided by the ``ties`` columns and then by all
    others, so the result does not depend on the order rows are read in.

    Ranking rows and keeping the first is the same as taking the smallest row,
    written as one aggregate so that it combines before the shuffle: each map
    task sends at most one row per key, and a key that holds a third of all rows
    costs one row per map task. Grouping by the key's hash first lets the sorts
    compare whole numbers; ids such as ``ORD-000001`` share long prefixes.
    """
    first = [arrival, *(ties or [])]
    order = first + [c for c in df.columns if c not in keys and c not in first]
    smallest = F.min(F.struct(F.col(arrival).isNull().alias("_missing"), *order))
    kept = df.withColumn("_hash", F.xxhash64(*keys)).groupBy("_hash", *keys).agg(smallest.alias("_row"))
    return kept.select(*[F.col(c) if c in keys else F.col("_row").getField(c).alias(c) for c in df.columns])
