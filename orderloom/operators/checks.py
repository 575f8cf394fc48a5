"""Data-quality checks. Each returns the failing rows, or a small table of counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.operators.lookup import BROADCAST_LIMIT, broadcast_if_small


def unique(df: DataFrame, column: str) -> DataFrame:
    """Non-null values that occur more than once: ``column, n``."""
    counted = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return counted.filter("n > 1")


def all_unique(keys: Sequence[tuple[DataFrame, str]]) -> bool:
    """Whether no non-null value occurs twice in any of the key columns.

    Runs one job over all of them; meant for dimension tables.
    """
    found = [unique(df, column).select("n") for df, column in keys]
    return reduce(DataFrame.unionAll, found).isEmpty()


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column, ``column_name, failures``, from one pass over the table."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column_name", "failures")


def relationships(
    child: DataFrame,
    foreign_key: str,
    parent: DataFrame,
    parent_key: str,
    limit_bytes: int = BROADCAST_LIMIT,
) -> DataFrame:
    """Child rows whose non-null key does not exist in the parent."""
    keys = broadcast_if_small(parent.select(F.col(parent_key).alias("_parent_key")), limit_bytes)
    present = child.filter(F.col(foreign_key).isNotNull())
    return present.join(keys, F.col(foreign_key) == F.col("_parent_key"), "left_anti")


def key_failures(df: DataFrame, key: str) -> DataFrame:
    """One row, ``unique_failures, null_failures``: both key checks from one grouping."""
    per_key = df.groupBy(key).agg(F.count("*").alias("n"))
    present = F.col(key).isNotNull()
    return per_key.agg(
        F.count_if(present & (F.col("n") > 1)).alias("unique_failures"),
        F.coalesce(F.sum(F.when(~present, F.col("n"))), F.lit(0).cast("long")).alias("null_failures"),
    )


def duplicates(df: DataFrame, key: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows, distinct keys and their difference, in total or per ``by`` group.

    Grouping by key first keeps one hot group from landing in one task, and a
    hot key collapses before the shuffle.
    """
    per_key = df.groupBy(*by, key).agg(F.count("*").alias("n"))
    counted = per_key.groupBy(*by).agg(
        F.coalesce(F.sum("n"), F.lit(0).cast("long")).alias("raw_rows"),
        F.count(key).alias("distinct_ids"),
    )
    return counted.withColumn("duplicates", F.col("raw_rows") - F.col("distinct_ids"))


def reconcile(pairs: Mapping[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Expected and actual row counts per table, with ``OK`` or ``MISMATCH``."""
    if not pairs:
        raise ValueError("reconcile needs at least one table")
    counted = [
        expected.agg(F.count("*").alias("expected_rows")).select(
            F.lit(name).alias("table_name"),
            "expected_rows",
            actual.agg(F.count("*")).scalar().alias("actual_rows"),
        )
        for name, (expected, actual) in pairs.items()
    ]
    same = F.col("expected_rows") == F.col("actual_rows")
    return reduce(DataFrame.unionAll, counted).withColumn("status", F.when(same, "OK").otherwise("MISMATCH"))


def schema_drift(actual: T.StructType, declared: T.StructType) -> list[str]:
    """Differences between a delivered and a declared schema, one line each.

    Column order and nullability do not count. An empty list means no drift.
    """
    have = {f.name: f.dataType for f in actual.fields}
    want = {f.name: f.dataType for f in declared.fields}
    found = [f"missing column {name}" for name in want if name not in have]
    found += [f"unexpected column {name}" for name in have if name not in want]
    found += [
        f"column {name} is {have[name].simpleString()}, declared {kind.simpleString()}"
        for name, kind in want.items()
        if name in have and have[name] != kind
    ]
    return found
