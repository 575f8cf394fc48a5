"""Left outer joins to dimension tables that keep, and flag, the orphans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Largest dimension that is copied to every executor, in measured bytes.
BROADCAST_LIMIT = 64 * 1024 * 1024

# Per row: hash table entry, null bits and the 8-byte slot of each column.
_ROW_BYTES = 48
_SLOT_BYTES = 8


def measured_bytes(df: DataFrame) -> int:
    """Bytes the rows of ``df`` take in memory, from one aggregate over its text lengths.

    Runs a job on ``df``; meant for dimension tables cut to the columns a join needs.
    """
    size = F.lit(_ROW_BYTES + _SLOT_BYTES * len(df.columns)).cast("long")
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(F.col(field.name)), F.lit(0)) + F.lit(8)
        elif isinstance(field.dataType, T.DecimalType):
            size = size + F.lit(16)
    return df.agg(F.sum(size)).first()[0] or 0


def broadcast_if_small(df: DataFrame, limit_bytes: int = BROADCAST_LIMIT) -> DataFrame:
    """Mark ``df`` for broadcast when its measured size is within the limit.

    Larger tables are left alone: Spark then shuffles both sides, and splits the
    partitions of hot keys (and of NULL keys) at run time.
    """
    if int(limit_bytes) > 0 and measured_bytes(df) <= limit_bytes:
        return F.broadcast(df)
    return df


def lookup(
    facts: DataFrame,
    dimension: DataFrame,
    key: str,
    columns: Sequence[str],
    valid: str,
    limit_bytes: int = BROADCAST_LIMIT,
) -> DataFrame:
    """Add ``columns`` of the dimension and a never-null flag ``valid``.

    Every fact row is kept. The flag says whether its key exists in the
    dimension; a NULL key never does. A key listed twice in the dimension
    multiplies its fact rows, so check uniqueness first (``checks.unique``).
    """
    marker = f"_{key}_found"
    small = dimension.select(F.col(key).alias(marker), *columns)
    small = broadcast_if_small(small, limit_bytes)
    joined = facts.join(small, F.col(key) == F.col(marker), "left")
    return joined.withColumn(valid, F.col(marker).isNotNull()).drop(marker)
