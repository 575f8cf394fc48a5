"""Tables stored by key, so that joins on that key need no shuffle, however large both sides are."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.operators.lookup import BROADCAST_LIMIT, broadcast_if_small
from orderloom.sources.tables import written


@dataclass(frozen=True)
class Bucketed:
    """A table in two parts: ``rows`` bucketed by ``key``, and ``hot``, those of NULL and of very frequent keys.

    A bucket cannot be split when it is read, so a key that would outgrow one is kept out of all. ``hot_keys`` holds
    those values in the column ``key``: fewer than there are buckets.
    """

    key: str
    buckets: int
    rows: DataFrame
    hot: DataFrame
    hot_keys: DataFrame


def bucketed(df: DataFrame, key: str, buckets: int, folder: str) -> Bucketed:
    """Write ``df`` by ``key`` into a new folder that all executors share.

    Worth its one shuffle for a table that is joined on ``key`` more than once. Keys with more than a bucket's fair
    share of the rows, found by a combining count, go to the unbucketed part; there are fewer of them than
    buckets, whatever the data. Tables joined to each other need the same number of buckets; pick one that leaves some
    256 MB to a bucket. An empty ``df`` gives two empty parts.
    """
    name = f"bucketed_{uuid.uuid4().hex}"
    source = written(df, f"{folder}/{name}/source")
    fair = max(source.count() // buckets, 1)
    counts = source.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_rows"))
    hot_keys = written(counts.filter((F.col("_rows") > fair) & (F.col("_rows") > 1)).select(key), f"{folder}/{name}/keys")
    few = F.broadcast(hot_keys.withColumnRenamed(key, "_hot"))
    marked = source.join(few, F.col(key) == F.col("_hot"), "left")
    apart = F.col(key).isNull() | F.col("_hot").isNotNull()
    cold = marked.filter(~apart).drop("_hot").repartition(buckets, key)
    # A file for each bucket: the writing tasks are dealt by the very hash that the buckets use.
    writer = cold.write.bucketBy(buckets, key).sortBy(key).option("path", f"{folder}/{name}/rows")
    writer.format("parquet").saveAsTable(name)
    hot = written(marked.filter(apart).drop("_hot"), f"{folder}/{name}/hot")
    return Bucketed(key, buckets, df.sparkSession.table(name), hot, hot_keys)


def bucketed_lookup(
    facts: Bucketed,
    dimension: Bucketed,
    columns: Sequence[str],
    valid: str,
    limit_bytes: int = BROADCAST_LIMIT,
) -> DataFrame:
    """What ``lookup`` returns, without a shuffle of the facts or of the dimension.

    Buckets meet bucket by bucket. The facts' hot keys meet only the dimension's rows of these keys: a table of fewer
    rows than buckets when the dimension's keys are unique, broadcast when it is small by measure.
    """
    key = _aligned(facts, dimension)
    marker = f"_{key}_found"
    names = [F.col(key).alias(marker), *columns]
    cold = facts.rows.join(dimension.rows.select(*names), F.col(key) == F.col(marker), "left")
    own = F.broadcast(facts.hot_keys.withColumnRenamed(key, "_hot"))
    few = dimension.rows.join(own, F.col(key) == F.col("_hot"), "left_semi").select(*names)
    hot = facts.hot.join(broadcast_if_small(few, limit_bytes), F.col(key) == F.col(marker), "left")
    return cold.unionByName(hot).withColumn(valid, F.col(marker).isNotNull()).drop(marker)


def bucketed_orphans(facts: Bucketed, dimension: Bucketed) -> DataFrame:
    """Rows whose key, if any, is not in the dimension; NULL keys are no orphans. No shuffle of either table."""
    key = _aligned(facts, dimension)
    known = dimension.rows.select(F.col(key).alias("_known"))
    cold = facts.rows.join(known, F.col(key) == F.col("_known"), "left_anti")
    own = facts.hot_keys.withColumnRenamed(key, "_hot")
    found = known.join(F.broadcast(own), F.col("_known") == F.col("_hot"), "left_semi")
    # Hot keys that the dimension lacks, and those it has, are fewer than there are buckets.
    lost = own.join(F.broadcast(found), F.col("_hot") == F.col("_known"), "left_anti")
    return cold.unionByName(facts.hot.join(F.broadcast(lost), F.col(key) == F.col("_hot"), "left_semi"))


def _aligned(facts: Bucketed, dimension: Bucketed) -> str:
    """The key that both are bucketed by, alike. The dimension's rows of NULL keys match nothing and may lie apart."""
    key = facts.key
    if (dimension.key, dimension.buckets) != (key, facts.buckets):
        raise ValueError(f"not in the same buckets: {facts.buckets} by {key}, {dimension.buckets} by {dimension.key}")
    if dimension.hot_keys.head(1):
        raise ValueError(f"{key} repeats in the dimension; check its uniqueness first")
    return key
