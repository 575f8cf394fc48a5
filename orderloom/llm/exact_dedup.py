"""Exact dedup by skew-safe combining, with built-in functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm.common import text_of
from orderloom.session import shared_dir
from orderloom.sources.tables import written

# The characters that do not count, space and tab to carriage return.
BLANKS = " \t\n\x0b\x0c\r"


def without_blanks(text: Column) -> Column:
    return F.translate(text, BLANKS, "")


def sha256(content: Column) -> Column:
    return F.sha2(content, 256)


def exact_groups(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    salts: int = 16,
    digest: Callable[[Column], Column] = sha256,
) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when they are the same without blanks. Of equal texts the
    one with the most characters stays, then the one with the smallest key.
    NULL texts are empty, and all empty texts are equal. A NULL key comes after
    all others. Repeated rows count each; as they share a key, all copies of a
    kept row are ``kept``. An empty table gives no rows.

    Copies are combined where they are read, then by digest and salt, so that a
    text which holds a third of all rows meets as one row per task in ``salts``
    tasks, then over the salts. Content is part of the grouping each time. Two
    contents under one digest, should it ever happen, get different variants;
    only their contents are sent to all tasks, and no two texts are known to
    share a SHA-256. (``digest`` is for tests.)
    """
    content = without_blanks(text_of(text))
    read = docs.select(
        F.col(f"`{key}`").cast("long").alias("id"), F.char_length(text_of(text)).alias("size"), content.alias("content")
    ).withColumn("digest", digest(F.col("content")))
    # Among equal sizes the smallest key has the greatest complement.
    best = F.struct("size", F.bitwise_not("id").alias("unlike"))
    local = read.groupBy("digest", "content", (F.spark_partition_id() % salts).alias("salt"))
    salted = local.agg(F.count("*").alias("n"), F.max(best).alias("best"))
    # Dealt by digest alone: the variants of one digest then meet without another shuffle.
    combined = (
        salted.repartition("digest")
        .groupBy("digest", "content")
        .agg(F.sum("n").alias("group_size"), F.max("best").alias("best"))
    )
    alike = Window.partitionBy("digest")
    groups = combined.select(
        "digest",
        F.row_number().over(alike.orderBy("content")).alias("variant"),
        F.when(F.count("*").over(alike) > 1, F.col("content")).alias("content"),
        "group_size",
        F.bitwise_not("best.unlike").alias("keep_id"),
    )
    # Written without the texts, so that the second pass over the documents need not group them again.
    groups = written(groups, shared_dir(docs.sparkSession, "exact-groups"))
    variants = groups.filter("content IS NOT NULL").select("digest", "content", "variant")
    found = (
        read.join(F.broadcast(variants), ["digest", "content"], "left")
        .select("id", "digest", F.coalesce("variant", F.lit(1)).alias("variant"), sha256(F.col("content")).alias("sha"))
        .join(groups.drop("content"), ["digest", "variant"])
    )
    return found.select(
        F.col("id").alias("doc_id"),
        "keep_id",
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


ORACLE_SQL = r"""
WITH read AS (
    SELECT doc_id, length(coalesce(text, '')) AS size,
           regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS content
    FROM documents
), grouped AS (
    SELECT doc_id, content, count(*) OVER (PARTITION BY content) AS group_size,
           first_value(doc_id) OVER (PARTITION BY content ORDER BY size DESC, doc_id) AS keep_id
    FROM read
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(content) AS text_sha256
FROM grouped
"""
