"""Connected components of a large graph by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.session import shared_dir
from orderloom.sources.tables import written


def components(edges: DataFrame, purpose: str = "components") -> DataFrame:
    """``node, root`` for every node of ``edges`` (``a, b``): the smallest node of its component.

    Each round joins the larger neighbours of every node to its smallest one,
    then its smaller ones, until the edges are stars around the roots; the
    number of rounds grows with the logarithm of the largest component. Every
    round is written to the shared folder, so a lost executor repeats one round.
    """
    spark = edges.sparkSession
    folder = shared_dir(spark, purpose)
    now = written(_clean(edges.select("a", "b")), f"{folder}/0")
    mark = _fingerprint(now)
    for step in range(1, 100):
        now = written(_star(_star(now, larger=True), larger=False), f"{folder}/{step}")
        before, mark = mark, _fingerprint(now)
        if mark == before:
            break
    else:
        raise RuntimeError("components did not settle")
    roots = now.groupBy("b").agg(F.min("a").alias("root")).select(F.col("b").alias("node"), "root")
    return roots.unionAll(now.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())


def _clean(edges: DataFrame) -> DataFrame:
    """Every edge once, the smaller node first."""
    ordered = edges.filter("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return ordered.distinct()


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """Large star: a node's larger neighbours move to its smallest neighbour or itself. Small star: its others do."""
    if larger:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hubs = both.groupBy("a").agg(F.min("b").alias("least")).withColumn("least", F.least("a", "least"))
        moved = both.filter("b > a").join(hubs, "a").select(F.col("least").alias("a"), "b")
        return moved.filter("a != b").distinct()
    hubs = edges.groupBy("b").agg(F.min("a").alias("least"))
    moved = edges.join(hubs, "b")
    own = moved.select(F.col("least").alias("x"), F.col("b").alias("y"))
    others = moved.filter("a != least").select(F.col("least").alias("x"), F.col("a").alias("y"))
    return _clean(own.unionAll(others).select(F.col("x").alias("a"), F.col("y").alias("b")))


def _fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
    return tuple(row)
