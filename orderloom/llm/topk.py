"""Exact top-k inner products by MaxScore over sharded postings."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm.common import offsets_of
from orderloom.sources.tables import written

# Components of the vectors of one shard, and of one block of queries.
SHARD_VALUES, BLOCK_VALUES = 1 << 18, 1 << 13

# Products of two components, summed, must fit 64 bits.
_LARGEST = 1 << 62

# Searching a list for a row costs as much as so many of its entries; terms between two looks at the rows in play.
_SEARCH_COST, _DROP_EVERY = 16, 4

_SHARD = "shard int, ids array<long>, width int, terms array<int>, ends array<long>, places array<int>, weights array<long>"
_BLOCK = "block int, home int, queries array<long>, columns int, components array<long>"
_FOUND = "query_id long, vec_id long, score long"


def quantised(vectors: DataFrame, scale: int = 1024, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``id, values``: every component as ``floor(scale * x)``.

    Vectors that are NULL, or hold a NULL, a NaN or an infinite component, and rows
    without an id take no part. Components that do not fit 64 bits fail.
    """
    wide = F.transform(F.col(f"`{vector}`"), lambda x: x.cast("double"))
    plain = vectors.select(F.col(f"`{key}`").cast("long").alias("id"), wide.alias("wide"))
    # NaN is larger than all others.
    fit = F.forall("wide", lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))))
    whole = F.transform("wide", lambda x: F.floor(x * F.lit(float(scale))))
    return plain.filter(F.col("id").isNotNull() & fit).select("id", whole.alias("values"))


@dataclass
class Shard:
    """Postings of some vectors: a term is a dimension and a sign, its list has places and weights.

    Term ``2 * d`` lists the vectors with a positive component ``d``, term ``2 * d + 1`` those with a negative one.
    """

    ids: np.ndarray
    width: int
    terms: np.ndarray
    ends: np.ndarray
    places: np.ndarray
    weights: np.ndarray

    @classmethod
    def of(cls, ids: np.ndarray, values: np.ndarray) -> Shard:
        lists = []
        terms = []
        for d in range(values.shape[1]):
            for sign in (1, -1):
                places = np.flatnonzero(values[:, d] * sign > 0)
                if len(places):
                    terms.append(2 * d + (sign < 0))
                    lists.append(places)
        ends = offsets_of([len(x) for x in lists])
        places = np.concatenate([np.zeros(0, np.int64), *lists]).astype(np.int32)
        weights = np.concatenate([np.zeros(0, np.int64), *[values[p, t // 2] for t, p in zip(terms, lists, strict=True)]])
        return cls(ids, values.shape[1], np.array(terms, np.int32), ends, places, weights.astype(np.int64))

    def prepared(self) -> Shard:
        """Each term's weight of the largest size, the bound of what it can add to a score, and its places by row."""
        self.places = self.places.astype(np.intp)
        self.slots = {int(t): k for k, t in enumerate(self.terms)}
        self.lists = [slice(a, b) for a, b in zip(self.ends[:-1], self.ends[1:], strict=True)]
        self.largest = np.array([np.abs(self.weights[s]).max() for s in self.lists], np.int64)
        return self

    def add(self, scores: np.ndarray, rows: np.ndarray, term: int, weight: int) -> None:
        """Add what a term gives the ``scores`` of some rows: by its list where that is short, else by searching it."""
        part = self.lists[term]
        places = self.places[part]
        if len(places) < _SEARCH_COST * len(rows):
            scores[places] += self.weights[part] * weight
        else:
            at = np.minimum(np.searchsorted(places, rows), len(places) - 1)
            scores[rows] += np.where(places[at] == rows, self.weights[part][at], 0) * weight


def best(shard: Shard, query_id: int, query: np.ndarray, k: int, least: int | None) -> tuple[np.ndarray, np.ndarray]:
    """``ids, scores`` of the ``k`` best rows of a shard that score ``least`` or more, the query's own id left out.

    MaxScore. A term raises a score by its bound at most, if its sign is the query's, and else by nothing. The first
    kind is taken by falling bound, and is essential until all that follow could not lift a row to the threshold.
    Rows in no essential list are never looked at. All other terms are probed, those that change scores
    most first, and rows are dropped when what they have and all that may still be added is less than the threshold.
    Without a threshold the rows in front are scored whole, and the lowest of them is one.
    """
    helping, hurting = [], []
    for d in np.flatnonzero(query).tolist():
        for sign in (0, 1):
            term = shard.slots.get(2 * d + sign)
            if term is not None:
                weight = int(query[d])
                kind = helping if (weight < 0) == bool(sign) else hurting
                kind.append((int(shard.largest[term]) * abs(weight), term, weight))
    helping.sort(reverse=True)
    if sum(b for b, _, _ in helping) + sum(b for b, _, _ in hurting) > _LARGEST:
        raise OverflowError("scores of these vectors do not fit 64 bits")
    rest = np.cumsum([0, *[b for b, _, _ in reversed(helping)]], dtype=np.int64)[::-1]
    if least is not None and rest[0] < least:
        return shard.ids[:0], np.zeros(0, np.int64)
    # Without a threshold above 0, a row in no list at all may be one of the best.
    bounded = least is not None and least > 0
    essential = int(np.searchsorted(-rest, -least, "right")) if bounded else len(helping)
    scores = np.zeros(len(shard.ids), np.int64)
    met = np.zeros(len(shard.ids), bool)
    for _, term, weight in helping[:essential]:
        part = shard.lists[term]
        scores[shard.places[part]] += shard.weights[part] * weight
        met[shard.places[part]] = True
    rows = np.flatnonzero((met if bounded else True) & (shard.ids != query_id))
    others = sorted([(*t, t[0]) for t in helping[essential:]] + [(*t, 0) for t in hurting], reverse=True)
    hope = np.cumsum([0, *[t[3] for t in reversed(others)]], dtype=np.int64)[::-1]
    if least is None and len(rows) > k:
        front = rows[np.argpartition(-scores[rows], k - 1)[:k]]
        whole = scores.copy()
        for _, term, weight, _ in others:
            shard.add(whole, front, term, weight)
        least = int(whole[front].min())
    for j, (_, term, weight, _) in enumerate(others):
        if least is not None and j % _DROP_EVERY == 0:
            rows = rows[scores[rows] + hope[j] >= least]
            if not len(rows):
                break
        shard.add(scores, rows, term, weight)
    if least is not None:
        rows = rows[scores[rows] >= least]
    ids, found = shard.ids[rows], scores[rows]
    first = np.lexsort((ids, -found))[:k]
    return ids[first], found[first]


def _matrix(lists: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column as a matrix, filled with 0 on the right."""
    lengths = np.diff(lists.offsets.to_numpy())
    found = np.zeros((len(lists), width), np.int64)
    rows = np.repeat(np.arange(len(lists)), lengths)
    columns = np.arange(len(rows)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    found[rows, columns] = lists.flatten().to_numpy()
    return found


def _single(group: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Ids, ascending, and vectors of a group; of rows with one id the one with the smallest vector."""
    lists = pa.concat_arrays(group["values"].chunks)
    ids = group["id"].to_numpy()
    values = _matrix(lists, int(np.diff(lists.offsets.to_numpy()).max(initial=0)))
    order = np.lexsort((*values.T[::-1], ids))
    order = order[np.concatenate(([True], ids[order][1:] != ids[order][:-1]))]
    return ids[order], values[order]


def _shard_row(group: pa.Table) -> pa.Table:
    shard = Shard.of(*_single(group))
    lists = {"terms": pa.int32(), "ends": pa.int64(), "places": pa.int32(), "weights": pa.int64()}
    columns = [
        pa.array([group["shard"][0].as_py()], pa.int32()),
        pa.array([shard.ids], pa.list_(pa.int64())),
        pa.array([shard.width], pa.int32()),
        *[pa.array([getattr(shard, name)], pa.list_(kind)) for name, kind in lists.items()],
    ]
    return pa.table(columns, names=["shard", "ids", "width", *lists])


def _block_row(shards: int):
    def row(group: pa.Table) -> pa.Table:
        ids, values = _single(group)
        block = group["block"][0].as_py()
        numbers = [pa.array([n], pa.int32()) for n in (block, block % shards, values.shape[1])]
        longs = [pa.array([x], pa.list_(pa.int64())) for x in (ids, values.ravel())]
        names = ["block", "home", "queries", "columns", "components"]
        return pa.table([*numbers[:2], longs[0], numbers[2], longs[1]], names=names)

    return row


def _met(k: int):
    """The best rows of each shard for the queries of the block beside it."""

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = {name: batch.column(name) for name in batch.schema.names}

            def values(name: str, i: int) -> np.ndarray:
                return column[name][i].values.to_numpy(zero_copy_only=False)

            for i in range(len(batch)):
                parts = [values(name, i) for name in ("terms", "ends", "places", "weights")]
                shard = Shard(values("ids", i), column["width"][i].as_py(), *parts).prepared()
                ids = values("queries", i)
                queries = values("components", i).reshape(len(ids), column["columns"][i].as_py())
                least = column["least"][i].as_py() or [None] * len(ids)
                found = [best(shard, int(n), q, k, t) for n, q, t in zip(ids, queries, least, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(ids, [len(f[0]) for f in found]), pa.int64()),
                        pa.array(np.concatenate([np.zeros(0, np.int64), *[f[0] for f in found]]), pa.int64()),
                        pa.array(np.concatenate([np.zeros(0, np.int64), *[f[1] for f in found]]), pa.int64()),
                    ],
                    names=["query_id", "vec_id", "score"],
                )

    return met


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best rows of every query, merged from those of the shards; ties go to the smaller id."""
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(vectors: DataFrame, is_query: Column, k: int, folder: str) -> DataFrame:
    """``query_id, rank, vec_id, score``: of every query the ``k`` rows with the highest inner product.

    ``vectors`` has ``id, values`` (:func:`quantised`). The queries are the rows for which ``is_query`` holds; a query's
    own row is no candidate. Ties go to the smaller id, and a query with fewer than ``k`` candidates gets all.
    Of rows with one id the one with the smallest vector counts. A short vector has 0 for what it lacks.
    An empty table, and one without queries, give no rows.

    The rows are dealt to shards by a hash of their id, the queries to blocks, and every block meets
    every shard: first one of them, whose ``k`` best scores are the threshold of MaxScore in all others.
    Shards, blocks and thresholds are written to ``folder``. Both have a bounded size; their
    pairs, and nothing else, grow with the product of queries and rows.
    """
    size = F.size("values") + F.lit(1)
    counted = vectors.agg(F.sum(size).alias("all"), F.sum(F.when(is_query, size)).alias("queries")).first()
    shards = -(-(counted["all"] or 0) // SHARD_VALUES) or 1
    blocks = -(-(counted["queries"] or 0) // BLOCK_VALUES) or 1

    def dealt(rows: DataFrame, n: int, into: str) -> DataFrame:
        return rows.select(F.pmod(F.xxhash64("id"), F.lit(n)).cast("int").alias(into), "id", "values")

    index = dealt(vectors, shards, "shard").groupBy("shard").applyInArrow(_shard_row, _SHARD)
    index = written(index, f"{folder}/shards")
    asked = dealt(vectors.filter(is_query), blocks, "block").groupBy("block").applyInArrow(_block_row(shards), _BLOCK)
    asked = written(asked, f"{folder}/queries")

    none = F.lit(None).cast("array<long>")
    first = asked.withColumn("least", none).join(index, F.col("home") == F.col("shard"))
    seen = written(first.mapInArrow(_met(k), _FOUND), f"{folder}/first")
    lasts = _ranked(seen, k).filter(F.col("rank") == k).select("query_id", F.col("score").alias("least"))
    each = asked.select("block", F.posexplode("queries").alias("at", "query_id"))
    known = each.join(lasts, "query_id", "left").groupBy("block").agg(
        F.sort_array(F.collect_list(F.struct("at", "least"))).alias("known")
    )
    least = F.transform("known", lambda x: x["least"])
    others = F.array_remove(F.sequence(F.lit(0), F.lit(shards - 1)), F.col("home"))
    waiting = asked.join(known.select("block", least.alias("least")), "block")
    rest = waiting.withColumn("other", F.explode(others)).join(index, F.col("other") == F.col("shard"))
    found = seen.unionAll(rest.mapInArrow(_met(k), _FOUND))
    return _ranked(found, k).select("query_id", "rank", "vec_id", "score")


def oracle_sql(every: int, k: int) -> str:
    """The search over ``embeddings`` with every ``every``-th id as a query."""
    return f"""
WITH rows AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id,
        CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM rows q JOIN rows c ON c.vec_id <> q.vec_id
    WHERE q.vec_id % {every} = 0
), ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= {k}
"""
