"""MaxScore search against inner products of all pairs."""

import math

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from orderloom.llm import queries, topk
from orderloom.session import shared_dir

SF = "/root/testdata/sf0.1"


def brute(rows, asked, k):
    """``rows`` are ``(id, vector)``, one for each id."""
    kept = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            whole = [math.floor(1024 * x) for x in v]
            kept[i] = min(kept.get(i, whole), whole)
    found = []
    for q in filter(asked, kept):
        scores = sorted(
            (-sum(a * b for a, b in zip(kept[q], v, strict=False)), i) for i, v in kept.items() if i != q
        )
        found += [(q, n, i, -s) for n, (s, i) in enumerate(scores[:k], 1)]
    return sorted(found)


def searched(spark, df, k=10, every=100):
    found = topk.search(topk.quantised(df), F.col("id") % every == 0, k, shared_dir(spark, "top-k"))
    return sorted(map(tuple, found.collect()))


def test_query_over_many_shards(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD_VALUES", 1 << 14)
    monkeypatch.setattr(topk, "BLOCK_VALUES", 1 << 9)
    rows = [(r["vec_id"], r["embedding"]) for r in pq.read_table(f"{SF}/embeddings.parquet").to_pylist()]
    got = queries.op11_exact_top_k(spark, SF)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect())) == brute(rows, lambda i: i % 100 == 0, 10)


def test_odd_vectors(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD_VALUES", 12)
    monkeypatch.setattr(topk, "BLOCK_VALUES", 8)
    nan, inf = float("nan"), float("inf")
    same = [0.5, -0.25, 0.125]
    rows = [
        (0, same), (2, same), (4, same), (5, same), (7, same), (100, same), (100, same), (102, [0.5, 0.5, 0.5]),
        (102, [0.1, 0.2, 0.3]), (8, [0.0, 0.0, 0.0]), (10, [-0.5, -0.5, -0.5]), (11, None), (12, [0.5, None, 1.0]),
        (14, [nan, 0.0, 0.0]), (16, [inf, 0.0, 0.0]), (18, [-inf, 0.0, 0.0]), (None, same), (20, []), (22, [0.75]),
        (24, [0.1, 0.2, 0.3, 0.9]), (-26, [-0.9, 0.3, 0.1]),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    clashing = df.select("*", *[F.lit("x").alias(c) for c in ("id", "values", "shard", "block", "score", "rank")])
    small = [(i, v if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    for k in (1, 3, 40):
        assert searched(spark, clashing, k, 2) == brute(small, lambda i: i % 2 == 0, k)
    assert searched(spark, df.limit(0)) == []
    assert searched(spark, df.filter("vec_id = 5")) == []
    assert searched(spark, df.filter("vec_id = 0 AND vec_id IS NOT NULL")) == []


def test_scores_that_do_not_fit_fail(spark):
    rows = [(0, [1e30]), (1, [1e30])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="do not fit|overflow|ARITHMETIC"):
        searched(spark, df)


@pytest.mark.parametrize("seed", range(30))
def test_max_score_of_one_shard(seed):
    rng = np.random.default_rng(seed)
    n, width, k = int(rng.integers(1, 400)), int(rng.integers(1, 20)), int(rng.integers(1, 12))
    values = rng.integers(-9, 10, (n, width)) * (rng.random((n, width)) < rng.random())
    ids = np.arange(n) * 3
    shard = topk.Shard.of(ids, values).prepared()
    query = rng.integers(-9, 10, width)
    scores = values @ query
    for least in (None, -50, 0, 1, int(np.sort(scores)[-min(k, n)]), int(scores.max()), int(scores.max()) + 1):
        rows = [(-int(s), int(i)) for s, i in zip(scores, ids, strict=True) if i != 6 and (least is None or s >= least)]
        want = [(i, -s) for s, i in sorted(rows)[:k]]
        got_ids, got = topk.best(shard, 6, query, k, least)
        assert list(zip(got_ids.tolist(), got.tolist(), strict=True)) == want


def test_thresholds_save_work(monkeypatch):
    """With the threshold of a first shard most probes of the others are left out."""
    rng = np.random.default_rng(1)
    centers = rng.normal(size=(40, 64))
    values = np.floor(200 * (centers[rng.integers(0, 40, 4000)] + 0.3 * rng.normal(size=(4000, 64)))).astype(np.int64)
    shard = topk.Shard.of(np.arange(4000), values).prepared()
    query = values[17]
    left = []
    plain = topk.Shard.add
    monkeypatch.setattr(topk.Shard, "add", lambda self, s, rows, *term: left.append(len(rows)) or plain(self, s, rows, *term))
    ids, scores = topk.best(shard, 17, query, 10, int(np.sort(values @ query)[-20]))
    assert len(ids) == 10 and sum(left) < 0.5 * 4000 * 64
    assert topk.best(shard, 17, query, 10, int(scores.max()) * 50)[0].tolist() == []
