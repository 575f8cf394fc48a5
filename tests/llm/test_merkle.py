"""The Merkle manifest against a tree built by hand."""

import hashlib
import zlib
from collections import Counter

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from orderloom.llm import merkle, queries
from orderloom.session import shared_dir


def _h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _leaf(*values):
    return _h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def _levels(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([_h("".join(levels[-1][i : i + 2])) for i in range(0, len(levels[-1]), 2)])
    return levels


def _path(levels, i):
    found = []
    for nodes in levels[:-1]:
        found.append((i & 1, nodes[i ^ 1] if i ^ 1 < len(nodes) else None))
        i >>= 1
    return found


def brute(rows):
    """Rows of ``doc_id, source, lang, n_chars, text``."""
    leaves = {}
    for r in rows:
        leaf = _leaf(*r)
        more = [*r[:3], None if r[3] is None else r[3] + 1, r[4]]
        hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
        leaves.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, leaf, _leaf(*more) if hit else leaf))
    names = sorted(leaves, key=lambda lang: (lang is not None, (lang or "").encode()))
    trees = {lang: _levels([x[2] for x in sorted(leaves[lang])]) for lang in names}
    top = _levels([trees[lang][-1][0] for lang in names])
    found = []
    for place, lang in enumerate(names):
        for i, (known, doc_id, leaf, start) in enumerate(sorted(leaves[lang])):
            path = _path(trees[lang], i) + _path(top, place)
            node = start
            for odd, sibling in path:
                node = _h((sibling or "") + node) if odd else _h(node + (sibling or ""))
            proof = _h("".join(s for _, s in path if s))
            found.append((doc_id if known else None, leaf, trees[lang][-1][0], top[-1][0], proof, node, node == top[-1][0]))
    return Counter(found)


def _got(spark, docs):
    folder = shared_dir(spark, "merkle")
    manifest = merkle.build(merkle.document_rows(docs), folder)
    found = merkle.proofs(manifest, folder).collect()
    rows = []
    for r in found:
        siblings = "".join(step[1:] for step in r.proof)
        rows.append((r.id, r.leaf, r.subroot, r.root, _h(siblings), r.folded, r.folded == r.root))
    return Counter(rows)


def test_levels_beyond_one_slot_array(spark):
    sf = "/root/testdata/sf0.1"
    docs = pq.read_table(f"{sf}/documents.parquet").to_pylist()
    want = brute([(d["doc_id"], d["source"], d["lang"], d["n_chars"], d["text"]) for d in docs])
    assert max(Counter(d["lang"] for d in docs).values()) > merkle.SLOTS
    got = queries.op12_merkle_manifest(spark, sf).collect()
    assert Counter(map(tuple, got)) == want
    verified = Counter(r.verified for r in got)
    assert verified[False] == sum(zlib.crc32(str(d["doc_id"]).encode()) % 7 == 0 for d in docs)


def test_missing_repeated_and_far_ids(spark):
    rows = [
        (None, "s", None, None, None),
        (None, None, "de", 3, "no id"),
        (None, None, "de", 3, "no id"),
        (None, "a", "de", 3, "no id either"),
        (7, "a", "de", 3, "é"),
        (7, "a", "de", 3, "é"),
        (7, "b", "de", 2, "another text"),
        (-5, "a", "de", 1, ""),
        (2**62, "a", "de", 2**63 - 1, "far"),
        (-(2**63), "a", "de", None, "far"),
        (40_000, "a", "", 1, "x" * 200_000),
        (0, "a", "-", 1, "1:a"),
        (0, "a1:", "-", 1, "a"),
        *[(i, "s", "Ω", i, str(i)) for i in range(32_700, 32_900)],
    ]
    schema = "doc_id long, source string, lang string, n_chars long, text string"
    docs = spark.createDataFrame(rows, schema)
    clashing = docs.select("*", *[F.lit("x").alias(c) for c in ("leaf", "tree", "bucket", "rank", "id", "grp")])
    assert _got(spark, clashing) == brute(rows)


def test_one_row_and_no_row(spark):
    schema = "doc_id long, source string, lang string, n_chars long, text string"
    one = [(7, "s", "en", 1, "x")]
    assert _got(spark, spark.createDataFrame(one, schema)) == brute(one)
    assert not _got(spark, spark.createDataFrame([], schema))


def test_many_copies_of_one_id(spark):
    """More rows than a slot array holds, all under one id, and as many without any."""
    rows = spark.range(9000).select(
        F.when(F.col("id") < 4500, F.lit(3)).cast("long").alias("doc_id"),
        F.lit("s").alias("source"),
        F.lit("en").alias("lang"),
        (F.col("id") % 50).alias("n_chars"),
        F.lit("t").alias("text"),
    )
    assert _got(spark, rows) == brute([tuple(r) for r in rows.collect()])


def test_ranks_need_no_sort_where_ids_differ(spark):
    """Only the directory, a row per bitmap, is ordered; leaves are placed by their bitmap."""
    folder = shared_dir(spark, "merkle")
    leaves = spark.range(100).select("id", F.lit("x").alias("tree"), F.lit("l").alias("leaf"), F.lit("o").alias("other"))
    plan = merkle._placed(leaves, folder)._jdf.queryExecution().optimizedPlan().toString()
    assert "Sort" not in plan and "Window" not in plan
