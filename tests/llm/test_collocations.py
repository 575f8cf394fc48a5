"""Collocations against counts of all phrases in one dictionary."""

import random
import re
from collections import Counter

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from orderloom.llm import collocations, queries
from orderloom.session import shared_dir

SCHEMA = "doc_id long, text string, lang string"


def brute(rows, least=10, most=3, top=2000, share=50):
    """``rows`` are ``(text, lang)``."""
    counts, totals = Counter(), Counter()
    small = {ord(c): ord(c) + 32 for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(small)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for n in range(1, most + 1):
                counts.update((lang, tuple(words[i : i + n])) for i in range(len(words) - n + 1))
    candidates = {p: a for p, a in counts.items() if len(p[1]) > 1 and a >= least}
    beaten = set()
    for (lang, words), f in candidates.items():
        for n in range(2, len(words)):
            for i in range(len(words) - n + 1):
                inner = (lang, words[i : i + n])
                if 100 * f >= share * counts[inner]:
                    beaten.add(inner)
    found = {}
    for (lang, words), a in candidates.items():
        if (lang, words) not in beaten:
            cuts = []
            for k in range(1, len(words)):
                left, right = counts[lang, words[:k]], counts[lang, words[k:]]
                cuts.append((1_000_000 * a * a // (left * right), k, left, right))
            score, _, left, right = min(cuts)
            found.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), left, right))
    return sorted(
        (lang, rank, phrase.decode(), -a, left, right, totals[lang], -score)
        for lang, rows in found.items()
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows)[:top], 1)
    )


def mined(spark, docs, **kind):
    return sorted(map(tuple, collocations.mine(docs, shared_dir(spark, "phrases"), **kind).collect()))


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(d["text"], d["lang"]) for d in pq.read_table(f"{sf}/documents.parquet").to_pylist()]
    got = queries.op13_collocations(spark, sf)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert {kind for name, kind in got.dtypes if name not in ("lang", "phrase")} == {"bigint"}
    assert sorted(map(tuple, got.collect())) == brute(rows)


def _odd_rows():
    rng = random.Random(3)
    words = ["a", "A", "b", "é", "É", "of", "the", "x-y", "日本", "1", "'", " ", "zz zz"]
    gaps = [" ", "  ", "\t", ", ", ".", "\n", "\x0b", "\x0c", "\r", ";", ": ", "! ", "? ", "\x1f"]
    texts = ["".join(rng.choice(words) + rng.choice(gaps) * (rng.random() < 0.97) for _ in range(90)) for _ in range(60)]
    rows = [(k, t, rng.choice(["en", "de", "", None, "und", "x y."])) for k, t in enumerate(texts)]
    rows += [(None, None, "en"), (None, "", None), (1, " \t ", "en"), (2, "...", "fr"), (2, "a a a a a", "rep")] * 4
    return [*rows, (3, "the long run " * 40_000, "long")]


def test_odd_texts(spark):
    rows = _odd_rows()
    docs = spark.createDataFrame(rows, SCHEMA)
    clashing = docs.select("*", *[F.lit("x").alias(c) for c in ("phrase", "f", "rank", "score", "n", "a")])
    plain = [(t, lang) for _, t, lang in rows]
    assert mined(spark, clashing.repartition(5)) == brute(plain)
    assert mined(spark, docs, least=3, most_words=4, top=25, share=30) == brute(plain, 3, 4, 25, 30)
    assert mined(spark, docs, least=2, most_words=2) == brute(plain, 2, 2)


def test_no_rows(spark):
    assert mined(spark, spark.createDataFrame([], SCHEMA)) == []
    assert mined(spark, spark.createDataFrame([(1, None, None), (2, "one two", "en")], SCHEMA)) == []


def test_filter_that_lets_all_through(spark, monkeypatch):
    """However full the filter is, the counts stay exact."""
    monkeypatch.setattr(collocations, "MOST_FILTER_BITS", 1 << 15)
    monkeypatch.setattr(collocations, "FILTER_BITS", 1 << 20)
    rows = _odd_rows()
    assert mined(spark, spark.createDataFrame(rows, SCHEMA)) == brute([(t, lang) for _, t, lang in rows])
    assert collocations._Filter(b"\xff" * 4096).passing(collocations.stream(pa.array(["a b"]), pa.array(["x"])).hashes).all()


def test_products_beyond_64_bits(spark):
    """Counts of a table of 100 TB, as the score sees them."""
    big = 4_000_000_000_000
    row = spark.createDataFrame([(big, big + 7, big + 9)], "a long, l long, r long")
    a, left, right = (F.col(c).cast("decimal(20,0)") for c in ("a", "l", "r"))
    got = row.select((a * a * F.lit(1_000_000)).alias("above"), (left * right).alias("below")).selectExpr("above div below").first()[0]
    assert got == 1_000_000 * big * big // ((big + 7) * (big + 9))


@pytest.mark.parametrize("size", [1, 2])
def test_filter_knows_what_is_in_it(spark, size):
    docs = spark.createDataFrame([(k, t, lang) for k, t, lang in _odd_rows()], SCHEMA)
    counts = collocations.count_streams(docs, shared_dir(spark, "phrases"), 10, size)
    bits = collocations._Filter(collocations._filter(spark, counts[-1].filter("phrase != ''"), size).value)
    rows = counts[-1].filter("phrase != ''").collect()
    for r in rows:
        hashes = collocations.stream(pa.array([r.phrase]), pa.array([r.lang])).hashes
        assert bits.passing(collocations._phrase_hashes(hashes, size)).all()
    assert rows
