"""Tables of chunks that are full, and what workers hand back."""

import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from orderloom.llm import decontaminate, language, near_dedup, pieces, substring_dedup, token_files, worker
from orderloom.llm.chunks import ChunkIds, flattened
from orderloom.session import BATCH_SETTING, LEAST_FILES, small_batches
from orderloom.sources.tables import written


def _codes(chunks):
    return flattened([list(map(ord, chunk)) for chunk in chunks])


def test_a_full_table_keeps_what_comes_often_and_gives_the_same_ids():
    asked = Counter()

    def encode(chunks):
        asked.update(chunks)
        return _codes(chunks)

    table = ChunkIds(encode, most=20)
    for k in range(50):
        documents = [["often", f"once{k}", "often"], [], [f"rare{k}", "too", "often"], [f"more{k}"]]
        lengths, flat = table.ids(documents)
        wanted = ["".join(document) for document in documents]
        assert lengths.tolist() == [len(text) for text in wanted]
        assert "".join(map(chr, flat)) == "".join(wanted)
        assert len(table) <= 20 + 5 and len(table._uses) == len(table) == len(table._starts)
    # Before, a full table was emptied, and these were encoded anew each time.
    assert asked["often"] == asked["too"] == 1
    assert len(table._ids) == sum(map(len, table))


def test_a_full_table_of_frequent_chunks_is_halved():
    table = ChunkIds(_codes, most=10)
    names = [f"w{k}" for k in range(12)]
    for _ in range(3):
        lengths, _ = table.ids([names * 2 + names[:2] * 5])
        assert lengths.tolist() == [sum(map(len, names * 2 + names[:2] * 5))]
    table.ids([[]])
    assert len(table) == 5 and list(table)[:2] == ["w0", "w1"]


def test_language_counts_do_not_depend_on_a_full_table():
    samples = (("en", "the cat and the dog "), ("de", "der hund und die katze "))
    texts = [[f"the {a}at", "und die katze", f"{a}{a} der"] for a in "abcdefghij"]
    small, large = language.Parses(samples), language.Parses(samples)
    small._most = 3
    for some in texts:
        for found, wanted in zip(small.counts(some), large.counts(some), strict=True):
            assert np.array_equal(found, wanted)
    assert len(small) < len(large)


def test_visits_hand_back_free_memory_behind_every_batch(spark, monkeypatch):
    calls = []
    for module in (near_dedup, language, pieces, decontaminate):
        monkeypatch.setattr(module, "give_back", lambda: calls.append(1))
    texts = pa.array(["one two three four five six", ""])
    list(near_dedup._signed(30, 5).func(iter([texts, texts])))
    assert len(calls) == 2
    list(near_dedup._similarities(iter([(texts, texts)])))
    assert len(calls) == 3
    worker.give_back()


@pytest.mark.parametrize("fails", [False, True])
def test_batches_are_small_only_for_a_while(spark, fails):
    before = spark.conf.get(BATCH_SETTING)
    try:
        with small_batches(spark):
            assert spark.conf.get(BATCH_SETTING) == "4194304b"
            if fails:
                raise KeyError
    except KeyError:
        assert fails
    assert spark.conf.get(BATCH_SETTING) == before


def test_token_files_are_written_from_small_batches(spark, tmp_path, monkeypatch):
    seen = []

    def watched(session):
        seen.append(session)
        return small_batches(session)

    monkeypatch.setattr(token_files, "small_batches", watched)
    texts = [(2, "zwei drei"), (1, "eins, zwei."), (None, None), (1, "x")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    spec = token_files.read_spec(public_tokenizers.path("word_bpe_49k.json"))
    token_files.write(docs, str(tmp_path / "ids"), spec, 2)
    assert seen == [spark]
    found = [tuple(r) for r in token_files.digests(spark, str(tmp_path / "ids")).orderBy("start").collect()]
    assert [row[0] for row in found] == [None, 1, 1, 2] and found[0][1:3] == (0, 1)
    assert all(a[1] + a[2] == b[1] for a, b in zip(found, found[1:], strict=False))


def test_chunks_of_a_column_give_the_ids_of_the_library():
    words = token_files.Words(token_files.read_spec(public_tokenizers.path("word_bpe_49k.json")))
    signs = [*"aZéÿ×÷,.;:!?' \t\n\r\x0b\x0c1…İß|<", "̧", "'s", "<|endoftext|>", "word"]
    rng = random.Random(7)
    texts = ["".join(rng.choices(signs, k=rng.randrange(25))) for _ in range(3000)]
    column = pa.array(["left out", *texts])[1:]
    lengths, flat = words.encode_column(column)
    wanted = [e.ids for e in words.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert lengths.tolist() == list(map(len, wanted))
    assert flat.tolist() == [i for ids in wanted for i in ids]
    chunks, ends = token_files._chunks(pa.array(["", " über, a.b", "x…, 1,"]))
    assert chunks.to_pylist() == [" ", "über", ", ", "a", ".b", "x…, ", "1,"] and ends.tolist() == [0, 0, 5, 7]


def test_a_chunk_is_looked_up_once_however_often_it_comes():
    words = token_files.Words(token_files.read_spec(public_tokenizers.path("word_bpe_49k.json")))
    asked = Counter()

    class Table(ChunkIds):
        def __getitem__(self, chunk):
            asked[chunk] += 1
            return super().__getitem__(chunk)

    words.table = Table(words._encode_chunks)
    lengths, _ = words.encode_column(pa.array(["one, two one\none", "two one. one"]))
    assert lengths.tolist() == [5, 4]
    # With white space behind it or not, and so 3 times at most; before, 5 times.
    assert asked["one"] <= 3


def test_parts_of_many_shuffle_partitions_share_few_files(spark, tmp_path):
    settings = {"spark.sql.shuffle.partitions": "60", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name) for name in settings}
    rows = [(k * 7 % 300 - 100, f"text {k} of several") for k in range(300)] + [(None, "none"), (5, None)]
    spec = token_files.read_spec(public_tokenizers.path("word_bpe_49k.json"))
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        token_files.write(spark.createDataFrame(rows, "doc_id long, text string"), str(tmp_path / "ids"), spec, 2)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    # Before, every partition of the shuffle was a file.
    assert len(list((tmp_path / "ids").glob("part-*"))) <= LEAST_FILES
    blocks = spark.read.parquet(str(tmp_path / "ids"))
    assert blocks.select("part").distinct().count() > LEAST_FILES
    found = [tuple(r) for r in token_files.digests(spark, str(tmp_path / "ids")).orderBy("start").collect()]
    assert [row[0] for row in found] == [None, *sorted(k for k, _ in rows if k is not None)]
    assert all(a[1] + a[2] == b[1] for a, b in zip(found, found[1:], strict=False))
    texts = {row["doc_id"]: row["ids"] for row in token_files.read(spark, str(tmp_path / "ids")).collect()}
    words = token_files.Words(spec)
    for key, text in rows[:300:17]:
        if key != 5:
            assert texts[key] == [*words.encode([text])[1].tolist(), 2]


def test_repeats_are_written_to_few_files_from_small_batches(spark, monkeypatch):
    settings = {"spark.sql.shuffle.partitions": "60", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name) for name in settings}
    files = {}

    def counted(df, path):
        found = written(df, path)
        files[path.rsplit("/", 1)[-1].partition("-")[0]] = (len(found.inputFiles()), spark.conf.get(BATCH_SETTING))
        return found

    monkeypatch.setattr(substring_dedup, "written", counted)
    passages = [" ".join(f"p{k}w{i}" for i in range(25)) for k in range(100)]
    rows = [(k, passages[k % 100] + f" own{k}") for k in range(200)]
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        left = substring_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    want = {(k, text if k < 100 else f"own{k}", 0 if k < 100 else 25) for k, text in rows}
    assert {(row.doc_id, row.text, row.n_removed) for row in left} == want
    assert set(files) == {"pieces", "candidates", "extents", "copies", "spans"}
    # Before, each was as many files as the shuffle had partitions with rows, and batches had 10,000 rows.
    assert all(n <= LEAST_FILES and size == "4194304b" for n, size in files.values())
    assert spark.conf.get(BATCH_SETTING) != "4194304b"
