"""The corpus pipeline against plain loops over a small table with planted cases."""

import random
import re
from collections import Counter

import corpus_pipeline
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import sentencepiece

SF = "/root/testdata/sf0.001"
COMMON = "Subscribe to our newsletter for more stories today"
RARE = "Printed by the local press in the old town"


def planted(docs, items):
    """``doc_id, text, source`` of documents that each stage has to tell apart, made of the words of given ones."""
    deal = random.Random(5)
    rows = [(text, 0) for text in (None, "", "123 456 !!! 789", "\n\n", "한국어는 한국에서 사용하는 언어이며 많은 사람들이 사용한다 정말로")]

    def shuffled():
        words = deal.choice([d for d in docs if len(d["text"].split()) > 150])["text"].split()
        return deal.sample(words, 120)

    for k in range(12):
        tail = [COMMON] * (k < 10) + [RARE] * (k < 9)
        rows.append((" ".join(shuffled()) + "\n\n" + "\n".join([f"  {t} \r" for t in tail]), k))
    rows += [(COMMON, 1), (f"\n{COMMON}", 2)]
    words = shuffled()
    rows += [(" ".join(words), k) for k in range(3)]
    rows += [(" ".join(words[:k] + ["anders"] + words[k + 1 :]), 3) for k in (1, 60)]
    rows += [(" ".join(words[:40] + shuffled()[:80]), 4), ("Kurz", 5), ("the", 6)]
    for item in items[:6]:
        of, around = item["text"].split(), shuffled()
        rows.append((" ".join(around[:50] + of + around[50:]), 7))
        rows.append((" ".join(around[::-1][:60] + of[: len(of) // 2] + around[::-1][60:]), 8))
    return [(10_000 + k, text, f"site{site}.org") for k, (text, site) in enumerate(rows)]


def shingles(words):
    n = min(5, len(words))
    return Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if n else Counter()


def without_spread_lines(rows):
    sites = {}
    for _, text, source in rows:
        for line in text.split("\n"):
            sites.setdefault(line.strip(" \t\x0b\x0c\r"), set()).add(source)
    spread = {line for line, of in sites.items() if line and len(of) >= 10}
    for key, text, source in rows:
        left = [line for line in text.split("\n") if line.strip(" \t\x0b\x0c\r") not in spread]
        yield key, "\n".join(left) if any(line.strip(" \t\x0b\x0c\r") for line in left) else text, source


def first_of_groups(rows):
    """A row stays unless a chain of texts that are each 0.8 alike leads to one with a smaller key."""
    bags = [shingles(re.findall(r"[^\x20\x09-\x0D]+", text)) for _, text, _ in rows]
    group = list(range(len(rows)))
    for i, a in enumerate(bags):
        for j, b in enumerate(bags[:i]):
            if a and b and a.keys() & b.keys() and sum((a & b).values()) >= 0.8 * sum((a | b).values()):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    smallest = {}
    for (key, _, _), g in zip(rows, group, strict=True):
        smallest[g] = min(key, smallest.get(g, key))
    return [row for row, g in zip(rows, group, strict=True) if row[0] == smallest[g]]


def holds(text, item):
    want, have = (shingles(re.findall(r"\w+", t.lower())) for t in (item, text))
    return bool(want) and sum((want & have).values()) >= 0.8 * sum(want.values())


def test_pipeline_against_brute_force(spark, tmp_path):
    docs, items = (pq.read_table(f"{SF}/{name}.parquet").to_pylist() for name in ("documents", "benchmark"))
    extra = planted(docs, items)
    table = pq.read_table(f"{SF}/documents.parquet")
    new = [{"doc_id": k, "text": t, "lang": None, "source": s, "n_chars": None if t is None else len(t)} for k, t, s in extra]
    pq.write_table(pa.concat_tables([table, pa.Table.from_pylist(new, table.schema)]), tmp_path / "documents.parquet")
    pq.write_table(pq.read_table(f"{SF}/benchmark.parquet"), tmp_path / "benchmark.parquet")

    # All but the first five planted documents are in a language that the labels have.
    rows = [(d["doc_id"], d["text"], d["source"]) for d in docs] + extra[5:]
    rows = first_of_groups(list(without_spread_lines(rows)))
    kept = [row for row in rows if not any(holds(row[1], item["text"]) for item in items)]
    library = sentencepiece.SentencePieceProcessor(model_file=str(public_tokenizers.path(corpus_pipeline.PIECE_MODEL)))
    got = {r.doc_id: r.ids for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert got == {key: library.encode(text) for key, text, _ in kept}
    # Each stage had something to do, and halves of items and texts that share a third are clean.
    left = {key for key in got if key >= 10_000}
    assert len(rows) - len(kept) >= 6 and len(extra) - len(left) >= 5 + 1 + 4 + 6
    assert {10_000 + 5 + 12 + 2 + k for k in (0, 5, 6, 7)} <= left
    assert all(10_000 + 27 + 2 * k + 1 in left for k in range(6))
    assert not any(10_000 + 27 + 2 * k in left for k in range(6))
