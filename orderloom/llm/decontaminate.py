"""Benchmark decontamination: training passages are queries to a BM25 index of the test items."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import offsets_of, ranges, text_of, visit
from orderloom.llm.words import text_steps
from orderloom.llm.worker import give_back, keep

_WORD = re.compile(r"\w+")
# A line end, or the end of a sentence, behind which the last part of an item is its answer.
_SENTENCE = re.compile(r"\n+|(?<=[.!?])\s+")

SHINGLE = 5
K1, B = 1.2, 0.75

# Items in one block of a posting list, and items in one index; a larger benchmark has several indexes.
BLOCK = 8
INDEX_ITEMS = 20_000

# What share of an item's threshold the terms may bring that do not start a search.
COMMON_SHARE = 0.5


class _Vocabulary(dict):
    def __missing__(self, word: str) -> int:
        return -1


@dataclass
class _Item:
    key: int | None
    words: list[int]
    question: int
    weights: dict[int, float]
    shingles: dict[tuple[int, ...], int]


def _shingles(words: Sequence[int]) -> list[tuple[int, ...]]:
    """All five-word shingles in order; a shorter text is one shingle."""
    if len(words) < SHINGLE:
        return [tuple(words)] if words else []
    return list(zip(*(words[k:] for k in range(SHINGLE)), strict=False))


class Index:
    """An inverted index of test items with block maxima, in one Python worker.

    Weights are divided by each item's threshold, so every item asks for 1. The
    threshold is what is left of an item's own score without its heaviest
    words, as many as a passage may lack that still shares ``share`` of the
    item's shingles: no such passage can score less.
    """

    def __init__(self, items: Sequence[tuple[int | None, str]], share: float):
        self.share = share
        self.vocabulary = _Vocabulary()
        read = []
        for key, text in items:
            parts = [_WORD.findall(part.lower()) for part in _SENTENCE.split(text.strip())]
            words = [word for part in parts for word in part]
            if not words:
                continue
            ids = [self.vocabulary.setdefault(word, len(self.vocabulary)) for word in words]
            filled = [part for part in parts if part]
            question = len(words) - len(filled[-1]) if len(filled) > 1 else len(words)
            read.append((key, ids, question))
        self.items = self._weighted(read)
        self.longest = max((len(item.words) for item in self.items), default=1)
        self.tile = max(64, self.longest)
        self._post()

    def _weighted(self, read: list[tuple[int | None, list[int], int]]) -> list[_Item]:
        n = len(read)
        found = Counter(t for _, ids, _ in read for t in set(ids))
        self.frequency = found
        mean = sum(len(ids) for _, ids, _ in read) / n if n else 1.0
        items = []
        for key, ids, question in read:
            shingles = Counter(_shingles(ids))
            longer = K1 * (1 - B + B * len(ids) / mean)
            weights = {
                t: math.log(1 + (n - found[t] + 0.5) / (found[t] + 0.5)) * tf * (K1 + 1) / (tf + longer)
                for t, tf in Counter(ids).items()
            }
            lacking = math.floor((1 - self.share) * sum(shingles.values()) + 1e-9)
            heaviest = sum(sorted(weights.values(), reverse=True)[:lacking])
            threshold = max(sum(weights.values()) - heaviest, 1e-9) * (1 - 1e-9)
            scaled = {t: w / threshold for t, w in weights.items()}
            items.append(_Item(key, ids, question, scaled, dict(shingles)))
        return items

    def _post(self) -> None:
        """Posting lists of the terms that start a search, by block, with the block's largest weight."""
        common = np.zeros(len(self.items))
        skipped = set()
        holders: dict[int, list[int]] = {}
        for k, item in enumerate(self.items):
            for t in item.weights:
                holders.setdefault(t, []).append(k)
        for t in sorted(holders, key=lambda t: (-len(holders[t]), t)):
            added = np.array([self.items[k].weights[t] for k in holders[t]])
            if (common[holders[t]] + added > COMMON_SHARE).any():
                continue
            common[holders[t]] += added
            skipped.add(t)
        self.blocks = -(-len(self.items) // BLOCK)
        # An item needs at least this much from terms that start a search.
        need = np.full(self.blocks * BLOCK, np.inf)
        need[: len(self.items)] = 1 - common
        self.need = need.reshape(self.blocks, BLOCK).min(axis=1) - 1e-9
        sizes, blocks, maxima = np.zeros(len(self.vocabulary), np.int64), [], []
        for t in range(len(self.vocabulary)):
            if t in skipped:
                continue
            best: dict[int, float] = {}
            for k in holders[t]:
                best[k // BLOCK] = max(best.get(k // BLOCK, 0.0), self.items[k].weights[t])
            sizes[t] = len(best)
            blocks += best.keys()
            maxima += best.values()
        self.sizes = sizes
        self.starts = np.cumsum(sizes) - sizes
        self.list_blocks = np.array(blocks, np.int64)
        self.list_maxima = np.array(maxima, np.float64)

    def search(self, texts: list[str]) -> list[list[dict]]:
        """For every text, the items that one of its passages holds.

        A passage is two neighbouring tiles of a text, each as long as the
        longest item, so any stretch of that length lies in one passage whole.
        """
        words = [list(map(self.vocabulary.__getitem__, _WORD.findall(text.lower()))) for text in texts]
        found: list[dict[int, dict]] = [{} for _ in texts]
        if not self.items:
            return [[] for _ in texts]
        counts = np.array([len(w) for w in words], np.int64)
        starts = offsets_of(counts)
        ids = np.fromiter((i for w in words for i in w), np.int64, int(starts[-1]))
        tiles = np.maximum(1, -(-counts // self.tile))
        # One empty tile lies between documents, so that neighbours are of one document.
        first = offsets_of(tiles + 1)
        for passage, block in self._candidates(ids, starts, counts, first):
            doc = int(np.searchsorted(first, passage, "right")) - 1
            at = max(0, passage - int(first[doc])) * self.tile
            stretch = words[doc][at : at + 2 * self.tile]
            for item, hit in self._verified(stretch, block):
                best = found[doc].get(item)
                if best is None or hit["overlap"] > best["overlap"]:
                    found[doc][item] = hit
        return [[hits[k] for k in sorted(hits)] for hits in found]

    def _candidates(
        self, ids: np.ndarray, starts: np.ndarray, counts: np.ndarray, first: np.ndarray
    ) -> Iterator[tuple[int, int]]:
        """Passages and blocks whose upper bound reaches what some item of the block needs."""
        known = ids >= 0
        hot = np.flatnonzero(known & (self.sizes[np.where(known, ids, 0)] > 0))
        if not len(hot):
            return
        doc = np.searchsorted(starts, hot, "right") - 1
        tile = first[doc] + (hot - starts[doc]) // self.tile
        sizes = self.sizes[ids[hot]]
        entries = ranges(self.starts[ids[hot]], sizes)
        keys = np.repeat(tile, sizes) * self.blocks + self.list_blocks[entries]
        order = np.argsort(keys, kind="stable")
        distinct, begin = np.unique(keys[order], return_index=True)
        sums = np.add.reduceat(self.list_maxima[entries][order], begin)
        # A tile with weight is the first of one passage and the second of another.
        passages = np.unique(np.concatenate((distinct, distinct - self.blocks)))
        passages = passages[passages >= 0]
        bound = _at(distinct, sums, passages) + _at(distinct, sums, passages + self.blocks)
        likely = passages[bound >= self.need[passages % self.blocks]]
        yield from zip((likely // self.blocks).tolist(), (likely % self.blocks).tolist(), strict=True)

    def _verified(self, stretch: list[int], block: int) -> Iterator[tuple[int, dict]]:
        terms = set(stretch)
        shingles = None
        for k in range(block * BLOCK, min((block + 1) * BLOCK, len(self.items))):
            item = self.items[k]
            score = sum(w for t, w in item.weights.items() if t in terms)
            if score < 1:
                continue
            if shingles is None:
                shingles = Counter(_shingles(stretch))
                shorter: dict[int, Counter] = {}
            size = min(SHINGLE, len(item.words))
            if size < SHINGLE:
                if size not in shorter:
                    shorter[size] = Counter(zip(*(stretch[j:] for j in range(size)), strict=False))
                have = shorter[size]
            else:
                have = shingles
            shared = sum(min(n, have.get(s, 0)) for s, n in item.shingles.items())
            overlap = shared / sum(item.shingles.values())
            if overlap + 1e-12 < self.share:
                continue
            covered = [False] * len(item.words)
            for at, shingle in enumerate(_shingles(item.words)):
                if shingle in have:
                    covered[at : at + size] = [True] * size
            question, answer = covered[: item.question], covered[item.question :]
            yield k, {
                "item_id": item.key,
                "score": score,
                "overlap": overlap,
                "question_overlap": sum(question) / len(question) if question else 0.0,
                "answer_overlap": sum(answer) / len(answer) if answer else None,
            }


def _at(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The values of the wanted keys, 0 where there is none; ``keys`` ascend."""
    places = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[places] == wanted, values[places], 0.0)


_HIT = "struct<item_id:long,score:double,overlap:double,question_overlap:double,answer_overlap:double>"
_HITS = pa.list_(
    pa.struct(
        [("item_id", pa.int64())]
        + [(name, pa.float64()) for name in ("score", "overlap", "question_overlap", "answer_overlap")]
    )
)

def _indexes(shards: list[list[tuple[int | None, str]]], share: float) -> list[Index]:
    """The worker's indexes for one benchmark."""
    key = ("indexes", share, tuple(map(tuple, shards)))
    return keep(key, lambda: [Index(shard, share) for shard in shards])


def with_leaks(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    share: float = 0.8,
    into: str = "leaks",
    most_bytes: int = 256 << 20,
) -> DataFrame:
    """Add ``into``, an array with a struct for every test item that a passage of the whole text holds.

    A passage holds an item when it shares ``share`` or more of the item's
    five-word shingles, counted with repeats; words are compared in lower case,
    without punctuation. The struct has ``item_id``, the BM25 ``score`` in
    units of the item's threshold, ``overlap``, and the shares of the words of
    question and answer (the last line or sentence, NULL if there is one only)
    that shared shingles cover. Items shorter than a shingle are one; items
    without words, and NULL items, never match; repeated items each do. NULL
    and empty texts have no leaks. A column of that name is replaced.

    Only the test items are broadcast, and only up to ``most_bytes`` of text,
    which is checked; documents are not shuffled.
    """
    spark = docs.sparkSession
    whole = items.select(F.col(f"`{item_key}`").cast("long"), F.col(f"`{item_text}`")).filter(
        F.col(f"`{item_text}`").isNotNull()
    )
    size = whole.agg(F.coalesce(F.sum(F.octet_length(whole[1])), F.lit(0))).first()[0]
    if size > most_bytes:
        raise ValueError(f"{size} bytes of test items are more than the {most_bytes} that may be broadcast")
    rows = sorted((tuple(row) for row in whole.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    shards = [rows[i : i + INDEX_ITEMS] for i in range(0, len(rows), INDEX_ITEMS)]
    sent = spark.sparkContext.broadcast(shards)

    def leaks(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        indexes = _indexes(sent.value, share)
        for batch in batches:
            found: list[list[dict]] = []
            for texts in text_steps(batch):
                by_index = [index.search(texts) for index in indexes] or [[[] for _ in texts]]
                found += [[hit for hits in parts for hit in hits] for parts in zip(*by_index, strict=True)]
            yield pa.array(found, _HITS)
            give_back()

    return docs.withColumn(into, visit(leaks, f"array<{_HIT}>")(text_of(text)))


def find_leaks(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row per document and test item that it holds: ``doc_id, item_id, score, overlap, ...``."""
    read = docs.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    found = with_leaks(read, items, **options)
    return found.select("doc_id", F.inline("leaks"))


def remove_leaking(docs: DataFrame, items: DataFrame, text: str = "text", **options) -> DataFrame:
    """The documents that hold no test item, with the columns they have; repeated rows stay repeated."""
    into = "_leaks"
    while into in docs.columns:
        into = f"_{into}"
    return with_leaks(docs, items, text, into=into, **options).filter(F.size(into) == 0).drop(into)
