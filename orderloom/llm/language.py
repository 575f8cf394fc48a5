"""Language identification by cross-parsing against suffix automata of labelled text."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm.chunks import STEP_BYTES, ChunkTable
from orderloom.llm.common import text_of, visit
from orderloom.llm.words import text_steps
from orderloom.llm.worker import give_back, keep
from orderloom.operators.lookup import broadcast_if_small

UNKNOWN = "und"

# Letters of labelled text that a model learns from, per language, of all languages
# together, and of a language at least. The sample is bounded so that the automata,
# some 100 MB, fit every Python worker; beyond 160 languages they grow by the least share.
SAMPLE_CHARS = 60_000
TOTAL_CHARS = 16 * SAMPLE_CHARS
LEAST_CHARS = 6_000
SAMPLE_DOCUMENTS = 400

_RUN = re.compile(r"[^\W\d_]+")


class SuffixAutomaton:
    """All substrings of a text. Transitions lie in one table, by state and character."""

    def __init__(self, text: str):
        moves: list[dict[str, int]] = [{}]
        links, lengths, last = [-1], [0], 0
        for char in text:
            state = len(moves)
            moves.append({})
            links.append(0)
            lengths.append(lengths[last] + 1)
            at = last
            while at >= 0 and char not in moves[at]:
                moves[at][char] = state
                at = links[at]
            if at >= 0:
                target = moves[at][char]
                if lengths[at] + 1 == lengths[target]:
                    links[state] = target
                else:
                    copy = len(moves)
                    moves.append(dict(moves[target]))
                    links.append(links[target])
                    lengths.append(lengths[at] + 1)
                    while at >= 0 and moves[at].get(char) == target:
                        moves[at][char] = copy
                        at = links[at]
                    links[target] = links[state] = copy
            last = state
        self.moves = moves

    def phrases(self, text: str) -> int:
        """Into how few pieces a text falls, each the longest that occurs here, or one strange character."""
        moves, count, state = self.moves, 0, 0
        for char in text:
            following = moves[state].get(char)
            if following is None:
                count += 1
                following = moves[0].get(char)
                if following is None:
                    # A strange character is a phrase; if it broke one off, that one counts as well.
                    count += state != 0
                    following = 0
            state = following
        return count + (state != 0)


class Parses(ChunkTable):
    """The number of phrases of every distinct word in each language."""

    def __init__(self, samples: Sequence[tuple[str, str]]):
        super().__init__()
        self.languages = [language for language, _ in samples]
        self._automata = [SuffixAutomaton(sample) for _, sample in samples]
        self._phrases = np.zeros((0, len(self.languages)), np.int32)
        self._letters = np.zeros(0, np.int32)

    def _keep(self, places: np.ndarray) -> None:
        self._phrases, self._letters = self._phrases[places], self._letters[places]

    def _learn(self, words: list[str]) -> None:
        marked = [f" {word} " for word in words]
        rows = [[automaton.phrases(word) for automaton in self._automata] for word in marked]
        letters = [len(word) if any(map(str.isalpha, word)) else 0 for word in words]
        found = np.array(rows, np.int32).reshape(len(words), len(self.languages))
        self._phrases = np.concatenate((self._phrases, found))
        self._letters = np.concatenate((self._letters, np.array(letters, np.int32)))

    def counts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Phrases of every text in each language, and its letters."""
        ends, places = self.places([_RUN.findall(text.lower()) for text in texts])
        real = self._letters[places] > 0
        phrases = np.where(real[:, None], self._phrases[places], 0)
        return _sums(phrases, ends), _sums(self._letters[places][:, None], ends)[:, 0]


def _sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums over the rows between consecutive ends; empty ranges have 0."""
    total = np.zeros((len(ends) - 1, values.shape[1]), np.int64)
    full = np.flatnonzero(np.diff(ends))
    if len(full):
        total[full] = np.add.reduceat(values, ends[full], axis=0, dtype=np.int64)
    return total


def _parses(samples: tuple[tuple[str, str], ...]) -> Parses:
    return keep(("parses", samples), lambda: Parses(samples))


def held_out(key: str = "doc_id") -> Column:
    """Whether a document is kept from the training: crc32 of its key as text leaves 2 when divided by 4."""
    return F.coalesce(F.pmod(F.crc32(F.col(f"`{key}`").cast("string")), F.lit(4)) == 2, F.lit(False))


def learn(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "lang",
    sample_chars: int = SAMPLE_CHARS,
    total_chars: int = TOTAL_CHARS,
) -> tuple[tuple[str, str], ...]:
    """Labelled sample text by language, the most frequent first, ``sample_chars`` characters each at most.

    Every label is learnt. Many of them share ``total_chars``, but have ``LEAST_CHARS`` each.
    Held-out documents, and those without a label, a key or a text, take no
    part. The documents are those with the smallest hashes of their keys, so a
    sample does not depend on the order or the number of files; of each the
    first twentieth of the language's share is taken.
    """
    known = docs.select(
        F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"), F.col(f"`{label}`").cast("string").alias("label")
    ).filter(F.col("label").isNotNull() & F.col("text").isNotNull() & F.col("key").isNotNull() & ~held_out(key="key"))
    counted = known.groupBy("label").agg(F.count("*").alias("n"))
    frequent = counted.orderBy(F.desc("n"), "label").collect()
    if not frequent:
        return ()
    sample_chars = min(sample_chars, max(total_chars // len(frequent), LEAST_CHARS))
    # The share of each label that holds twice the documents wanted; ranks then cut it to the bound.
    shares = docs.sparkSession.createDataFrame(
        [(row["label"], min(1.0, 2 * SAMPLE_DOCUMENTS / row["n"])) for row in frequent], "label string, share double"
    )
    place = F.pmod(F.xxhash64(F.col("key"), F.lit(7)), F.lit(1 << 30)) / float(1 << 30)
    picked = known.withColumn("place", place).join(broadcast_if_small(shares), "label").filter("place < share")
    ranked = picked.withColumn(
        "rank", F.row_number().over(Window.partitionBy("label").orderBy("place", F.xxhash64("text")))
    ).filter(F.col("rank") <= SAMPLE_DOCUMENTS)
    fair = sample_chars // 20
    rows = ranked.select("label", "rank", F.substring("text", 1, fair).alias("text")).collect()
    samples: dict[str, str] = {}
    for row in sorted(rows, key=lambda r: (r["label"], r["rank"])):
        have = samples.get(row["label"], "")
        if len(have) < sample_chars:
            words = " ".join(w for w in _RUN.findall(row["text"].lower()) if any(map(str.isalpha, w)))
            samples[row["label"]] = f"{have}{' ' * (not have)}{words} "[:sample_chars] if words else have
    order = [row["label"] for row in frequent]
    return tuple((label, samples[label]) for label in order if samples.get(label, "").strip())


_RESULT = pa.struct([("lang_pred", pa.string()), ("score", pa.float64()), ("rate", pa.float64())])


def identify(
    docs: DataFrame, samples: tuple[tuple[str, str], ...], text: str = "text", into: str = "language"
) -> DataFrame:
    """Add a struct ``lang_pred, score, rate`` for every whole text, as column ``into`` (replaced if there).

    Words are parsed into the longest phrases that each language's sample
    contains. The language with the fewest phrases per letter wins, of equal
    ones the one with the most labelled documents. ``score`` is the winner's lead, one less the ratio
    of its phrases to the next language's (1 with one language); ``rate`` is its
    phrases per letter. NULL texts, texts without letters and all texts without
    any sample are ``und`` with score 0 and no rate.

    Each distinct word is parsed once per Python worker.
    """
    sent = docs.sparkSession.sparkContext.broadcast(samples)

    def predicted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        parses = _parses(sent.value)
        for batch in batches:
            rows = []
            for texts in text_steps(batch, STEP_BYTES):
                phrases, letters = parses.counts(texts)
                rows += [_best(parses.languages, p, n) for p, n in zip(phrases.tolist(), letters.tolist(), strict=True)]
            yield pa.array(rows, _RESULT)
            give_back()

    return docs.withColumn(into, visit(predicted, "lang_pred string, score double, rate double")(text_of(text)))


def _best(languages: list[str], phrases: list[int], letters: int) -> dict:
    if not letters or not languages:
        return {"lang_pred": UNKNOWN, "score": 0.0, "rate": None}
    order = sorted(range(len(languages)), key=phrases.__getitem__)
    best = phrases[order[0]]
    lead = 1.0 - best / phrases[order[1]] if len(order) > 1 else 1.0
    return {"lang_pred": languages[order[0]], "score": lead, "rate": best / letters}
