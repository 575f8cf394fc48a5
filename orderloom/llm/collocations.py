"""Collocations: exact phrase counts in passes, and merge joins of the count streams by first and last words."""

from __future__ import annotations

import string
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm.common import offsets_of, text_of
from orderloom.llm.words import mixed, string_slices, words_of
from orderloom.operators.lookup import broadcast_if_small
from orderloom.operators.numbering import numbered
from orderloom.sources.tables import written

UNKNOWN = "und"

# Bytes of text that are counted together before their phrases leave a task.
STEP_BYTES = 1 << 20

# Bits of a filter for every phrase in it, and of the largest filter: 64 MiB.
FILTER_BITS, MOST_FILTER_BITS = 16, 1 << 29
_BITMAP_BITS = 15

_COUNTS = "lang string, phrase string, f long"

# What ends a piece becomes a line feed, capital letters of A to Z small ones.
_PIECE_ENDS = b".,;:!?\x0b\x0c\r"
_TURNED = np.arange(256, dtype=np.uint8)
_TURNED[[*_PIECE_ENDS]] = 0x0A
_TURNED[[*string.ascii_uppercase.encode()]] = [*string.ascii_lowercase.encode()]
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


@dataclass
class Stream:
    """The words of some texts in order: their strings, the piece and the language each stands in, and a hash of both."""

    words: pa.Array
    pieces: np.ndarray
    langs: np.ndarray
    hashes: np.ndarray


def _hash_of(words: np.ndarray, langs: np.ndarray) -> np.ndarray:
    return mixed(words + mixed(langs + np.uint64(1)))


def _phrase_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of every run of ``size`` words."""
    n = max(len(hashes) - size + 1, 0)
    found = hashes[:n]
    for k in range(1, size):
        found = mixed(found * np.uint64(3) + hashes[k : k + n])
    return found


def _plain(texts: pa.Array) -> pa.Array:
    """The texts with small letters and line feeds where pieces end."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    turned = _TURNED[data]
    ends = (offsets - offsets[0]).astype(np.int32)
    return pa.StringArray.from_buffers(len(texts), pa.py_buffer(ends.tobytes()), pa.py_buffer(turned.tobytes()))


def stream(texts: pa.Array, langs: pa.Array) -> Stream:
    """The words ``[^\\x20\\x09]+`` of the pieces between ``[.,;:!?\\x0A-\\x0D]``, A to Z in small letters."""
    words = words_of(_plain(texts))
    sizes = words.stops - words.starts
    ends = offsets_of(sizes)
    data = words.data[~_BLANK[words.data]]
    strings = pa.StringArray.from_buffers(
        len(sizes), pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(data.tobytes())
    )
    owner = np.repeat(np.arange(len(texts)), np.diff(words.ends))
    # A piece ends with a line feed or with its text.
    breaks = np.cumsum(words.data == 0x0A)
    pieces = (breaks[words.starts] if len(breaks) else np.zeros(0, np.int64)) + owner
    names = langs.dictionary_encode()
    lang_hash = words_of(_marked(names.dictionary)).hashes
    lang = names.indices.to_numpy(zero_copy_only=False)[owner] if len(owner) else np.zeros(0, np.int32)
    hashes = _hash_of(words.hashes, lang_hash[lang]) if len(owner) else words.hashes
    return Stream(strings, pieces, lang, hashes)


def _marked(names: pa.Array) -> pa.Array:
    """One word for every name, whatever it holds."""
    return pa.array([name.encode().hex() + "." for name in names.to_pylist()], pa.string())


class _Filter:
    """Hashes of frequent phrases as bits. It may let others through, never keeps one of them out."""

    def __init__(self, bits: bytes):
        self.bits = np.frombuffer(bits, np.uint8)

    def passing(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes & np.uint64(8 * len(self.bits) - 1)
        return (self.bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _counted(found: Stream, langs: pa.Array, size: int, known: _Filter | None) -> pa.RecordBatch:
    """The phrases of ``size`` words whose shorter parts pass, with the times they stand in these texts."""
    n = max(len(found.words) - size + 1, 0)
    starts = np.flatnonzero(found.pieces[:n] == found.pieces[size - 1 : size - 1 + n])
    if known is not None and len(starts):
        parts = known.passing(_phrase_hashes(found.hashes, size - 1))
        starts = starts[parts[starts] & parts[starts + 1]]
    coded = found.words.dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    width = max(len(coded.dictionary), 1)
    key, firsts, times = found.langs[starts].astype(np.int64), starts, None
    for k in range(size):
        # Numbers of distinct beginnings stay below the number of words, so no key passes 64 bits.
        key = np.unique(key, return_inverse=True)[1] if k else key
        key = key * width + codes[starts + k]
    _, firsts, times = np.unique(key, return_index=True, return_counts=True)
    at = starts[firsts]
    parts = [coded.dictionary.take(pa.array(codes[at + k])) for k in range(size)]
    phrases = pc.binary_join_element_wise(*parts, " ") if size > 1 else parts[0]
    names = langs.dictionary_encode().dictionary.take(pa.array(found.langs[at]))
    batch = [names.cast(pa.string()), phrases.cast(pa.string()), pa.array(times, pa.int64())]
    return pa.RecordBatch.from_arrays(batch, names=["lang", "phrase", "f"])


def _totals(found: Stream, langs: pa.Array) -> pa.RecordBatch:
    """All words of each language, as the count of the empty phrase."""
    names = langs.dictionary_encode().dictionary
    times = np.bincount(found.langs, minlength=len(names))
    empty = pa.array([""] * len(names), pa.string())
    return pa.RecordBatch.from_arrays([names.cast(pa.string()), empty, pa.array(times, pa.int64())], names=["lang", "phrase", "f"])


def _counter(size: int, known: Broadcast | None):
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passing = _Filter(known.value) if known is not None else None
        for batch in batches:
            for i, j in string_slices(batch.column(0), STEP_BYTES):
                langs = batch.column(1).slice(i, j - i)
                found = stream(batch.column(0).slice(i, j - i), langs)
                yield _counted(found, langs, size, passing)
                if size == 1:
                    yield _totals(found, langs)

    return counted


def phrase_counts(docs: DataFrame, size: int, least: int, known: Broadcast | None) -> DataFrame:
    """``lang, phrase, f``: phrases of ``size`` words that occur ``least`` times or more in a language.

    A task combines the phrases of a megabyte of text, and all its own before the shuffle. With ``size`` 1
    the empty phrase stands for all words.
    """
    found = docs.mapInArrow(_counter(size, known), _COUNTS)
    summed = found.groupBy("lang", "phrase").agg(F.sum("f").alias("f"))
    return summed.filter((F.col("f") >= least) | (F.col("phrase") == ""))


def _filter(spark: SparkSession, phrases: DataFrame, size: int) -> Broadcast:
    """Frequent phrases as bits, of 64 MiB at most, for the tasks that count longer ones.

    A phrase is never more frequent than its parts. With more phrases the filter lets more others
    through, which are counted and then found to be rare: results are the same.
    """
    rows = phrases.count()
    width = min(MOST_FILTER_BITS, max(1 << _BITMAP_BITS, 1 << (FILTER_BITS * max(rows, 1) - 1).bit_length()))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(0).dictionary_encode()
            lang_hash = words_of(_marked(names.dictionary)).hashes
            lang = lang_hash[np.repeat(names.indices.to_numpy(zero_copy_only=False), size)]
            hashes = _phrase_hashes_of_rows(_hash_of(words_of(batch.column(1)).hashes, lang), size)
            at = (hashes & np.uint64(width - 1)).astype(np.int64)
            columns = [pa.array(at >> _BITMAP_BITS), pa.array(at & ((1 << _BITMAP_BITS) - 1))]
            yield pa.RecordBatch.from_arrays(columns, names=["bucket", "bit"])

    bits = phrases.select("lang", "phrase").mapInArrow(placed, "bucket long, bit long")
    maps = bits.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits")).collect()
    whole = np.zeros((width >> _BITMAP_BITS, 1 << (_BITMAP_BITS - 3)), np.uint8)
    for row in maps:
        whole[row["bucket"]] = np.frombuffer(row["bits"], np.uint8)
    return spark.sparkContext.broadcast(whole.tobytes())


def _phrase_hashes_of_rows(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of each phrase, from those of its words one after another."""
    by_row = hashes.reshape(-1, size)
    found = by_row[:, 0]
    for k in range(1, size):
        found = mixed(found * np.uint64(3) + by_row[:, k])
    return found


def count_streams(docs: DataFrame, folder: str, least: int, most_words: int) -> list[DataFrame]:
    """The counts of phrases of 1, 2, .. ``most_words`` words that occur ``least`` times, each written to ``folder``.

    One pass over the texts for each length. Every pass counts only phrases whose parts were frequent
    in the pass before.
    """
    spark = docs.sparkSession
    lang = F.coalesce(F.col("`lang`").cast("string"), F.lit(UNKNOWN)).alias("lang")
    plain = docs.select(text_of("text").alias("text"), lang)
    found: list[DataFrame] = []
    known = None
    for size in range(1, most_words + 1):
        counts = phrase_counts(plain, size, least, known)
        found.append(written(counts, f"{folder}/count-{size}"))
        if size < most_words:
            known = _filter(spark, found[-1].filter("phrase != ''"), size)
    return found


def mine(
    docs: DataFrame, folder: str, least: int = 10, most_words: int = 3, top: int = 2000, share: int = 50
) -> DataFrame:
    """The ``top`` collocations of every language: ``lang, rank, phrase, a, l, r, n, score``.

    ``docs`` has ``text`` and ``lang``; a NULL text is empty, a NULL language is ``und``. Candidates are phrases
    of 2 to ``most_words`` words of one piece that occur ``a >= least`` times. Cut in two, the first part occurs
    ``l`` and the rest ``r`` times, and the score is ``a * a / (l * r)`` in whole millionths; the cut of
    the lowest score counts, of equal ones the first. A candidate inside a longer one that occurs at
    least ``share`` percent as often is left out. Ranks go by score, ``a`` and phrase; ``n`` are all words of the
    language. Texts without words and an empty table give no rows; repeated rows count again.

    Counts, cuts and extensions are streams sorted by a phrase: in prefix order the cuts by their first part and longer phrases
    by all but their last word, in suffix order by what remains. Merge joins walk them side by side.
    Streams and counts are written to ``folder``.
    """
    singles, *longer = count_streams(docs, folder, least, most_words)
    totals = singles.filter("phrase = ''").select("lang", F.col("f").alias("n"))
    parts = reduce(DataFrame.unionAll, [singles.filter("phrase != ''"), *longer[:-1]])
    found = reduce(DataFrame.unionAll, longer).select("lang", "phrase", F.col("f").alias("a"))
    words = F.split("phrase", " ", -1)

    def joined(first: object, size: object):
        return F.array_join(F.slice(words, first, size), " ")

    k = F.col("k")
    cuts = found.withColumn("k", F.explode(F.sequence(F.lit(1), F.size(words) - 1)))
    cuts = cuts.select("*", joined(1, k).alias("left"), joined(k + 1, F.size(words) - k).alias("right"))
    prefix = parts.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    suffix = parts.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))
    both = cuts.join(prefix.hint("merge"), ["lang", "left"]).join(suffix.hint("merge"), ["lang", "right"])
    # Products of counts need up to 38 digits.
    a, left, right = (F.col(c).cast("decimal(20,0)") for c in ("a", "l", "r"))
    exact = both.withColumns({"above": a * a * F.lit(1_000_000), "below": left * right})
    scored = exact.withColumn("score", F.expr("above div below"))
    best = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    size = F.size(words)
    grown = reduce(DataFrame.unionAll, longer[1:], found.limit(0).select("lang", "phrase", F.col("a").alias("f")))
    ends = grown.select("lang", "f", F.explode(F.array(joined(1, size - 1), joined(2, size - 1))).alias("phrase"))
    extended = ends.groupBy("lang", "phrase").agg(F.max("f").alias("longest"))
    alone = best.join(extended.hint("merge"), ["lang", "phrase"], "left")
    inside = F.col("longest").cast("decimal(20,0)") * 100 >= F.col("a").cast("decimal(20,0)") * share
    kept = alone.filter(~F.coalesce(inside, F.lit(False))).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")

    order = ["lang", F.col("score").desc(), F.col("a").desc(), "phrase"]
    placed = numbered(kept, order, f"{folder}/ranked", "place")
    firsts = placed.groupBy("lang").agg(F.min("place").alias("first")).join(totals, "lang")
    ranked = placed.join(broadcast_if_small(firsts), "lang").withColumn("rank", F.col("place") - F.col("first") + 1)
    return ranked.filter(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def oracle_sql(least: int = 10, top: int = 2000, share: int = 50) -> str:
    """Phrases of 2 to 3 words of ``documents``."""
    capital, small = string.ascii_uppercase, string.ascii_lowercase
    return f"""
WITH pieces AS (
    SELECT coalesce(lang, '{UNKNOWN}') AS lang,
        unnest(string_split_regex(translate(coalesce(text, ''), '{capital}', '{small}'), '[.,;:!?\\x0A-\\x0D]')) AS piece
    FROM documents
), words AS (
    SELECT lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda w: w <> '') AS w FROM pieces
), totals AS (
    SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang
), starts AS (
    SELECT lang, w, unnest(generate_series(1, len(w))) AS i FROM words
), phrases AS (
    SELECT lang, size, array_to_string(w[i : i + size - 1], ' ') AS phrase, count(*) AS f
    FROM starts, (SELECT unnest([1, 2, 3]) AS size) WHERE i + size - 1 <= len(w) GROUP BY ALL HAVING count(*) >= {least}
), cuts AS (
    SELECT lang, size, phrase, f AS a, k, array_to_string(string_split(phrase, ' ')[1 : k], ' ') AS head,
        array_to_string(string_split(phrase, ' ')[k + 1 :], ' ') AS tail
    FROM phrases, (SELECT unnest([1, 2]) AS k) WHERE k < size
), scored AS (
    SELECT c.lang, c.size, c.phrase, c.a, c.k, l.f AS l, r.f AS r,
        CAST((1000000::HUGEINT * c.a * c.a) // (l.f::HUGEINT * r.f) AS BIGINT) AS score
    FROM cuts c JOIN phrases l ON l.lang = c.lang AND l.phrase = c.head JOIN phrases r ON r.lang = c.lang AND r.phrase = c.tail
), best AS (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), longer AS (
    SELECT lang, array_to_string(string_split(phrase, ' ')[1 : 2], ' ') AS phrase, f FROM phrases WHERE size = 3
    UNION ALL
    SELECT lang, array_to_string(string_split(phrase, ' ')[2 : 3], ' '), f FROM phrases WHERE size = 3
), kept AS (
    SELECT * FROM best b WHERE size = 3
        OR NOT EXISTS (SELECT 1 FROM longer g WHERE g.lang = b.lang AND g.phrase = b.phrase AND 100 * g.f >= {share} * b.a)
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= {top}
"""
