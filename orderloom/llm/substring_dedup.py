"""Substring dedup: word sequences that occurred before are removed.

The reference is the corpus itself, too large to be sent anywhere whole. So
window hashes first tell which stretches of which documents can be repeats,
and of what. Only the stretches they repeat become reference shards; each is a
suffix automaton, and the candidates are streamed through it for matching
statistics, which compare words and not hashes.

Order is judged by ``doc``, the key. Texts may share one, so what is found
belongs to ``doc`` and ``mark``, a hash of the text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import fresh, ranges, text_bytes, text_of, visit
from orderloom.llm.suffix import WordAutomaton, covered
from orderloom.llm.words import Words, kept_texts, stretches, string_slices, window_owners, windows, words_of
from orderloom.llm.worker import give_back
from orderloom.operators.lookup import BROADCAST_LIMIT, broadcast_if_small
from orderloom.session import files_for, shared_dir, small_batches
from orderloom.sources.tables import written

WINDOW = 20
# Windows go to the bucket of the smallest of their runs of so many words, so neighbours mostly go together.
ANCHOR = 8
# Text whose windows one bucket holds on average, words of one reference shard, words streamed through a copy of it.
BUCKET_BYTES = 4 << 20
SHARD_WORDS = 50_000
STREAM_WORDS = 300_000
LEAST_BUCKETS = 256
# Stands for a missing key: behind all others.
LAST = (1 << 63) - 1

_PACKED = "bucket long, docs binary, marks binary, places binary, sizes binary, hashes binary"
_PIECE = "doc long, mark long, place int, size int, ref_doc long, ref_mark long, ref_place int"


def _anchors(words: Words, n: int, window: int, anchor: int) -> tuple[np.ndarray, np.ndarray]:
    """For each of ``n`` windows, where its smallest run of ``anchor`` words starts, and that run's hash."""
    runs = windows(words.hashes, anchor)
    width = window - anchor + 1
    least = np.arange(n)
    best = runs[:n].copy()
    for k in range(1, width):
        other = runs[k : k + n]
        smaller = other < best
        best[smaller] = other[smaller]
        least[smaller] = np.flatnonzero(smaller) + k
    return least, best


def _merged(columns: list[np.ndarray]) -> list[np.ndarray]:
    """Pieces ``doc, mark, place, size, ref_doc, ref_mark, ref_place``, joined where one goes on where another ends.

    Pieces come in ascending order of document, mark and place.
    """
    doc, mark, place, size, ref_doc, ref_mark, ref_place = columns
    if not len(doc):
        return columns
    going_on = (
        (doc[1:] == doc[:-1])
        & (mark[1:] == mark[:-1])
        & (place[1:] == place[:-1] + size[:-1])
        & (ref_doc[1:] == ref_doc[:-1])
        & (ref_mark[1:] == ref_mark[:-1])
        & (ref_place[1:] - place[1:] == ref_place[:-1] - place[:-1])
    )
    heads = np.flatnonzero(np.concatenate(([True], ~going_on)))
    sizes = np.add.reduceat(size, heads)
    return [doc[heads], mark[heads], place[heads], sizes, ref_doc[heads], ref_mark[heads], ref_place[heads]]


def _repeats(
    hashes: np.ndarray, doc: np.ndarray, mark: np.ndarray, place: np.ndarray
) -> tuple[list[np.ndarray], np.ndarray]:
    """Pieces that repeat the first window of their hash, and which windows are no repeats."""
    order = np.argsort(hashes)
    ordered = hashes[order]
    same = ordered[1:] == ordered[:-1]
    several = np.zeros(len(order), bool)
    several[1:] |= same
    several[:-1] |= same
    some = order[several]
    some = some[np.lexsort((mark[some], place[some], doc[some], hashes[some]))]
    head = np.ones(len(some), bool)
    head[1:] = hashes[some][1:] != hashes[some][:-1]
    first = some[head][np.cumsum(head) - 1] if len(some) else some
    # The first window and others at the very same place, of rows that share a key, are no repeats.
    later = (doc[some] != doc[first]) | (place[some] != place[first])
    some, first = some[later], first[later]
    back = np.lexsort((place[some], mark[some], doc[some]))
    some, first = some[back], first[back]
    fresh_ = np.ones(len(hashes), bool)
    fresh_[some] = False
    pieces = [doc[some], mark[some], place[some], np.ones(len(some), np.int64), doc[first], mark[first], place[first]]
    return _merged(pieces), fresh_


def _packer(window: int, anchor: int, buckets: int):
    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j in string_slices(batch.column(2)):
                ids, marks = (batch.column(c).slice(i, j - i).to_numpy(zero_copy_only=False) for c in range(2))
                yield from _packed(ids, marks, words_of(batch.column(2).slice(i, j - i)), window, anchor, buckets)
            give_back()

    return packed


def _packed(
    ids: np.ndarray, marks: np.ndarray, words: Words, window: int, anchor: int, buckets: int
) -> Iterator[pa.RecordBatch]:
    """One row per bucket with windows of these texts, and one without a bucket for their own repeats.

    A window that occurs in several of these texts is sent once, so a passage that everybody has is one
    entry per step and not one per document.
    """
    hashes = windows(words.hashes, window)
    owner, inside = window_owners(words.ends, window, len(hashes))
    least, smallest = _anchors(words, len(hashes), window, anchor)
    at = np.flatnonzero(inside)
    owner, least, smallest, hashes = owner[at], least[at], smallest[at], hashes[at]
    doc, mark, place = ids[owner], marks[owner], at - words.ends[owner]
    pieces, new = _repeats(hashes, doc, mark, place)
    if len(pieces[0]):
        # Repeats among these texts pass through the buckets' tasks as they are.
        data = [column.astype("<i8").tobytes() for column in pieces]
        yield _row(-1 - int(pieces[0][0] % buckets), *data[:4], b"".join(data[4:]))
    at, doc, mark, place, owner, least, smallest, hashes = (
        column[new] for column in (at, doc, mark, place, owner, least, smallest, hashes)
    )
    if not len(at):
        return
    # Neighbours of one text with one anchor are a run.
    head = np.ones(len(at), bool)
    head[1:] = (at[1:] != at[:-1] + 1) | (owner[1:] != owner[:-1]) | (least[1:] != least[:-1])
    heads = np.flatnonzero(head)
    sizes = np.diff(np.append(heads, len(at)))
    bucket = (smallest[heads] % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    bounds = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=-2))
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        runs = order[a:b]
        places = ranges(heads[runs], sizes[runs])
        yield _row(
            int(bucket[runs[0]]),
            doc[heads[runs]].astype("<i8").tobytes(),
            mark[heads[runs]].astype("<i8").tobytes(),
            place[heads[runs]].astype("<i4").tobytes(),
            sizes[runs].astype("u1").tobytes(),
            hashes[places].astype("<u8").tobytes(),
        )


def _row(bucket: int, docs: bytes, marks: bytes, places: bytes, sizes: bytes, hashes: bytes) -> pa.RecordBatch:
    values = [[bucket], [docs], [marks], [places], [sizes], [hashes]]
    kinds = [pa.int64()] + [pa.binary()] * 5
    return pa.RecordBatch.from_arrays(
        [pa.array(v, k) for v, k in zip(values, kinds, strict=True)],
        names=["bucket", "docs", "marks", "places", "sizes", "hashes"],
    )


def _pieces(columns: list[np.ndarray]) -> pa.Table:
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32()]
    names = ["doc", "mark", "place", "size", "ref_doc", "ref_mark", "ref_place"]
    return pa.table({n: pa.array(c.astype(np.int64)).cast(k) for n, c, k in zip(names, columns, kinds, strict=True)})


def _bucket_pieces(group: pa.Table) -> pa.Table:
    """The repeats among all windows of one bucket, or those that were found before."""
    rows = group.to_pylist()
    if rows[0]["bucket"] < 0:
        return pa.concat_tables(_own_pieces(row) for row in rows)
    doc, mark = (np.concatenate([np.frombuffer(r[name], "<i8") for r in rows]) for name in ("docs", "marks"))
    place = np.concatenate([np.frombuffer(r["places"], "<i4") for r in rows]).astype(np.int64)
    sizes = np.concatenate([np.frombuffer(r["sizes"], "u1") for r in rows]).astype(np.int64)
    hashes = np.concatenate([np.frombuffer(r["hashes"], "<u8") for r in rows])
    pieces, _ = _repeats(hashes, np.repeat(doc, sizes), np.repeat(mark, sizes), ranges(place, sizes))
    return _pieces(pieces)


def _own_pieces(row: dict) -> pa.Table:
    refs = np.frombuffer(row["hashes"], "<i8")
    columns = [np.frombuffer(row[name], "<i8") for name in ("docs", "marks", "places", "sizes")]
    return _pieces([*columns, *refs.reshape(3, -1)])


def repeated_pieces(
    docs: DataFrame,
    window: int = WINDOW,
    anchor: int = ANCHOR,
    folder: str | None = None,
    size: int | None = None,
) -> DataFrame:
    """``doc, mark, place, size, ref_doc, ref_mark, ref_place``: runs of windows whose hashes occur before.

    ``docs`` has ``doc, mark, text``. ``size`` windows from word ``place`` on look like those of
    ``ref_doc`` from word ``ref_place`` on, the first of their hashes in the order of document and place.
    The argument ``size`` is the bytes of all texts, if they are known.
    """
    spark = docs.sparkSession
    folder = folder or shared_dir(spark, "repeats")
    size = text_bytes(docs, "text") if size is None else size
    buckets = max(LEAST_BUCKETS, -(-size // BUCKET_BYTES))
    sent = docs.select("doc", "mark", "text").mapInArrow(_packer(window, min(anchor, window), buckets), _PACKED)
    found = sent.groupBy("bucket").applyInArrow(_bucket_pieces, _PIECE)
    return written(found.coalesce(files_for(size)), f"{folder}/pieces")


def _stretches(window: int):
    """For documents with pieces: the merged pieces with the words they cover."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j in string_slices(batch.column(2)):
                yield _cut(batch.slice(i, j - i), window)
            give_back()

    return found


def _cut(batch: pa.RecordBatch, window: int) -> pa.RecordBatch:
    docs, marks = (batch.column(c).to_numpy(zero_copy_only=False) for c in range(2))
    words = words_of(batch.column(2), hashed=False)
    counts = np.diff(batch.column(3).offsets.to_numpy()).astype(np.int64)
    row = np.repeat(np.arange(len(docs)), counts)
    place, size, ref_doc, ref_mark, ref_place = (
        batch.column(c).flatten().to_numpy(zero_copy_only=False).astype(np.int64) for c in range(3, 8)
    )
    order = np.lexsort((place, row))
    row, place, size, ref_doc, ref_mark, ref_place = (
        column[order] for column in (row, place, size, ref_doc, ref_mark, ref_place)
    )
    row, _, place, size, ref_doc, ref_mark, ref_place = _merged([row, row, place, size, ref_doc, ref_mark, ref_place])
    # A stretch ends with its text.
    first = words.ends[row] + place
    last = np.minimum(first + size + window - 1, words.ends[row + 1])
    first = np.minimum(first, last)
    columns = [docs[row], marks[row], place, ref_doc, ref_mark, ref_place, size]
    arrays = [pa.array(c.astype(np.int64)).cast(k.type) for c, k in zip(columns, _STRETCH, strict=False)]
    return pa.RecordBatch.from_arrays([*arrays, stretches(words, first, last)], schema=_STRETCH)


_STRETCH = pa.schema(
    [
        ("doc", pa.int64()),
        ("mark", pa.int64()),
        ("place", pa.int32()),
        ("ref_doc", pa.int64()),
        ("ref_mark", pa.int64()),
        ("ref_place", pa.int32()),
        ("size", pa.int32()),
        ("words", pa.string()),
    ]
)
_SPAN = pa.schema([("doc", pa.int64()), ("mark", pa.int64()), ("start", pa.int32()), ("stop", pa.int32())])


def _streamed(window: int):
    """Stream a shard's candidates through the automaton of its references."""

    def spans(references: pa.Table, candidates: pa.Table) -> pa.Table:
        ids: dict[str, int] = {}
        numbered = lambda text: [ids.setdefault(word, len(ids)) for word in text.split(" ")]
        automaton = WordAutomaton(numbered(text) for text in references.column("words").to_pylist())
        docs, marks, starts, stops = [], [], [], []
        columns = (candidates.column(name).to_pylist() for name in ("doc", "mark", "place", "words"))
        for doc, mark, place, text in zip(*columns, strict=True):
            hit = covered(automaton.matches(numbered(text)), window).astype(np.int8)
            edges = np.flatnonzero(np.diff(hit, prepend=0, append=0))
            docs += [doc] * (len(edges) // 2)
            marks += [mark] * (len(edges) // 2)
            starts += (place + edges[::2]).tolist()
            stops += (place + edges[1::2]).tolist()
        columns = [docs, marks, starts, stops]
        return pa.table([pa.array(c, k.type) for c, k in zip(columns, _SPAN, strict=True)], schema=_SPAN)

    return spans


def repeated_spans(
    docs: DataFrame, window: int = WINDOW, limit_bytes: int = BROADCAST_LIMIT, size: int | None = None
) -> DataFrame:
    """``doc, mark, start, stop``: stretches of words that windows with an earlier start elsewhere cover.

    ``docs`` has ``doc, mark, text``; ``size`` is the bytes of all texts, if they are known.
    """
    spark = docs.sparkSession
    folder = shared_dir(spark, "substrings")
    size = text_bytes(docs, "text") if size is None else size
    files = files_for(size)
    pieces = repeated_pieces(docs, window, folder=folder, size=size)
    # Of the pieces of repeated rows one is left at each place, the longest, so a list is bounded by its text's words.
    single = pieces.groupBy("doc", "mark", "place").agg(
        F.max(F.struct("size", "ref_doc", "ref_mark", "ref_place")).alias("piece")
    )
    listed = single.select("doc", "mark", "place", "piece.*").groupBy("doc", "mark").agg(
        *[F.collect_list(name).alias(name) for name in ("place", "size", "ref_doc", "ref_mark", "ref_place")]
    )
    holders = broadcast_if_small(pieces.select("doc", "mark").distinct(), limit_bytes)
    texts = docs.select("doc", "mark", "text").join(holders, ["doc", "mark"], "left_semi")
    schema = (
        "doc long, mark long, place int, ref_doc long, ref_mark long, ref_place int, size int, words string"
    )
    cut = texts.join(listed, ["doc", "mark"]).mapInArrow(_stretches(window), schema)
    found = written(cut.coalesce(files), f"{folder}/candidates")

    extents = found.groupBy("ref_doc", "ref_mark").agg(
        F.min("ref_place").alias("first"), F.max(F.col("ref_place") + F.col("size") + (window - 1)).alias("last")
    )
    extents = written(extents.coalesce(files), f"{folder}/extents")
    wanted = broadcast_if_small(extents, limit_bytes)
    total = extents.agg(F.coalesce(F.sum(F.col("last") - F.col("first")), F.lit(0))).first()[0]
    shards = max(1, -(-total // SHARD_WORDS))
    shard = F.pmod(F.xxhash64("ref_doc", "ref_mark"), F.lit(shards).cast("long")).alias("shard")
    cut = docs.select(F.col("doc").alias("ref_doc"), F.col("mark").alias("ref_mark"), "text").join(
        wanted, ["ref_doc", "ref_mark"]
    )
    references = cut.select(shard, _cut_words(F.col("text"), F.col("first"), F.col("last")).alias("words"))
    candidates = found.select(shard, "doc", "mark", "place", "size", "words")
    # A shard that many documents repeat is copied, and its candidates are dealt to the copies.
    loads = candidates.groupBy("shard").agg(F.sum(F.col("size").cast("long") + (window - 1)).alias("load"))
    copies = loads.select("shard", F.ceil(F.col("load") / STREAM_WORDS).alias("copies"))
    copies = written(copies.coalesce(files), f"{folder}/copies")
    # A row per shard, so as many as the references have words divided by the size of a shard.
    copies = broadcast_if_small(copies, limit_bytes)
    dealt = candidates.join(copies, "shard").withColumn(
        "part", F.pmod(F.xxhash64("doc", "mark", "place", "words"), F.col("copies"))
    )
    copied = references.join(copies, "shard").withColumn(
        "part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1))
    )
    grouped = copied.select("shard", "part", "words").groupBy("shard", "part")
    streamed = grouped.cogroup(dealt.select("shard", "part", "doc", "mark", "place", "words").groupBy("shard", "part"))
    return streamed.applyInArrow(_streamed(window), "doc long, mark long, start int, stop int")


def _cut_words(text: Column, first: Column, last: Column) -> Column:
    def cut(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, firsts, lasts in batches:
            parts = []
            for i, j in string_slices(texts):
                words = words_of(texts.slice(i, j - i), hashed=False)
                start, stop = (
                    words.ends[:-1] + c.slice(i, j - i).to_numpy(zero_copy_only=False) for c in (firsts, lasts)
                )
                stop = np.minimum(stop, words.ends[1:])
                parts.append(stretches(words, np.minimum(start, stop), stop))
            yield pa.concat_arrays(parts) if parts else pa.array([], pa.string())

    return visit(cut, "string")(text, first, last)


def _without(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for texts, spans in batches:
        kept, counts, removed = [], [], []
        for i, j in string_slices(texts):
            words = words_of(texts.slice(i, j - i), hashed=False)
            keep = np.ones(len(words.starts), bool)
            for k, listed in enumerate(spans.slice(i, j - i).to_pylist()):
                if listed:
                    base, n = int(words.ends[k]), int(words.ends[k + 1] - words.ends[k])
                    for start, stop in np.frombuffer(listed, ">i4").reshape(-1, 2).tolist():
                        keep[base + start : base + min(stop, n)] = False
            kept.append(kept_texts(words, keep))
            counts.append(np.diff(words.ends))
            left = np.concatenate(([0], np.cumsum(keep)))[words.ends]
            removed.append(np.diff(words.ends) - np.diff(left))
        yield pa.StructArray.from_arrays(
            [
                pa.concat_arrays(kept) if kept else pa.array([], pa.string()),
                pa.array(np.concatenate([np.zeros(0, np.int64), *counts])),
                pa.array(np.concatenate([np.zeros(0, np.int64), *removed])),
            ],
            names=["text", "n_words", "n_removed"],
        )


def _listed_spans(read: DataFrame, window: int, limit_bytes: int, size: int) -> DataFrame:
    """``doc, mark, spans``: start and stop of all spans of a text as bytes, so that their size can be measured."""
    spans = repeated_spans(read, window, limit_bytes, size)
    span = F.concat(*[F.unhex(F.lpad(F.hex(c), 8, "0")) for c in ("start", "stop")])
    listed = spans.groupBy("doc", "mark").agg(F.collect_set(span).alias("spans")).select(
        "doc", "mark", F.concat_ws("", F.transform("spans", F.hex)).alias("spans")
    )
    listed = listed.select("doc", "mark", F.unhex("spans").alias("spans")).coalesce(files_for(size))
    return written(listed, shared_dir(read.sparkSession, "spans"))


def remove_repeats(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    limit_bytes: int = BROADCAST_LIMIT,
) -> DataFrame:
    """``docs`` with the words left in ``text``, joined by one space, and ``n_words`` and ``n_removed`` added.

    A word is removed when it lies in a window of ``window`` words of its
    document whose words also start earlier in the same order: in a document of
    a smaller key, or in the same document before. Windows are judged on the
    input. NULL and empty texts have no words, and NULL becomes the empty text.
    A NULL key comes after all others. Rows that share a key start at the same
    places, so neither repeats the other there; each loses only what its own text repeats. The added columns have more
    underscores where ``docs`` has columns of these names; an empty table stays empty.
    """
    read = docs.select(
        F.coalesce(F.col(f"`{key}`").cast("long"), F.lit(LAST)).alias("doc"),
        F.xxhash64(text_of(text)).alias("mark"),
        text_of(text).alias("text"),
    )
    size = text_bytes(read, "text")
    with small_batches(docs.sparkSession):
        listed = broadcast_if_small(_listed_spans(read, window, limit_bytes, size), limit_bytes)
    n_words, n_removed = fresh(docs, "n_words"), fresh(docs, "n_removed")
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.coalesce(F.col(f"`{key}`").cast("long"), F.lit(LAST)).alias("doc"),
        F.xxhash64(text_of(text)).alias("mark"),
    ).join(listed, ["doc", "mark"], "left")
    whole = F.coalesce(F.col("row").getField(text).cast("string"), F.lit(""))
    left = rows.withColumn(
        "left", visit(_without, "struct<text:string,n_words:long,n_removed:long>")(whole, F.col("spans"))
    )
    own = [F.col("left.text").alias(c) if c == text else F.col("row").getField(c).alias(c) for c in docs.columns]
    return left.select(*own, F.col("left.n_words").alias(n_words), F.col("left.n_removed").alias(n_removed))
