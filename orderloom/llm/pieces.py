"""SentencePiece encoding and decoding by a table of distinct marked words."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.llm.chunks import STEP_BYTES, ChunkIds, flattened
from orderloom.llm.common import fresh, list_array, offsets_of, ranges, text_of, visit
from orderloom.llm.words import string_slices, text_steps
from orderloom.llm.worker import give_back, keep

MARK = "▁"
_CHUNK = re.compile(" +[^ ]*")
_CROSSING = re.compile(f"[^{MARK}]{MARK}")


class Pieces:
    """One SentencePiece model in one Python worker."""

    def __init__(self, model: bytes):
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = self.model.get_piece_size()
        pieces = [self.model.id_to_piece(i) for i in range(size)]
        self.splits = self._splits(pieces)
        self.table = ChunkIds(self._encode_chunks)
        plain = [self._surface(i, piece) for i, piece in enumerate(pieces)]
        self.decodes = [surface is not None for surface in plain]
        surfaces = [surface or b"" for surface in plain]
        self._plain = np.array(self.decodes)
        self._lengths = np.array([len(s) for s in surfaces], np.int64)
        self._starts = np.cumsum(self._lengths) - self._lengths
        self._bytes = np.frombuffer(b"".join(surfaces), np.uint8)

    def _splits(self, pieces: list[str]) -> bool:
        """Whether words can be encoded one by one with the same result.

        They can when no piece goes on behind a word into the next marker, and
        when texts are encoded as they are, behind one marker put in front.
        """
        probe = "  a\tb  c "
        kept = self.model.normalize(probe) == MARK + probe.replace(" ", MARK)
        unchanged = all(self.model.normalize(t) == MARK + t for t in ("ﬁ", "Å", "　x", "Ａ"))
        return kept and unchanged and MARK in pieces and not any(map(_CROSSING.search, pieces))

    def _surface(self, i: int, piece: str) -> bytes | None:
        if self.model.is_byte(i):
            return bytes([int(piece[3:5], 16)])
        if self.model.is_control(i) or self.model.is_unknown(i) or self.model.is_unused(i):
            return None
        return piece.replace(MARK, " ").encode()

    def _encode_chunks(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        # The library puts a marker in front of every text, so the first one of a chunk is left out.
        encoded = self.model.encode([chunk[1:] for chunk in chunks], num_threads=1)
        alone = [self.model.piece_to_id(MARK)]
        return flattened([ids if len(chunk) > 1 else alone for chunk, ids in zip(chunks, encoded, strict=True)])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The number of ids of every text, and the ids of all."""
        if self.splits:
            marked = (" " + text.replace(MARK, " ") if text else "" for text in texts)
            return self.table.ids([_CHUNK.findall(text) for text in marked])
        return flattened(self.model.encode(texts, num_threads=1))

    def decode(self, lengths: np.ndarray, ids: np.ndarray) -> list[str]:
        """The text of every document, from the number of its ids and the ids of all."""
        known = (ids >= 0) & (ids < len(self._plain))
        inside = np.where(known, ids, 0)
        plain = self._plain[inside] & known
        sizes = np.where(plain, self._lengths[inside], 0)
        data = self._bytes[ranges(self._starts[inside], sizes)].tobytes()
        ends = offsets_of(lengths)
        odd = offsets_of(~plain)[ends]
        at = offsets_of(sizes)[ends]
        texts = []
        for k in range(len(lengths)):
            text = None
            if self.splits and odd[k] == odd[k + 1]:
                text = _decoded(data[at[k] : at[k + 1]])
            if text is None:
                text = self.model.decode(ids[ends[k] : ends[k + 1]].tolist())
            texts.append(text)
        return texts


def _decoded(data: bytes) -> str | None:
    """The bytes of all pieces as text, without the marker put in front; None if they are no text."""
    try:
        text = data.decode()
    except UnicodeDecodeError:
        return None
    return text[1:] if text.startswith(" ") else text


def _pieces(model: bytes) -> Pieces:
    return keep(("pieces", model), lambda: Pieces(model))


def read_model(path: str) -> bytes:
    """A model file as bytes. Models have a fixed size, so the driver may send them along."""
    with open(path, "rb") as file:
        return file.read()


def encode(docs: DataFrame, model: bytes, text: str = "text", into: str = "ids") -> DataFrame:
    """Add the ids of every whole text, as ``array<int>``, without begin and end ids.

    Equal to the library's own encoding of the text. NULL and the empty text have
    no ids; a column that is already called ``into`` is replaced, all others
    and repeated rows stay as they are; an empty table stays empty.

    Words are cut at their markers, each distinct word is segmented once per
    Python worker, and its ids are put back at every position. A model whose
    pieces may reach over a marker, or that changes texts, encodes whole texts.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        pieces = _pieces(sent.value)
        for batch in batches:
            parts = [list_array(*pieces.encode(texts), pa.int32()) for texts in text_steps(batch, STEP_BYTES)]
            yield _concat(parts, pa.list_(pa.int32()))
            give_back()

    return docs.withColumn(into, visit(ids, "array<int>")(text_of(text)))


def decode(docs: DataFrame, model: bytes, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """Add the text that the ids stand for, as the library decodes them.

    NULL and an empty list give the empty text; an id the model does not have
    fails. A column that is already called ``into`` is replaced.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def decoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        pieces = _pieces(sent.value)
        for batch in batches:
            lengths = np.diff(batch.offsets.to_numpy())
            values = batch.flatten().to_numpy(zero_copy_only=False).astype(np.int32, copy=False)
            ends = offsets_of(lengths)
            parts = [
                pa.array(pieces.decode(lengths[i:j], values[ends[i] : ends[j]]), pa.string())
                for i, j in _id_steps(lengths)
            ]
            yield _concat(parts, pa.string())

    present = F.coalesce(F.col(f"`{ids}`"), F.array().cast("array<int>"))
    return docs.withColumn(into, visit(decoded, "string")(present))


def round_trip(
    docs: DataFrame, model: bytes, text: str = "text", into: str = "pieces", carried: Sequence[str] | None = None
) -> DataFrame:
    """Add a struct ``ids, decoded, same``: what :func:`encode` and, from these ids, :func:`decode` give, and
    whether that is the text. NULL counts as the empty text.

    All is done in one visit to the Python workers, which hand back a few texts at a time. Of the other columns
    those ``carried`` come along, all by default.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    names = [c for c in (docs.columns if carried is None else carried) if c.lower() != into.lower()]
    given = fresh(docs, "_given")
    read = docs.select(*[F.col(f"`{c}`") for c in names], text_of(text).alias(given))
    kind = T.StructType.fromDDL("ids array<int>, decoded string, same boolean")
    schema = T.StructType([*read.schema.fields[:-1], T.StructField(into, kind)])
    arrow = pa.struct([("ids", pa.list_(pa.int32())), ("decoded", pa.string()), ("same", pa.bool_())])

    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(sent.value)
        for batch in batches:
            texts = batch.column(len(names))
            for i, j in string_slices(texts, STEP_BYTES):
                part = texts.slice(i, j - i).to_pylist()
                lengths, ids = pieces.encode(part)
                decoded = pieces.decode(lengths, ids)
                same = pa.array([x == y for x, y in zip(part, decoded, strict=True)], pa.bool_())
                columns = [list_array(lengths, ids, pa.int32()), pa.array(decoded, pa.string()), same]
                found = pa.StructArray.from_arrays(columns, names=["ids", "decoded", "same"]).cast(arrow)
                others = [batch.column(k).slice(i, j - i) for k in range(len(names))]
                yield pa.RecordBatch.from_arrays([*others, found], names=[*names, into])
            give_back()

    return read.mapInArrow(both, schema)


def _concat(parts: list[pa.Array], kind: pa.DataType) -> pa.Array:
    return pa.concat_arrays([part.cast(kind) for part in parts]) if parts else pa.array([], kind)


def _id_steps(lengths: np.ndarray, limit: int = 500_000) -> Iterator[tuple[int, int]]:
    start, size = 0, 0
    for i, n in enumerate(lengths):
        if size and size + n > limit:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(lengths):
        yield start, len(lengths)
