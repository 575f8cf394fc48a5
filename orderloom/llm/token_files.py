"""Token ids of a corpus as one long array in blocks, with Elias-Fano document boundaries.

A token file set is a Parquet folder (Spark commits it whole or not at all, on
any storage). One row is one block: the concatenated ids of consecutive
documents, little-endian, as wide as the vocabulary needs, and two Elias-Fano
sequences, the end of every document and the distance of every ``doc_id`` to the block's first.
Blocks follow each other in ascending ``doc_id`` order by ``(part, block)``.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.llm.chunks import ChunkIds, flattened
from orderloom.llm.common import offsets_of, text_bytes, text_of
from orderloom.llm.eliasfano import EliasFano
from orderloom.llm.words import offsets_in, string_slices
from orderloom.llm.worker import give_back, keep, release
from orderloom.session import files_for, small_batches

# Ids of one block, unless a single document has more.
BLOCK_IDS = 1 << 20
BLOCK_DOCS = 1 << 16

# Distinct words that a worker remembers, some 200 MB with their ids, and bytes of text looked up together.
MOST_WORDS = 1_000_000
STEP_BYTES = 2 << 20

# A chunk starts behind white space, and at a punctuation mark behind a Latin letter: both end a word for sure.
# In UTF-8 the letters À to ÿ are the byte C3 and one of 80 to BF, which other characters end with too.
_BLANKS, _MARKS, _ASCII, _MAYBE = " \t\n\r", ",.;:!?", 1, 2
_START = re.compile(rf"[{_BLANKS}]|[A-Za-zÀ-ÖØ-öø-ÿ][{_MARKS}]")
_BEHIND, _AHEAD = np.zeros(256, np.uint8), np.full(256, _BLANK := 4, np.uint8)
_BEHIND[list(map(ord, _BLANKS))] = _BLANK
_BEHIND[[c for c in range(128) if chr(c).isalpha()]] = _ASCII
_BEHIND[[c for c in range(0x80, 0xC0) if c not in (0x97, 0xB7)]] = _MAYBE
_AHEAD[list(map(ord, _BLANKS))] = 0
_AHEAD[list(map(ord, _MARKS))] |= _ASCII | _MAYBE

_SEQUENCE = T.StructType(
    [
        T.StructField("size", T.IntegerType()),
        T.StructField("top", T.LongType()),
        T.StructField("low_bits", T.IntegerType()),
        T.StructField("low", T.BinaryType()),
        T.StructField("high", T.BinaryType()),
        T.StructField("samples", T.BinaryType()),
    ]
)
BLOCKS = T.StructType(
    [
        T.StructField("part", T.IntegerType()),
        T.StructField("block", T.IntegerType()),
        T.StructField("part_start", T.LongType()),
        T.StructField("n_ids", T.LongType()),
        T.StructField("width", T.IntegerType()),
        T.StructField("ids", T.BinaryType()),
        T.StructField("ends", _SEQUENCE),
        T.StructField("without_id", T.IntegerType()),
        T.StructField("first_id", T.LongType()),
        T.StructField("doc_ids", _SEQUENCE),
    ]
)
_ARROW = pa.schema(
    [
        ("part", pa.int32()),
        ("block", pa.int32()),
        ("part_start", pa.int64()),
        ("n_ids", pa.int64()),
        ("width", pa.int32()),
        ("ids", pa.binary()),
        ("ends", sequence := pa.struct(
            [("size", pa.int32()), ("top", pa.int64()), ("low_bits", pa.int32())]
            + [(name, pa.binary()) for name in ("low", "high", "samples")]
        )),
        ("without_id", pa.int32()),
        ("first_id", pa.int64()),
        ("doc_ids", sequence),
    ]
)


def _chunks(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The chunks of all texts, white space behind them included, and where those of each text start.

    They are views of the bytes of the column, which has no NULLs.
    """
    offsets = offsets_in(texts)
    base, size = int(offsets[0]), int(offsets[-1] - offsets[0])
    buffer = texts.buffers()[2] if len(texts) else None
    if not size or buffer is None:
        return pa.array([], pa.string()), np.zeros(len(texts) + 1, np.int64)
    data = np.frombuffer(buffer, np.uint8)[base : base + size]
    found = np.zeros(size + 1, np.uint8)
    found[1:size] = _BEHIND[data[:-1]] & _AHEAD[data[1:]]
    maybe = np.flatnonzero(found == _MAYBE)
    found[maybe] = data[maybe - 2] == 0xC3
    found[offsets - base] = 1
    starts = np.flatnonzero(found)
    chunks = pa.StringArray.from_buffers(
        len(starts) - 1, pa.py_buffer(starts.astype(np.int32).tobytes()), buffer.slice(base, size)
    )
    return chunks, np.searchsorted(starts, offsets - base)


def _bare(chunks: pa.Array) -> list[str]:
    """Chunks without the white space behind them. None is left inside, so one text of all can be split again."""
    if not len(chunks):
        return []
    words = pc.ascii_rtrim(chunks, _BLANKS)
    whole = pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words)
    return pc.binary_join(whole, " ")[0].as_py().split(" ")


class Words:
    """One tokenizer in one Python worker."""

    def __init__(self, spec: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = tokenizers.Tokenizer.from_str(spec.decode())
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.splits = _word_by_word(spec.decode())
        self._separator = next(
            (
                (i, token.content)
                for i, token in sorted(self.tokenizer.get_added_tokens_decoder().items())
                if token.special and not (token.normalized or token.lstrip or token.rstrip or token.single_word)
            ),
            None,
        )
        self.table = ChunkIds(self._encode_chunks, MOST_WORDS)

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_chunks(self, chunks: list[str], together: int = 64) -> tuple[np.ndarray, np.ndarray]:
        """Ids of every chunk; many go through the library in one call, a special token between them."""
        if self._separator is None:
            return flattened(self._encode(chunks))
        mark, content = self._separator
        lines = [chunks[i : i + together] for i in range(0, len(chunks), together)]
        # The token ends every chunk here, the last of a line too.
        encoded = self._encode([content.join(line) + content for line in lines])
        if any(ids.count(mark) != len(line) for line, ids in zip(lines, encoded, strict=True)):
            # A chunk holds the special token itself.
            return flattened(self._encode(chunks))
        _, flat = flattened(encoded)
        ends = np.flatnonzero(flat == mark)
        return np.diff(ends, prepend=-1) - 1, flat[flat != mark]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The number of ids of every text, and the ids of all."""
        return self.encode_column(pa.array(texts, pa.string()))

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The same for a string column without NULLs; only its distinct chunks become Python strings."""
        if not self.splits:
            return flattened(self._encode(texts.to_pylist()))
        chunks, ends = _chunks(texts)
        coded = chunks.dictionary_encode()
        return self.table.coded_ids(_bare(coded.dictionary), coded.indices.to_numpy(), ends)


# The normalizers and the pattern for which a text may be cut into words as above.
_NORMALIZERS = ["NFC", "Replace", "Lowercase"]
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _word_by_word(spec: str) -> bool:
    """Whether the tokenizer drops white space and treats every word alone."""
    found = json.loads(spec)
    steps_before = (found.get("normalizer") or {}).get("normalizers") or []
    splitters = (found.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
    first = splitters[0]
    return (
        [n["type"] for n in steps_before] == _NORMALIZERS
        and steps_before[1]["pattern"] == {"Regex": r"\s+"}
        and first.get("pattern") == {"Regex": _PATTERN}
        and (first.get("behavior"), first.get("invert")) == ("Removed", True)
        and not any(
            t["lstrip"] or t["rstrip"] or t["single_word"] or _START.search(t["content"]) for t in found["added_tokens"]
        )
        and not found["model"].get("dropout")
    )


def _words(spec: bytes) -> Words:
    return keep(("words", spec), lambda: Words(spec))


def read_spec(path: str) -> bytes:
    """A tokenizer file as bytes. Tokenizers have a fixed size, so the driver may send them along."""
    with open(path, "rb") as file:
        return file.read()


class _Block:
    """The block that is being filled."""

    def __init__(self):
        self.ids: list[np.ndarray] = []
        self.lengths: list[int] = []
        self.keys: list[int | None] = []
        self.size = 0

    def add(self, key: int | None, ids: np.ndarray) -> None:
        self.ids.append(ids)
        self.lengths.append(len(ids))
        self.keys.append(key)
        self.size += len(ids)

    def row(self, part: int, block: int, part_start: int, width: int) -> pa.RecordBatch:
        known = np.array([k for k in self.keys if k is not None], np.int64)
        first = int(known[0]) if len(known) else 0
        distances = known.astype(np.uint64) - np.uint64(first % (1 << 64))
        ids = np.concatenate(self.ids) if self.ids else np.zeros(0, np.int32)
        row = {
            "part": part,
            "block": block,
            "part_start": part_start,
            "n_ids": self.size,
            "width": width,
            "ids": ids.astype(f"<u{width}").tobytes(),
            "ends": EliasFano.of(np.cumsum(self.lengths)).__dict__,
            "without_id": len(self.keys) - len(known),
            "first_id": first,
            "doc_ids": EliasFano.of(distances).__dict__,
        }
        return pa.RecordBatch.from_pylist([row], _ARROW)


def write(docs: DataFrame, folder: str, spec: bytes, end_id: int, key: str = "doc_id", text: str = "text") -> None:
    """Encode every whole text, add ``end_id``, and write the ids by ascending ``key``.

    NULL and empty texts have the end id alone. Rows without a key come first;
    rows of one key, repeated ones too, stay as many documents, in the order of
    a hash of their texts. An empty table gives a folder without blocks.

    The only shuffle sorts the texts by key, with that hash as a second sort
    column, so that a key which holds many rows can be dealt to many tasks.
    Each of its partitions is a part; a task takes several small ones and writes them to one file.
    """
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(spec)
    plain = docs.select(F.col(f"`{key}`").cast("long").alias("key"), text_of(text).alias("text"))
    tied = plain.withColumn("tie", F.xxhash64("text"))
    ordered = tied.repartitionByRange("key", "tie").sortWithinPartitions("key", "tie")
    numbered = ordered.select("key", "text", F.spark_partition_id().alias("part"))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _words(sent.value)
        part, block, done, filling = -1, 0, 0, _Block()
        for batch in batches:
            for found, keys, texts in _of_one_part(batch):
                if found != part:
                    if filling.keys:
                        yield filling.row(part, block, done, words.width)
                    part, block, done, filling = found, 0, 0, _Block()
                lengths, flat = words.encode_column(texts)
                ends = offsets_of(lengths)
                for k, own in enumerate(keys):
                    ids = np.append(flat[ends[k] : ends[k + 1]], np.int32(end_id))
                    if filling.size and (
                        filling.size + len(ids) > BLOCK_IDS or len(filling.keys) >= BLOCK_DOCS
                    ):
                        yield filling.row(part, block, done, words.width)
                        block, done, filling = block + 1, done + filling.size, _Block()
                    filling.add(own, ids)
            give_back()
        if filling.keys:
            yield filling.row(part, block, done, words.width)

    with small_batches(spark):
        few = numbered.coalesce(files_for(text_bytes(plain, "text")))
        few.mapInArrow(blocks, BLOCKS).write.mode("overwrite").parquet(folder)


def _of_one_part(batch: pa.RecordBatch) -> Iterator[tuple[int, list[int | None], pa.Array]]:
    """The part, keys and texts of a few consecutive rows of ``key, text, part`` at a time."""
    parts = batch.column(2).to_numpy()
    bounds = np.flatnonzero(np.diff(parts, prepend=-1, append=-1)).tolist()
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        rows = batch.slice(a, b - a)
        for i, j in string_slices(rows.column(1), STEP_BYTES):
            yield int(parts[a]), rows.column(0).slice(i, j - i).to_pylist(), rows.column(1).slice(i, j - i)


def _sequence(value: dict) -> EliasFano:
    return EliasFano(**value)


def block_documents(row: dict) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """The keys, the boundaries and the ids of one block, as read from its file."""
    distances = _sequence(row["doc_ids"]).values().astype(np.uint64)
    keys = (distances + np.uint64(row["first_id"] % (1 << 64))).astype(np.int64).tolist()
    ends = np.concatenate(([0], _sequence(row["ends"]).values()))
    return [None] * row["without_id"] + keys, ends, np.frombuffer(row["ids"], f"<u{row['width']}")


def read(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document of a token file set: ``doc_id, part, part_offset, ids``."""

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                keys, ends, ids = block_documents(row)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys, pa.int64()),
                        pa.array([row["part"]] * len(keys), pa.int32()),
                        pa.array(ends[:-1] + row["part_start"], pa.int64()),
                        pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids.astype(np.int32))),
                    ],
                    names=["doc_id", "part", "part_offset", "ids"],
                )

    schema = "doc_id long, part int, part_offset long, ids array<int>"
    return spark.read.schema(BLOCKS).parquet(folder).mapInArrow(documents, schema)


def part_starts(spark: SparkSession, folder: str) -> DataFrame:
    """The ids before each part, ``part, before``: a row per writing task, whatever the volume."""
    parts = spark.read.schema(BLOCKS).parquet(folder).groupBy("part").agg(F.sum("n_ids").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return parts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0).cast("long")).alias("before"))


def digests(spark: SparkSession, folder: str) -> DataFrame:
    """Per document of a token file set: ``doc_id, start, n_tokens, ids_crc32``, from its files alone."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            for k in range(len(batch)):
                (row,) = batch.slice(k, 1).to_pylist()
                keys, ends, ids = block_documents(row)
                data = memoryview(ids.astype("<u4").tobytes())
                crcs = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys, pa.int64()),
                        pa.array([row["part"]] * len(keys), pa.int32()),
                        pa.array(ends[:-1] + row["part_start"], pa.int64()),
                        pa.array(np.diff(ends), pa.int64()),
                        pa.array(crcs, pa.int64()),
                    ],
                    names=["doc_id", "part", "offset", "n_tokens", "ids_crc32"],
                )

    schema = "doc_id long, part int, offset long, n_tokens long, ids_crc32 long"
    found = spark.read.schema(BLOCKS).parquet(folder).mapInArrow(summed, schema)
    # One row per writing task, which the number of partitions bounds.
    starts = F.broadcast(part_starts(spark, folder))
    return found.join(starts, "part").select(
        "doc_id", (F.col("before") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32"
    )
