"""Raw documents to token ids: language ID, line dedup, near-dedup, decontamination, SentencePiece.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the one before
kept. All but the last return the columns of ``docs``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm import decontaminate, language, line_dedup, near_dedup, pieces
from orderloom.session import BATCH_BYTES, BATCH_SETTING, shared_dir
from orderloom.sources.tables import written

PIECE_MODEL = "piece_bpe_32k.model"
LINE_SITES = 10
# Phrases per letter from which on a text is of no language that was learnt: hardly two
# letters in a row are known. Running text has 0.3. Short texts say too little to be rejected for it.
MOST_PHRASES, LEAST_CHARS = 0.8, 20


def _small_batches(spark: SparkSession) -> None:
    """Set the session's Arrow batches, which workers of all stages and their executors hold several times over."""
    spark.conf.set(BATCH_SETTING, f"{BATCH_BYTES}b")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled ones are in; no letters, or strange ones, are rejected."""
    _small_batches(spark)
    found = language.identify(docs, language.learn(docs), into="_language")
    known = F.col("_language.lang_pred") != language.UNKNOWN
    strange = (F.col("_language.rate") > MOST_PHRASES) & (F.char_length("text") >= LEAST_CHARS)
    return found.filter(known & ~strange).drop("_language")


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many sources carry; ``n_chars`` follows the text."""
    cleaned = line_dedup.remove_spread_lines(docs, LINE_SITES)
    if "n_chars" in docs.columns:
        cleaned = cleaned.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return cleaned


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of copies and near copies."""
    _small_batches(spark)
    return near_dedup.remove_near_copies(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    _small_batches(spark)
    return decontaminate.remove_leaking(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, lang, source, n_tokens, ids``, and whether decoding gives the text back."""
    _small_batches(spark)
    model = pieces.read_model(public_tokenizers.path(PIECE_MODEL))
    coded = pieces.round_trip(docs, model, carried=["doc_id", "lang", "source"])
    return coded.select(
        "doc_id",
        "lang",
        "source",
        F.size("pieces.ids").cast("long").alias("n_tokens"),
        "pieces.ids",
        F.col("pieces.same").alias("round_trip"),
    )


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination),
    ("sentencepiece", sentencepiece),
]

# Statistical and approximate steps (language, signatures) have no SQL form; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    folder = shared_dir(spark, "corpus-pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"{folder}/{name}")
    return docs
