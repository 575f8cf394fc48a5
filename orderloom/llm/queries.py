"""The registered queries of this subpackage, each an operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm import (
    collocations,
    decontaminate,
    exact_dedup,
    html_extract,
    language,
    line_dedup,
    merkle,
    near_dedup,
    pieces,
    substring_dedup,
    token_files,
    topk,
    url_filter,
)
from orderloom.llm.url_filter import ALLOW, BLOCK, Rule
from orderloom.session import shared_dir

PIECE_MODEL = "piece_bpe_32k.model"
WORD_MODEL = "word_bpe_49k.json"
END_ID = 2

URL_RULES = [
    Rule(ALLOW, "com"),
    Rule(BLOCK, "example.com", "/en/"),
    Rule(ALLOW, "www.example.com", "/en/"),
    Rule(BLOCK, "net", "/es/"),
    Rule(BLOCK, "net", "/fr/"),
]

# Sites from which on a line counts as boilerplate.
LINE_SITES = 10

# The search takes every so many ids as queries, and returns so many rows for each.
QUERY_EVERY, NEAREST = 100, 10


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = pieces.read_model(public_tokenizers.path(PIECE_MODEL))
    coded = pieces.round_trip(table(spark, sf_dir, "documents"), model, carried=["doc_id"])
    coded = coded.select("doc_id", "pieces.ids", "pieces.decoded")
    joined = F.array_join(F.col("ids").cast("array<string>"), ",")
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(joined, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_dir(spark, "token-files")
    spec = token_files.read_spec(public_tokenizers.path(WORD_MODEL))
    token_files.write(table(spark, sf_dir, "documents"), folder, spec, END_ID)
    return token_files.digests(spark, folder)


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = substring_dedup.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return left.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.find_groups(table(spark, sf_dir, "documents"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = url_filter.train(url_filter.labelled_urls(spark))
    judged = url_filter.judge(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES, model)
    return judged.select("page_id", "host", "path", "rule", "verdict", "score")


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = line_dedup.line_report(table(spark, sf_dir, "documents"), LINE_SITES)
    kept = F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    return report.select("doc_id", "n_lines", "n_removed", kept)


def op9_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language.identify(docs.select("doc_id", "text"), language.learn(docs))
    return found.select("doc_id", language.held_out().alias("held_out"), "language.lang_pred", "language.score")


def op11_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.quantised(table(spark, sf_dir, "embeddings"))
    return topk.search(vectors, F.col("id") % QUERY_EVERY == 0, NEAREST, shared_dir(spark, "top-k"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_dir(spark, "merkle")
    manifest = merkle.build(merkle.document_rows(table(spark, sf_dir, "documents")), folder)
    found = merkle.proofs(manifest, folder)
    siblings = F.array_join(F.transform("proof", lambda step: F.substring(step, 2, 64)), "")
    return found.select(
        F.col("id").alias("doc_id"),
        "leaf",
        "subroot",
        "root",
        F.sha2(siblings, 256).alias("proof_sha256"),
        F.col("folded").alias("folded_root"),
        (F.col("folded") == F.col("root")).alias("verified"),
    )


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents"), shared_dir(spark, "collocations"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_sentencepiece": op1_sentencepiece,
        "op2_substring_dedup": op2_substring_dedup,
        "op3_near_dedup": op3_near_dedup,
        "op4_exact_dedup": op4_exact_dedup,
        "op5_url_filter": op5_url_filter,
        "op6_decontaminate": op6_decontaminate,
        "op7_line_dedup": op7_line_dedup,
        "op8_token_files": op8_token_files,
        "op9_html_extract": op9_html_extract,
        "op10_language": op10_language,
        "op11_exact_top_k": op11_exact_top_k,
        "op12_merkle_manifest": op12_merkle_manifest,
        "op13_collocations": op13_collocations,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op4_exact_dedup": exact_dedup.ORACLE_SQL,
        "op7_line_dedup": line_dedup.oracle_sql(LINE_SITES),
        "op11_exact_top_k": topk.oracle_sql(QUERY_EVERY, NEAREST),
        "op12_merkle_manifest": merkle.ORACLE_SQL,
        "op13_collocations": collocations.oracle_sql(),
    }
