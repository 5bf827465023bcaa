"""The registered queries of the corpus operators: whole tables, production parameters, full results."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .fingerprints import digest, edited_fingerprints
from .language_id import identify_languages
from .mixing import mix, mixing_plan
from .oracle import ORACLE_SQL
from .packing import pack_documents
from .quality_model import fit_quality_model, held_out, score_quality
from .repetition import repetition_report
from .secret_scan import scan_secrets, span_text
from .simhash import near_duplicate_components
from .substring_dedup import remove_repeated_windows
from .token_files import read_token_files, write_token_files

__all__ = ["ORACLE_SQL", "QUERIES"]

TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path() -> str:
    return public_tokenizers.path(TOKENIZER)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = edited_fingerprints(documents(spark, sf_dir))
    return found.select(
        "doc_id",
        "n_chars",
        F.col("edited_text_sha256").alias("edited_sha256"),
        digest(F.col("lanes")).alias("fingerprint"),
        digest(F.col("edited_lanes")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir).select("doc_id", "text"), tokenizer_path())


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = fit_quality_model(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score_quality(docs, model, carry=["doc_id"]).select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(documents(spark, sf_dir).select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("secrets.base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *[count(k) for k in ("assign", "access", "hex")], F.sha2(span_text(F.col("secrets.base")), 256).alias("base_sha256"), span_text(F.col("secrets.spans")).alias("spans"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = write_token_files(documents(spark, sf_dir), tokenizer_path())
    return read_token_files(manifest).select("doc_id", "start", "n_tokens", "ids_crc32")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    mixed = mix(docs, mixing_plan(docs, max_repeats=4.0))
    return mixed.select("doc_id", "source", *[f"mix.{c}" for c in ("epoch", "block", "block_key", "tokens", "weight", "repeats")])


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicate_components(documents(spark, sf_dir))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeated_windows(documents(spark, sf_dir))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = identify_languages(spark.read.parquet(f"{sf_dir}/pages.parquet"), documents(spark, sf_dir))
    return found.select("page_id", "host", "suffix", "declared", "text_lang", "lang", "probability")


def op10_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repetition_report(documents(spark, sf_dir), carry=["doc_id"])
    return found.select("doc_id", *[f"repetition.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "covered_chars")])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_fingerprints": op1_fingerprints,
    "op2_packing": op2_packing,
    "op3_quality": op3_quality,
    "op4_secrets": op4_secrets,
    "op5_token_files": op5_token_files,
    "op6_mixing": op6_mixing,
    "op7_simhash": op7_simhash,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_language_id": op9_language_id,
    "op10_repetition": op10_repetition,
}
