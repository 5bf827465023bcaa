"""A corpus from documents to packed sequences, as stages that are each written and read again.

Every stage takes an empty table, a null in any column (a null text is empty and stays null), repeated rows, which it
treats alike, very long texts, which it reads whole, and columns of any name, which all but the last hand on unchanged.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framelens.llm.common import BATCH_KEY, TEXT_ROWS, free_name, stored, text_of
from framelens.llm.mixing import mix, mixing_plan
from framelens.llm.near_copies import drop_near_duplicates
from framelens.llm.packing import pack_documents
from framelens.llm.queries import tokenizer_path
from framelens.llm.repetition import repetition_report
from framelens.llm.secret_scan import redact, scan_secrets


def _few_texts_a_batch(spark: SparkSession) -> None:
    """Has this application's session send fewer rows to Python at a time: rows are whole texts here, and a batch stands
    in the JVM and in Python at once. A smaller setting is left as it is."""
    rows = int(spark.conf.get(BATCH_KEY))
    if not 0 < rows <= TEXT_ROWS:
        spark.conf.set(BATCH_KEY, str(TEXT_ROWS))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the repetition rules reject, those without ten words among them."""
    _few_texts_a_batch(spark)
    report = free_name(docs, "repetition")
    return repetition_report(docs, into=report).where(F.col(report)["kept"]).drop(report)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies (0.8 of their five-word shingles): the smallest id."""
    _few_texts_a_batch(spark)
    return drop_near_duplicates(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every secret in the texts; all documents stay."""
    into = free_name(docs, "secrets")
    found = scan_secrets(docs, into=into)
    clean = found.withColumn("text", F.when(F.col("text").isNotNull(), redact(text_of(), F.col(into)["spans"]))).drop(into)
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Flattens the sources' weights as far as no document repeats more than twice; every document stays."""
    into = free_name(docs, "mix")
    return mix(docs, mixing_plan(docs, max_repeats=2.0), into=into).drop(into)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs all token ids into sequences; a document that the mixture repeats is packed as often."""
    _few_texts_a_batch(spark)
    return pack_documents(docs.select("doc_id", "text"), tokenizer_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("secrets", secrets),
    ("mixing", mixing),
    ("packing", packing),
]

#: Token ids can't be expressed in SQL; the stages are tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
