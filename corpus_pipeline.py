"""From raw documents to packed training sequences, in five stages.

Each stage takes the session, the documents that its predecessor kept and the folder of the source
tables, and returns a DataFrame that is written as Parquet and read again for the next one:

1. ``language_id`` drops documents without a language: null texts and texts without a letter. The
   model learns from all labelled documents among its input, and its prediction replaces ``lang``; where
   no language could be learned, ``lang`` stays as it is.
2. ``line_dedup`` drops lines that recur in at least five documents, but for one holder of each. A
   document of which nothing remains goes.
3. ``near_dedup`` keeps one document of each group of near-duplicates (five words, 0.8), and all without words;
   rows that repeat an id, null among them, are told apart.
4. ``secret_scan`` masks the secrets in the texts and keeps all documents.
5. ``packing`` cuts the documents' tokens into sequences whose lengths are powers of two.

All but the last return the columns of ``documents``, with ``n_chars`` brought up to date.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeweave.llm import language, line_dedup, minhash, packing, secrets
from citeweave.staging import Staging

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _with_text(docs: DataFrame, columns: list[str]) -> DataFrame:
    """The columns of the stage's input, with the length that the text now has."""
    if "n_chars" in columns:
        docs = docs.withColumn("n_chars", F.char_length("text").cast("long"))
    return docs.select(*columns)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = language.train(docs)
    if not model.langs:
        return language.with_letters(docs)
    found = language.predict(docs, model)
    # A label may be called as unknown languages are; only texts without a letter have no language at all.
    return found.where(F.size("languages") > 0).withColumn("lang", F.col("lang_pred")).select(*docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.drop_repeated_lines(docs, Staging(spark, "pipeline-lines"))
    # Only what lost lines can go; a text that came empty is not this stage's business.
    some = cleaned.where((F.col("n_dropped") == 0) | (F.trim("text", F.lit(line_dedup.SPACES)) != ""))
    return _with_text(some, docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.one_per_group(docs, Staging(spark, "pipeline-near"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    staging = Staging(spark, "pipeline-secrets")
    found = secrets.scan_versions(docs, staging.path("ledger"), staging)
    return _with_text(found.withColumn("text", secrets.redact(F.col("text"), F.col("spans"))), docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, Staging(spark, "pipeline-packing"))


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("line_dedup", dedup_lines),
    ("near_dedup", near_dedup),
    ("secret_scan", secret_scan),
    ("packing", pack),
]

# Language inference, MinHash and the tokenizer are beyond SQL; the tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packed pieces of the documents in ``sf_dir``; every stage is written before the next one reads it."""
    staging = Staging(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for at, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            docs = staging.write(docs, name)
    return docs
