"""Token counts through a cache of content digests.

A text is known by the SHA-256 of its normalised content and a tokenizer by the SHA-256 of its file
and options. Counts stored under both are looked up; of the texts that the cache lacks each distinct
one is encoded once, and the new counts are appended to the cache as a batch.

Null texts count as empty. Rows that repeat a ``doc_id`` or a text get a count each. Texts are
counted whole. An empty table gives an empty table. Other columns of the input pass through, those
named ``n_bytes``, ``n_tokens`` or ``digest`` excepted.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citeweave.llm.piece_cache import in_portions
from citeweave.llm.word_tokens import vocabulary_path, word_tokens
from citeweave.staging import Staging

VOCABULARY = "word_bpe_49k.json"
CACHE = "digest binary, version string, n_tokens long"


def tokenizer_version(vocabulary: str) -> str:
    """Digest of the vocabulary file and of the options under which it counts."""
    with open(vocabulary_path(vocabulary), "rb") as file:
        return hashlib.sha256(file.read() + b"; no added ids, no truncation, no padding").hexdigest()


def normalised(text: Column, vocabulary: str) -> Column:
    """Content that has the same count as ``text``.

    The word vocabulary's own first step turns each run of white space into one space, so that is
    done before the digest; sentencepiece models see every space and keep the text as it is.
    """
    text = F.coalesce(text, F.lit(""))
    return F.regexp_replace(text, r"[\x20\x09-\x0D]+", " ") if vocabulary.endswith(VOCABULARY) else text


@cache
def _pieces_model(vocabulary: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=vocabulary_path(vocabulary))


def _count(texts: list[str], vocabulary: str) -> list[int]:
    if vocabulary.endswith(".model"):
        return [len(ids) for ids in _pieces_model(vocabulary).encode(texts, num_threads=1)]
    return word_tokens(vocabulary).count(texts)


def read_cache(spark: SparkSession, folder: str, version: str) -> DataFrame:
    """(digest, n_tokens) for one tokenizer version; a digest that two runs have counted comes once."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], "digest binary, n_tokens long")
    return spark.read.schema(CACHE).parquet(folder).where(F.col("version") == version).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def count_misses(contents: DataFrame, stored: DataFrame, vocabulary: str, version: str) -> DataFrame:
    """Cache rows for the distinct contents (digest, content) that ``stored`` lacks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [n for portion in in_portions(batch.column(1).to_pylist()) for n in _count(portion, vocabulary)]
            columns = [batch.column(0), pa.array([version] * len(counts), pa.string()), pa.array(counts, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["digest", "version", "n_tokens"])

    # Copies meet first within each task, so a text that a third of the rows share moves once per task.
    distinct = contents.groupBy("digest").agg(F.first("content").alias("content"))
    return distinct.join(stored, "digest", "left_anti").select("digest", "content").mapInArrow(run, CACHE)


def count_tokens(docs: DataFrame, cache_folder: str, staging: Staging, vocabulary: str = VOCABULARY) -> DataFrame:
    """``docs`` with ``digest``, ``n_bytes`` (UTF-8 of the text as it is) and ``n_tokens``."""
    spark, version = docs.sparkSession, tokenizer_version(vocabulary)
    content = normalised(F.col("text"), vocabulary)
    contents = docs.select(F.unhex(F.sha2(content, 256)).alias("digest"), content.alias("content"))
    misses = count_misses(contents, read_cache(spark, cache_folder, version), vocabulary, version)
    misses.write.mode("append").parquet(cache_folder)
    stored = staging.write(read_cache(spark, cache_folder, version), "counts").withColumnRenamed("digest", "_digest")
    rows = docs.drop("digest", "n_bytes", "n_tokens").withColumns(
        {"digest": F.unhex(F.sha2(content, 256)), "n_bytes": F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")}
    )
    return rows.join(stored, F.col("digest") == F.col("_digest"), "left").drop("_digest")
