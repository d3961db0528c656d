"""Packing by powers of two: no sequence crosses documents, and none is padded.

A document's ids with an end id are cut into pieces of the window's length and then one piece for
each bit of what remains, longest first. Every piece is a sequence of its own in the bucket of its
length, and lengths are powers of two, so a batch drawn from one bucket has no padding. Sequences
are numbered bucket by bucket, longest first, without gaps: each task numbers its own pieces per
bucket, and a small table of shifts makes the numbers global; the pieces themselves are never shuffled.

Null and empty texts have the end id only: one piece of length 1. Rows that repeat an id are packed
one by one. Texts are encoded whole. An empty table gives an empty table. Other columns than
``doc_id`` and ``text`` are not looked at.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from citeweave.llm.piece_cache import in_portions
from citeweave.llm.word_tokens import word_tokens
from citeweave.staging import Staging

VOCABULARY = "word_bpe_49k.json"
WINDOW = 2048
END_ID = 1

PIECES = "doc_id long, start long, length long, doc_tokens long, ids binary, part int, rank long"


def piece_lengths(n: int, window: int = WINDOW) -> list[int]:
    """Lengths that add up to ``n``: whole windows, then the bits of the rest from the highest."""
    rest = n % window
    return [window] * (n // window) + [1 << k for k in range(rest.bit_length() - 1, -1, -1) if rest >> k & 1]


def pieces(docs: DataFrame, vocabulary: str = VOCABULARY, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """One row per piece; ``ids`` are little-endian unsigned 32-bit numbers, ``rank`` counts within task and length."""
    if window < 1 or window & (window - 1):
        raise ValueError("the window has to be a power of two")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, seen = word_tokens(vocabulary), TaskContext.get().partitionId(), Counter()
        for batch in batches:
            ids_of, texts = batch.column(0).to_pylist(), [text or "" for text in batch.column(1).to_pylist()]
            at = 0
            for portion in in_portions(texts):
                doc, start, length, total, ids, rank = [], [], [], [], [], []
                for tokens in encoder.encode(portion):
                    tokens = np.append(tokens, np.uint32(end_id)).astype("<u4").tobytes()
                    begin, n = 0, len(tokens) // 4
                    for size in piece_lengths(n, window):
                        doc.append(ids_of[at])
                        start.append(begin)
                        length.append(size)
                        total.append(n)
                        ids.append(tokens[4 * begin : 4 * (begin + size)])
                        rank.append(seen[size])
                        seen[size] += 1
                        begin += size
                    at += 1
                columns = [pa.array(x, pa.int64()) for x in (doc, start, length, total)]
                columns += [pa.array(ids, pa.binary()), pa.array([part] * len(doc), pa.int32()), pa.array(rank, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "length", "doc_tokens", "ids", "part", "rank"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, PIECES)


def number_sequences(cut: DataFrame, staging: Staging) -> DataFrame:
    """``pieces`` (whatever columns were derived from them) with ``sequence_id`` and ``offset`` for ``part`` and ``rank``."""
    stored = staging.write(cut, "pieces")
    before = Window.orderBy(F.col("length").desc())
    lengths = stored.groupBy("length").agg(F.count("*").alias("rows"))  # as many rows as powers of two up to the window
    first = lengths.select("length", (F.sum("rows").over(before) - F.col("rows")).alias("first"))
    within = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        stored.groupBy("length", "part")
        .agg(F.count("*").alias("rows"))
        .withColumn("shift", F.coalesce(F.sum("rows").over(within), F.lit(0)))
        .join(first, "length")
        .select("length", "part", (F.col("first") + F.col("shift")).alias("shift"))
    )
    shifts = staging.write(shifts, "piece-shifts")
    return (
        stored.join(shifts, ["length", "part"])
        .withColumn("sequence_id", F.col("shift") + F.col("rank"))
        .withColumn("offset", F.lit(0).cast("long"))
        .drop("shift", "part", "rank")
    )


def pack(docs: DataFrame, staging: Staging, vocabulary: str = VOCABULARY, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """Packed pieces with their ids: (doc_id, start, length, doc_tokens, ids, sequence_id, offset)."""
    return number_sequences(pieces(docs, vocabulary, window, end_id), staging)
