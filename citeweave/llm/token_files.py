"""Token ids of whole texts in entropy-coded files, and back.

A folder holds ``table`` (one frequency for each id, shared by all blocks, from counts over all documents),
``runs`` (one row for each run of whole documents: ids and lengths of its documents, and their token ids as
a payload of ``ans_codec``: independent interleaved blocks with checkpoints and checksums) and ``starts`` (how many ids
come before each run). Spark writes and commits all three, so a lost executor costs the repetition of
its tasks, and any store that Spark writes to will do.

Documents are dealt by ranges of ``doc_id`` and sorted within them; the texts move once and are encoded once: runs are
first written as plain numbers, counted, and coded where they lie. A task closes a run after ``RUN`` ids, so what it
holds is bounded by that and one document. A run is decoded alone, and a part of it from the checkpoint before. The driver holds the frequency table, which the vocabulary bounds.

Null and empty texts have the end id only. Null ids come first. Rows that repeat a ``doc_id`` are documents each, in
the order of their texts' hashes and texts, so an id that a third of all rows share is dealt over several ranges. Texts are
encoded whole. An empty table gives files without rows. Columns other than ``doc_id`` and ``text`` are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from citeweave.llm import ans_codec
from citeweave.llm.byte_tokens import byte_tokens
from citeweave.llm.piece_cache import in_portions
from citeweave.staging import Staging

VOCABULARY = "byte_bpe_50k.json"
END_ID = 2
RUN = 1 << 22

PLAIN = "part int, run int, doc_ids array<long>, sizes array<long>, width int, ids binary, counts binary"
RUNS = "part int, run int, doc_ids array<long>, sizes array<long>, tokens long, payload binary"
READ = "doc_id long, at long, n_tokens long, ids_crc32 long"


def in_order(docs: DataFrame) -> DataFrame:
    """(doc_id, text) in ranges that ascend with the partitions, sorted within each."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    hashed = rows.withColumn("hash", F.xxhash64("text"))
    return hashed.repartitionByRange("doc_id", "hash").sortWithinPartitions("doc_id", "hash", "text").select("doc_id", "text")


def encoded_runs(docs: DataFrame, vocabulary: str, end_id: int, run_ids: int) -> DataFrame:
    """Runs of whole documents in order, their ids as plain numbers of ``width`` bytes, and how often each id comes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, number = byte_tokens(vocabulary), TaskContext.get().partitionId(), 0
        width = 2 if max(encoder.size, end_id + 1) <= 1 << 16 else 4
        names: list[int | None] = []
        held: list[np.ndarray] = []
        size = 0

        def closed() -> pa.RecordBatch:
            ids = np.concatenate(held)
            columns = [
                pa.array([part], pa.int32()),
                pa.array([number], pa.int32()),
                pa.array([names], pa.list_(pa.int64())),
                pa.array([[len(x) for x in held]], pa.list_(pa.int64())),
                pa.array([width], pa.int32()),
                pa.array([ids.astype(f"<u{width}").tobytes()], pa.binary()),
                pa.array([np.bincount(ids).astype("<u4").tobytes()], pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(columns, ["part", "run", "doc_ids", "sizes", "width", "ids", "counts"])

        for batch in batches:
            doc_ids, at = batch.column(0).to_pylist(), 0
            for portion in in_portions(batch.column(1).to_pylist()):
                for tokens in encoder.encode(portion):
                    names.append(doc_ids[at])
                    held.append(np.append(tokens, np.uint32(end_id)))
                    size += len(held[-1])
                    at += 1
                    if size >= run_ids:
                        yield closed()
                        names, held, size, number = [], [], 0, number + 1
        if held:
            yield closed()

    return in_order(docs).mapInArrow(run, PLAIN)


def id_counts(runs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Ids that occur in the runs, and how often; as many as the vocabulary has at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for counts in batch.column(0):
                n = np.frombuffer(counts.as_py(), "<u4")
                total = np.pad(total, (0, max(0, len(n) - len(total))))
                total[: len(n)] += n
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], ["id", "n"])

    counts = runs.select("counts").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    rows = sorted(tuple(row) for row in counts.collect())
    return np.array([i for i, _ in rows], np.int64), np.array([n for _, n in rows], np.int64)


def write_ids(
    docs: DataFrame, folder: str, staging: Staging, *, vocabulary: str = VOCABULARY, end_id: int = END_ID, run_ids: int = RUN
) -> None:
    """Write the token ids of every document in ascending ``doc_id`` order."""
    spark = docs.sparkSession
    # Encoded once: the table of frequencies has to be known before the first block is coded.
    path = staging.path("plain-runs")
    encoded_runs(docs, vocabulary, end_id, run_ids).write.option("compression", "zstd").parquet(path)
    plain = spark.read.schema(PLAIN).parquet(path)
    ids, counts = id_counts(plain)
    freq = ans_codec.scaled(counts)
    rows = [(int(i), int(f)) for i, f in zip(ids, freq, strict=True)]
    spark.createDataFrame(rows, "id long, freq long").coalesce(1).write.mode("overwrite").parquet(f"{folder}/table")
    shared = spark.sparkContext.broadcast((ids, freq))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ans_codec.Table(*shared.value)
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                numbers = np.frombuffer(row.column(5)[0].as_py(), f"<u{row.column(4)[0].as_py()}")
                columns = [*row.columns[:4], pa.array([len(numbers)], pa.int64()), pa.array([ans_codec.encode(numbers, table)], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["part", "run", "doc_ids", "sizes", "tokens", "payload"])

    plain.drop("counts").mapInArrow(code, RUNS).write.mode("overwrite").parquet(f"{folder}/runs")
    runs = spark.read.schema(RUNS).parquet(f"{folder}/runs").select("part", "run", "tokens")
    before = lambda window: F.coalesce(F.sum("tokens").over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # As many parts as tasks wrote; runs are numbered within them.
    parts = runs.groupBy("part").agg(F.sum("tokens").alias("tokens")).select("part", before(Window.orderBy("part")).alias("base"))
    starts = runs.withColumn("inner", before(Window.partitionBy("part").orderBy("run"))).join(parts, "part")
    starts.select("part", "run", (F.col("base") + F.col("inner")).alias("start")).write.mode("overwrite").parquet(f"{folder}/starts")


def read_table(spark: SparkSession, folder: str) -> tuple[np.ndarray, np.ndarray]:
    rows = spark.read.schema("id long, freq long").parquet(f"{folder}/table").collect()
    return np.array([row["id"] for row in rows], np.int64), np.array([row["freq"] for row in rows], np.int64)


def read_ids(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files, and with ``with_ids`` its ids as little-endian bytes.

    Checksums of the payloads and of the decoded segments are verified.
    """
    shared = spark.sparkContext.broadcast(read_table(spark, folder))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ans_codec.Table(*shared.value)
        for batch in batches:
            for k in range(batch.num_rows):
                doc_ids, sizes = batch.column(2)[k].values, batch.column(3)[k].values.to_numpy()
                data = ans_codec.decode(batch.column(4)[k].as_py(), table).astype("<u4")
                ends = np.cumsum(sizes)
                docs = [data[end - size : end].tobytes() for end, size in zip(ends, sizes, strict=True)]
                columns = [
                    pa.array([batch.column(0)[k].as_py()] * len(docs), pa.int32()),
                    pa.array([batch.column(1)[k].as_py()] * len(docs), pa.int32()),
                    doc_ids,
                    pa.array(ends - sizes, pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array([zlib.crc32(x) for x in docs], pa.int64()),
                ]
                names = ["part", "run", "doc_id", "at", "n_tokens", "ids_crc32"]
                if with_ids:
                    columns, names = [*columns, pa.array(docs, pa.binary())], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = f"part int, run int, {READ}" + (", ids binary" if with_ids else "")
    runs = spark.read.schema(RUNS).parquet(f"{folder}/runs")
    found = runs.select("part", "run", "doc_ids", "sizes", "payload").mapInArrow(run, schema)
    starts = spark.read.schema("part int, run int, start long").parquet(f"{folder}/starts")
    placed = found.join(starts, ["part", "run"]).withColumn("start", F.col("start") + F.col("at"))
    return placed.select("doc_id", "start", "n_tokens", "ids_crc32", *(["ids"] if with_ids else []))
