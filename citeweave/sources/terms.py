"""Search-term lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeweave.operators.identity import dense_position
from citeweave.staging import Staging


def read_terms(spark: SparkSession, path: str, staging: Staging) -> DataFrame:
    """``(term_pos, term)`` of a headerless CSV, numbered from 0 in file order.

    The position follows from file, offset of the split in the file and row within the split,
    so it does not depend on how Spark packs splits into tasks.
    """
    rows = (
        spark.read.schema("term string")
        .option("escape", '"')
        .csv(path)
        .select(
            "term",
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("split"),
            F.monotonically_increasing_id().alias("line"),
        )
    )
    placed = dense_position(rows, ["file", "split", "line"], staging, column="term_pos")
    return placed.select("term_pos", "term")


def first_positions(terms: DataFrame) -> DataFrame:
    """A repeated term counts once, at its first position."""
    return terms.groupBy("term").agg(F.min("term_pos").alias("term_pos")).select("term_pos", "term")


def slice_inclusive(terms: DataFrame, start: int, end: int) -> DataFrame:
    return terms.filter(F.col("term_pos").between(start, end))


def slice_exclusive(terms: DataFrame, start: int, end: int) -> DataFrame:
    return terms.filter((F.col("term_pos") >= start) & (F.col("term_pos") < end))
