"""Consistent parts of a corpus."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def edges_from(edges: DataFrame, papers: DataFrame) -> DataFrame:
    """Edges that leave one of the papers."""
    return edges.join(papers.select("ss_id"), "ss_id", "left_semi")


def edges_between(edges: DataFrame, papers: DataFrame) -> DataFrame:
    """Edges with both ends among the papers."""
    cited = papers.select(F.col("ss_id").alias("reference_id"))
    return edges_from(edges, papers).join(cited, "reference_id", "left_semi").select("ss_id", "reference_id")


def matching(table: DataFrame, staged: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of a table whose key occurs in a staged batch.

    If the batch's files are small enough to broadcast, the table is only scanned and not
    shuffled; otherwise both sides are shuffled.
    """
    return table.join(staged.select(*keys), list(keys), "left_semi")
