"""Neighbours of papers along citation edges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeweave.schemas import CITATION, REFERENCE


def citations_of(edges: DataFrame) -> DataFrame:
    """Edges seen from the cited paper: who cites it."""
    return edges.select(
        F.col("reference_id").alias("parent_ss_id"),
        F.lit(CITATION).alias("direction"),
        F.col("ss_id").alias("ss_id"),
    )


def references_of(edges: DataFrame) -> DataFrame:
    """Edges seen from the citing paper: whom it cites."""
    return edges.select(
        F.col("ss_id").alias("parent_ss_id"),
        F.lit(REFERENCE).alias("direction"),
        F.col("reference_id").alias("ss_id"),
    )


def both_directions(edges: DataFrame) -> DataFrame:
    return citations_of(edges).unionByName(references_of(edges))


def slice_of(key: Column, slices: int) -> Column:
    """The slice of a link table that holds the links of a paper."""
    return F.pmod(F.xxhash64(key), F.lit(slices)).cast("int")


def links_of(frontier: DataFrame, links: DataFrame, slices: int) -> DataFrame:
    """The part of a link table in slices that can hold links of the frontier.

    The driver names the slices that the frontier meets, which are ``slices`` numbers at most, and files of other
    slices are not opened: what a hop reads falls with its frontier.
    """
    met = [row[0] for row in frontier.select(slice_of(F.col("parent_ss_id"), slices)).distinct().collect()]
    some = links if len(met) == slices else links.where(F.col("slice").isin(met) if met else F.lit(False))
    return some.select("parent_ss_id", "direction", "ss_id")


def neighbours(frontier: DataFrame, links: DataFrame) -> DataFrame:
    """Neighbours of the frontier along ``links``, one of the views above.

    One join serves both directions, so the frontier is shuffled or broadcast once. Parents
    are unique in the frontier; a hub fills only the link side, which the adaptive skew join
    splits.
    """
    return links.join(frontier, "parent_ss_id")


def as_edges(found: DataFrame) -> DataFrame:
    """The distinct edges behind neighbours, turned back to citing -> cited."""
    incoming = F.col("direction") == CITATION
    return found.select(
        F.when(incoming, F.col("ss_id")).otherwise(F.col("parent_ss_id")).alias("ss_id"),
        F.when(incoming, F.col("parent_ss_id")).otherwise(F.col("ss_id")).alias("reference_id"),
    ).distinct()
