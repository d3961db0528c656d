"""Constraint checks. All of them count or list violations and change nothing."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeweave.operators.subset import matching
from citeweave.staging import Staging


def null_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a null in a column that must not have one."""
    return df.filter(reduce(lambda a, b: a | b, [F.col(name).isNull() for name in columns]))


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with how often; counted per task before the shuffle."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter(F.col("n") > 1)


def edge_ends(edges: DataFrame) -> DataFrame:
    """Every key that stands at either end of an edge, once."""
    return edges.select("ss_id").union(edges.select("reference_id")).distinct()


def missing_papers(edges: DataFrame, papers: DataFrame, staging: Staging) -> DataFrame:
    """Edge ends that are no papers.

    Ends are made distinct before the join, so a hub counts once. The result is written: it is
    small in a sound corpus and then broadcast against the edges, which stay where they are.
    """
    return staging.write(edge_ends(edges).join(papers.select("ss_id"), "ss_id", "left_anti"), "missing-papers")


def flag_orphans(edges: DataFrame, papers: DataFrame, staging: Staging) -> DataFrame:
    """Edges with ``orphan``: whether one of their ends is no paper; a null end is none."""
    missing = missing_papers(edges, papers, staging)
    source = missing.withColumn("no_source", F.lit(True))
    target = missing.select(F.col("ss_id").alias("reference_id"), F.lit(True).alias("no_target"))
    null_end = F.col("ss_id").isNull() | F.col("reference_id").isNull()
    orphan = F.coalesce("no_source", "no_target", null_end)
    return (
        edges.join(source, "ss_id", "left")
        .join(target, "reference_id", "left")
        .select("ss_id", "reference_id", orphan.alias("orphan"))
    )


def orphan_edges(edges: DataFrame, papers: DataFrame, staging: Staging) -> DataFrame:
    """Edges with an end that is no paper, or null."""
    return flag_orphans(edges, papers, staging).filter("orphan").drop("orphan")


def orphans_after(previous: DataFrame, edges: DataFrame, added: DataFrame, papers: DataFrame, staging: Staging, look_up=matching) -> DataFrame:
    """Orphans with the ends they lack (``no_source``, ``no_target``), after ``edges`` and the papers ``added`` have come.

    ``previous`` are the orphans before, and only the added papers can free them; the ends of the new edges are looked up
    among all ``papers``, the added ones included. A null end is no paper.
    """
    new = staging.write(edges.select("ss_id", "reference_id").distinct(), "new-edges")
    ends = staging.write(edge_ends(new).where("ss_id IS NOT NULL"), "new-ends")
    missing = staging.write(ends.join(look_up(papers.select("ss_id"), ends, ["ss_id"]), "ss_id", "left_anti"), "new-missing")

    def flagged(edges: DataFrame, keys: DataFrame, name: str, end: str) -> DataFrame:
        marks = keys.select(F.col("ss_id").alias(end)).distinct().withColumn(name, F.lit(True))
        return edges.join(marks, end, "left").withColumn(name, F.coalesce(name, F.col(end).isNull()))

    found = flagged(flagged(new, missing, "no_source", "ss_id"), missing, "no_target", "reference_id")
    freed = flagged(flagged(previous, added, "_source", "ss_id"), added, "_target", "reference_id")
    still = freed.select(
        "ss_id",
        "reference_id",
        *[(F.col(f"no_{end}") & (~F.col(f"_{end}") | F.col(key).isNull())).alias(f"no_{end}") for end, key in (("source", "ss_id"), ("target", "reference_id"))],
    )
    return found.unionByName(still).where("no_source OR no_target")
