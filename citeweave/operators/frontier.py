"""Choosing the papers to work on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def frontier_of(papers: DataFrame, term: str, hop: int) -> DataFrame:
    """Papers of one term at one hop, in insertion order."""
    return (
        papers.filter((F.col("search_term") == term) & (F.col("num_hops") == hop))
        .select("id", "ss_id", "is_processed")
        .orderBy("id")
    )


def unprocessed(papers: DataFrame, done: DataFrame | None = None) -> DataFrame:
    """Papers not marked as done; an absent mark counts as not done.

    ``done`` holds keys noted as done elsewhere, whose flags are not merged yet.
    """
    waiting = papers.filter(~F.coalesce("is_processed", F.lit(False)))
    return waiting if done is None else waiting.join(done.select("ss_id"), "ss_id", "left_anti")


def seeds(papers: DataFrame) -> DataFrame:
    return papers.filter(F.col("num_hops") == 0)


def frontier_page(papers: DataFrame, start: int, size: int) -> DataFrame:
    """One page of the frontier for looking at; jobs take the whole frontier instead."""
    return papers.orderBy("id").offset(start).limit(size)


def first_of_term(papers: DataFrame, term: str, size: int) -> DataFrame:
    """The first seed papers of one term."""
    return (
        seeds(papers)
        .filter(F.col("search_term") == term)
        .select("id", "ss_id", "title", "abstract", "search_term", "num_hops")
        .orderBy("id")
        .limit(size)
    )


def papers_by_term(papers: DataFrame, terms: DataFrame) -> DataFrame:
    """Papers whose search term is in the list, with the term's position.

    The list is small and read from files, so the planner sees its size and broadcasts it; a
    list beyond the threshold is shuffled and a hot term split by the adaptive skew join.
    """
    return papers.join(terms, papers["search_term"] == terms["term"]).drop("term")


def lookup_frontier(papers: DataFrame, terms: DataFrame, hop: int, done: DataFrame | None = None) -> DataFrame:
    """Parents to look up at ``hop``: unprocessed papers of the terms, as narrow rows."""
    at_hop = papers.filter(F.col("num_hops") == hop).select("id", "ss_id", "search_term", "is_processed")
    waiting = unprocessed(at_hop, done)
    return papers_by_term(waiting, terms).select(
        "term_pos",
        F.col("id").alias("parent_id"),
        F.col("ss_id").alias("parent_ss_id"),
        "search_term",
    )


def resume_after(rows: DataFrame, term: str, page: int, item: int) -> DataFrame:
    """Rows still to do after a stop at ``(page, item)`` of ``term``; other terms stay whole."""
    ahead = (F.col("page") > page) | ((F.col("page") == page) & (F.col("item") > item))
    return rows.filter(~F.col("term").eqNullSafe(F.lit(term)) | ahead)
