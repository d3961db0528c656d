"""Picking and copying parts of the corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeweave.operators.frontier import papers_by_term, seeds
from citeweave.operators.ranking import top_n_per_group
from citeweave.operators.subset import edges_between, edges_from
from citeweave.operators.upsert import append_checked, new_papers
from citeweave.sources.terms import first_positions
from citeweave.staging import Staging

PER_TERM = 50


def top_papers_per_term(papers: DataFrame, terms: DataFrame, staging: Staging, n: int = PER_TERM) -> DataFrame:
    """The first ``n`` seed papers of every listed term, with the term's position.

    Ids alone are joined with the terms and ranked; titles and abstracts are read for the chosen ones.
    """
    listed = papers_by_term(seeds(papers).select("id", "search_term"), first_positions(terms))
    chosen = staging.write(top_n_per_group(listed, "search_term", "id", n).select("id", "term_pos"), "chosen")
    columns = ["term_pos", "id", "ss_id", "title", "abstract", "url", "search_term", "num_hops"]
    return seeds(papers).join(chosen, "id").select(*columns)


def curate(papers: DataFrame, terms: DataFrame, curated: DataFrame, staging: Staging, n: int = PER_TERM) -> DataFrame:
    """The rows that picking the first ``n`` papers per term adds to the curated papers.

    They get new ids, in the order of the terms and of the ids they had, and a cleared flag.
    """
    picked = top_papers_per_term(papers, terms, staging, n).withColumnRenamed("id", "source_id")
    return new_papers(picked, curated, ("term_pos", "source_id"), staging)


def copy_seed(
    papers: DataFrame,
    edges: DataFrame,
    target_papers: DataFrame,
    target_edges: DataFrame,
    staging: Staging,
    *,
    both_ends: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Seed papers and the edges that leave them, for a plain append to other tables.

    Each copy is written once; the checks read its keys. ``both_ends`` keeps only edges whose cited
    paper is copied too.
    """
    chosen = staging.write(seeds(papers), "copied-papers")
    leaving = edges_between(edges, chosen) if both_ends else edges_from(edges, chosen)
    leaving = staging.write(leaving.select("ss_id", "reference_id"), "copied-edges")
    return (
        append_checked(append_checked(chosen, target_papers, ["id"]), target_papers, ["ss_id"]),
        append_checked(leaving, target_edges, ["ss_id", "reference_id"]),
    )


def curated_edges(edges: DataFrame, curated: DataFrame) -> DataFrame:
    """Edges of the curated corpus."""
    return edges_between(edges, curated.select(F.col("ss_id")))
