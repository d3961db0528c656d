"""From stored result pages to seed papers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeweave.functions.html import page_rows, row_abstract, row_ident, row_title
from citeweave.functions.text import item_url, url_unquote
from citeweave.operators.frontier import resume_after
from citeweave.operators.upsert import new_papers
from citeweave.sources.terms import first_positions
from citeweave.staging import Staging

PAGE_ORDER = ("term_pos", "page", "item")


def result_rows(pages: DataFrame, base_url: str, carry: Sequence[str] = ("term", "page")) -> DataFrame:
    """Title, id, abstract and address of every result; the id is null where it cannot be read."""
    row = F.col("row_html")
    return (
        page_rows(pages, carry=carry)
        .select(
            *carry,
            "item",
            row_title(row).alias("title"),
            row_ident(row).alias("ss_id"),
            row_abstract(row).alias("abstract"),
        )
        .withColumn("url", item_url(base_url, F.col("ss_id")))
    )


def listed_rows(
    pages: DataFrame,
    terms: DataFrame,
    base_url: str,
    staging: Staging,
    *,
    resume: tuple[str, int, int] | None = None,
) -> DataFrame:
    """The results on the pages of the listed terms, written once.

    ``pages.term`` is the quoted term; pages of terms that are not listed are not read further.
    ``resume`` names the plain term, page and item last done: the pages of that term before the page
    are dropped before any page is parsed, however their term is quoted.
    """
    named = pages.withColumn("search_term", url_unquote(F.col("term")))
    if resume is not None:
        term, page, _item = resume
        named = named.filter(~F.col("search_term").eqNullSafe(F.lit(term)) | (F.col("page") >= page))
    listed = named.join(first_positions(terms).withColumnRenamed("term", "search_term"), "search_term")
    rows = result_rows(listed, base_url, ("search_term", "term_pos", "page"))
    if resume is not None:
        rows = resume_after(rows.withColumnRenamed("search_term", "term"), *resume).withColumnRenamed("term", "search_term")
    return staging.write(rows, "results")


def rejected_results(rows: DataFrame) -> DataFrame:
    """Results that cannot be kept, with the reason."""
    return rows.filter(F.col("ss_id").isNull()).select("search_term", "page", "item", F.lit("no id").alias("problem"))


def collect_pages(
    pages: DataFrame,
    terms: DataFrame,
    known: DataFrame,
    base_url: str,
    staging: Staging,
    *,
    resume: tuple[str, int, int] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The seed papers that stored pages add to the known ones, and the results that are rejected.

    Pages, terms and ``resume`` are those of ``listed_rows``.
    """
    rows = listed_rows(pages, terms, base_url, staging, resume=resume)
    return new_papers(rows.withColumn("num_hops", F.lit(0)), known, PAGE_ORDER, staging), rejected_results(rows)
