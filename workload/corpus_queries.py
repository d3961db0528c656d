"""Queries over papers, terms and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from citeweave.functions.text import (
    clean_affixes,
    id_after_dash,
    item_url,
    or_default,
    search_url,
    strip,
    url_quote,
    url_unquote,
)
from citeweave.operators import frontier, report
from citeweave.operators.identity import assign_ids
from citeweave.plans.curate import PER_TERM, curate, top_papers_per_term
from citeweave.sources.tables import scan_papers
from citeweave.sources.terms import read_terms, slice_exclusive, slice_inclusive
from citeweave.staging import Staging
from workload import tables
from workload.registry import query

BASE_URL = "https://papers.example.org/paper/"
SEARCH_URL = "https://papers.example.org/search?q="

# White space as in `citeweave.functions.text`, for the SQL side.
SPACE = r"[\x{09}-\x{0d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def sql_strip(text: str) -> str:
    return f"regexp_replace({text}, '\\A{SPACE}+|{SPACE}+\\z', '', 'g')"


def sql_clean(text: str, prefix: str, suffix: str) -> str:
    head = f"CASE WHEN starts_with({text}, '{prefix}') THEN {sql_strip(f'substr({text}, {len(prefix) + 1})')} ELSE {text} END"
    cut = sql_strip(f"substr(({head}), 1, length({head}) - {len(suffix)})")
    return f"CASE WHEN ends_with(({head}), '{suffix}') THEN {cut} ELSE ({head}) END"


# --- terms -------------------------------------------------------------------------------


@query("terms_ranked", "SELECT term_pos, term FROM g_terms")
def terms_ranked(spark, sf):
    """A landed term list read back in file order."""
    staging = Staging(spark, "terms")
    landed = staging.path("terms-csv")
    listed = tables.table(spark, sf, "part").select(F.col("p_brand").alias("term")).distinct()
    listed.orderBy("term").write.csv(landed)
    return read_terms(spark, landed, staging)


@query("terms_slice_inclusive", "SELECT term_pos, term FROM g_terms WHERE term_pos BETWEEN 0 AND 2")
def terms_slice_inclusive(spark, sf):
    terms = tables.part_terms(spark, sf, Staging(spark, "terms"))
    return slice_inclusive(terms, 0, 2).select("term_pos", "term")


@query("terms_slice_exclusive", "SELECT term_pos, term FROM g_terms WHERE term_pos >= 0 AND term_pos < 15")
def terms_slice_exclusive(spark, sf):
    terms = tables.part_terms(spark, sf, Staging(spark, "terms"))
    return slice_exclusive(terms, 0, 15).select("term_pos", "term")


@query(
    "papers_by_term",
    "SELECT p.id, p.ss_id, p.search_term, t.term_pos FROM d_papers p JOIN d_terms t ON p.search_term = t.term",
)
def papers_by_term(spark, sf):
    papers = tables.document_papers(spark, sf).select("id", "ss_id", "search_term")
    return frontier.papers_by_term(papers, tables.document_terms(spark, sf, Staging(spark, "terms")))


# --- frontier ----------------------------------------------------------------------------


@query("paper_ids_all", "SELECT id, ss_id, is_processed FROM g_papers ORDER BY id")
def paper_ids_all(spark, sf):
    return scan_papers(tables.part_papers(spark, sf))


@query(
    "frontier_term_hop",
    "SELECT id, ss_id, is_processed FROM g_papers WHERE search_term = 'Brand#2' AND num_hops = 0 ORDER BY id",
)
def frontier_term_hop(spark, sf):
    return frontier.frontier_of(tables.part_papers(spark, sf), "Brand#2", 0)


@query("frontier_unprocessed", "SELECT id, ss_id, search_term FROM d_papers WHERE NOT coalesce(is_processed, false)")
def frontier_unprocessed(spark, sf):
    return frontier.unprocessed(tables.document_papers(spark, sf)).select("id", "ss_id", "search_term")


@query("frontier_page", "SELECT id, ss_id, is_processed FROM g_papers ORDER BY id LIMIT 300 OFFSET 300")
def frontier_page(spark, sf):
    papers = tables.part_papers(spark, sf).select("id", "ss_id", "is_processed")
    return frontier.frontier_page(papers, 300, 300)


@query(
    "topk_one_term",
    """SELECT id, ss_id, title, abstract, search_term, num_hops FROM d_papers
    WHERE search_term = 'src1' AND num_hops = 0 ORDER BY id LIMIT 50""",
)
def topk_one_term(spark, sf):
    return frontier.first_of_term(tables.document_papers(spark, sf), "src1", PER_TERM)


@query(
    "resume_after",
    """SELECT role AS term, conv_id AS page, turn AS item FROM conversations
    WHERE role IS DISTINCT FROM 'user' OR conv_id > 40 OR (conv_id = 40 AND turn > 1)""",
)
def resume_after(spark, sf):
    rows = tables.table(spark, sf, "conversations").select(
        F.col("role").alias("term"), F.col("conv_id").alias("page"), F.col("turn").alias("item")
    )
    return frontier.resume_after(rows, "user", 40, 1)


# --- top papers --------------------------------------------------------------------------


@query(
    "topn_per_term",
    """SELECT ss_id, title, abstract, url, search_term, num_hops FROM (
      SELECT *, row_number() OVER (PARTITION BY search_term ORDER BY id) AS place
      FROM g_papers p JOIN g_terms t ON p.search_term = t.term WHERE num_hops = 0) r
    WHERE place <= 50""",
)
def topn_per_term(spark, sf):
    staging = Staging(spark, "topn")
    terms = tables.part_terms(spark, sf, staging)
    return top_papers_per_term(tables.part_papers(spark, sf), terms, staging).drop("id", "term_pos")


PICKED = """, picked AS (
  SELECT *, row_number() OVER (PARTITION BY search_term ORDER BY id) AS place
  FROM d_papers p JOIN d_terms t ON p.search_term = t.term WHERE num_hops = 0{slice})
"""


@query(
    "curate_topn",
    PICKED.format(slice=" AND term_pos < 15")
    + """SELECT CAST(row_number() OVER (ORDER BY term_pos, id) AS BIGINT) AS id, ss_id, title, abstract, search_term,
       num_hops, url, false AS is_processed
    FROM picked WHERE place <= 50""",
)
def curate_topn(spark, sf):
    staging = Staging(spark, "curate")
    terms = slice_exclusive(tables.document_terms(spark, sf, staging), 0, 15)
    return curate(tables.document_papers(spark, sf), terms, tables.no_papers(spark), staging)


@query(
    "curated_insert",
    PICKED.format(slice="")
    + """, fresh AS (
      SELECT * FROM picked WHERE place <= 50 AND ss_id NOT IN (SELECT ss_id FROM d_papers WHERE is_processed))
    SELECT CAST((SELECT max(id) FROM d_papers WHERE is_processed) + row_number() OVER (ORDER BY term_pos, id) AS BIGINT) AS id,
       ss_id, title, abstract, search_term, num_hops, url, false AS is_processed
    FROM fresh""",
)
def curated_insert(spark, sf):
    staging = Staging(spark, "curate")
    papers = tables.document_papers(spark, sf)
    terms = tables.document_terms(spark, sf, staging)
    return curate(papers, terms, papers.filter("is_processed"), staging)


# --- reports -----------------------------------------------------------------------------


@query(
    "processed_per_term",
    "SELECT search_term, count(*) AS count FROM d_papers WHERE is_processed GROUP BY search_term",
)
def processed_per_term(spark, sf):
    return report.processed_per_term(tables.document_papers(spark, sf))


@query(
    "batch_counts",
    """SELECT search_term, num_hops, count(*) AS seen, count(*) FILTER (NOT coalesce(is_processed, false)) AS fetched,
       CAST(ceil(count(*) / 300.0) AS BIGINT) AS batches
    FROM g_papers GROUP BY search_term, num_hops""",
)
def batch_counts(spark, sf):
    return report.batch_counts(tables.part_papers(spark, sf))


@query(
    "collate_latest",
    """SELECT user_id, event_id, event_type, value, props FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS place FROM events) e
    WHERE place = 1""",
)
def collate_latest(spark, sf):
    events = tables.table(spark, sf, "events").select("user_id", "event_id", "event_type", "value", "props")
    return report.latest_per_key(events, "user_id", "event_id")


# --- numbering ---------------------------------------------------------------------------


@query(
    "assign_ids",
    """SELECT CAST(row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS BIGINT) AS id, o_orderkey FROM orders""",
)
def assign_ids_by_date(spark, sf):
    orders = tables.table(spark, sf, "orders").select("o_orderdate", "o_orderkey")
    numbered = assign_ids(orders, ["o_orderdate", "o_orderkey"], Staging(spark, "ids"))
    return numbered.select("id", "o_orderkey")


# --- text functions ----------------------------------------------------------------------


@query("url_quoted_terms", "SELECT id, replace(url_encode(title), '%2F', '/') AS quoted FROM d_papers")
def url_quoted_terms(spark, sf):
    return tables.document_papers(spark, sf).select("id", url_quote(F.col("title")).alias("quoted"))


@query(
    "url_roundtrip",
    """SELECT page_id, url_decode(url) AS plain, url_decode(url_encode(html)) = html AS same FROM pages""",
)
def url_roundtrip(spark, sf):
    html = F.col("html")
    return tables.table(spark, sf, "pages").select(
        "page_id", url_unquote(F.col("url")).alias("plain"), (url_unquote(url_quote(html)) == html).alias("same")
    )


@query(
    "paper_url",
    f"""SELECT ss_id, concat('{BASE_URL}', ss_id) AS url,
       concat('{SEARCH_URL}', replace(url_encode(search_term), '%2F', '/'), '&page=', CAST(term_pos + 1 AS VARCHAR)) AS search
    FROM g_papers p JOIN g_terms t ON p.search_term = t.term""",
)
def paper_url(spark, sf):
    papers = frontier.papers_by_term(
        tables.part_papers(spark, sf).select("ss_id", "search_term"), tables.part_terms(spark, sf, Staging(spark, "urls"))
    )
    quoted = url_quote(F.col("search_term"))
    return papers.select(
        "ss_id",
        item_url(BASE_URL, F.col("ss_id")).alias("url"),
        search_url(SEARCH_URL, quoted, F.col("term_pos") + 1).alias("search"),
    )


@query("title_stripped", f"SELECT id, {sql_strip('substr(abstract, length(title) + 1)')} AS body FROM d_papers")
def title_stripped(spark, sf):
    """What follows the title of a document, trimmed."""
    rest = F.substr("abstract", F.char_length("title") + 1)
    return tables.document_papers(spark, sf).select("id", strip(rest).alias("body"))


@query("clean_affixes", f"SELECT doc_id, {sql_clean('text', 'The', '.')} AS cleaned FROM documents")
def cleaned_texts(spark, sf):
    documents = tables.table(spark, sf, "documents")
    return documents.select("doc_id", clean_affixes(F.col("text"), "The", ".").alias("cleaned"))


@query(
    "id_after_dash",
    """SELECT o_orderkey, CASE WHEN contains(o_orderpriority, '-')
       THEN substr(o_orderpriority, strpos(o_orderpriority, '-') + 1) END AS ident FROM orders""",
)
def idents(spark, sf):
    orders = tables.table(spark, sf, "orders")
    return orders.select("o_orderkey", id_after_dash(F.col("o_orderpriority")).alias("ident"))


@query(
    "abstract_defaulted",
    """SELECT id, coalesce(nullif(CASE WHEN is_processed THEN abstract WHEN NOT is_processed THEN '' END, ''), 'No abstract available') AS abstract
    FROM d_papers""",
)
def abstract_defaulted(spark, sf):
    """Whole texts; those of unprocessed papers are emptied, those without a flag are null."""
    text = F.when(F.col("is_processed"), F.col("abstract")).when(~F.col("is_processed"), "")
    return tables.document_papers(spark, sf).select("id", or_default(text, "abstract").alias("abstract"))


@query("json_field", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events")
def json_field(spark, sf):
    events = tables.table(spark, sf, "events")
    return events.select("event_id", F.try_variant_get(F.try_parse_json("props"), "$.k", "int").alias("k"))
