"""Queries over landed look-ups, stored pages and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from citeweave.functions.html import Selector, element_attribute, element_text, page_rows, row_expanded_text
from citeweave.functions.payload import (
    flatten_neighbours,
    parse_responses,
    payload_items,
    rejected_neighbours,
    valid_neighbours,
)
from citeweave.plans.collect import collect_pages, listed_rows, rejected_results
from citeweave.plans.expand import ResponseHop
from citeweave.sources.corpus import Corpus
from citeweave.sources.landed import scan_responses, scan_result_pages
from citeweave.staging import Staging
from citeweave.streaming.ingest import first_seen, ingest_responses, read_first, settle
from workload import tables
from workload.corpus_queries import BASE_URL, sql_clean, sql_strip
from workload.registry import query

# --- look-ups ----------------------------------------------------------------------------

# The neighbours that `workload.tables.landed_responses` puts into its bodies.
NEIGHBOURS = """, cited AS (
  SELECT p_partkey AS parent_id, concat('P', CAST(p_partkey AS VARCHAR)) AS parent_ss_id, p_type,
         CAST(o_orderkey // 10000 AS INT) AS page, o_orderkey, o_orderstatus, o_orderpriority
  FROM (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem) l
  JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey),
supplied AS (
  SELECT p_partkey AS parent_id, concat('P', CAST(p_partkey AS VARCHAR)) AS parent_ss_id, CAST(s_suppkey // 10000 AS INT) AS page, s_suppkey, s_name
  FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem) l
  JOIN supplier ON s_suppkey = l_suppkey JOIN part ON p_partkey = l_partkey WHERE p_type = 'ECONOMY'),
flat AS (
  SELECT parent_id, parent_ss_id, CAST(0 AS INT) AS direction, page,
         CAST(row_number() OVER (PARTITION BY parent_id, page ORDER BY o_orderkey) - 1 AS INT) AS pos,
         concat('O', CAST(o_orderkey AS VARCHAR)) AS ss_id,
         CASE o_orderstatus WHEN 'P' THEN NULL WHEN 'F' THEN 'No Title' ELSE concat('Order ', o_orderpriority) END AS title,
         CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '5-LOW') THEN 'No abstract available'
              ELSE concat('Priority ', o_orderpriority) END AS abstract,
         concat('/order/', CAST(o_orderkey AS VARCHAR)) AS url,
         CASE WHEN o_orderstatus = 'P' THEN 'no title' END AS problem
  FROM cited
  UNION ALL
  SELECT parent_id, parent_ss_id, CAST(1 AS INT), page, CAST(row_number() OVER (PARTITION BY parent_id, page ORDER BY s_suppkey) - 1 AS INT),
         concat('S', CAST(s_suppkey AS VARCHAR)), s_name, 'No abstract available', concat('/supplier/', CAST(s_suppkey AS VARCHAR)), NULL
  FROM supplied
  UNION ALL
  SELECT p_partkey, concat('P', CAST(p_partkey AS VARCHAR)), CAST(1 AS INT), CAST(0 AS INT), CAST(v.pos AS INT), v.ss_id, v.title,
         v.abstract, CAST(NULL AS VARCHAR), v.problem
  FROM part, (VALUES (0, 'unknown_id', 'No Title', 'No abstract available', NULL), (1, NULL, NULL, NULL, 'null paper'),
    (2, '', 'x', 'No abstract available', 'no id'), (3, NULL, NULL, NULL, 'item is no object')) v(pos, ss_id, title, abstract, problem)
  WHERE p_type = 'LARGE')
"""

BODIES = (
    NEIGHBOURS.rstrip()
    + """, bodies AS (
  SELECT parent_id AS id, parent_ss_id AS ss_id, CAST(0 AS INT) AS direction, page, CAST(200 AS INT) AS status, any_value(p_type) AS p_type,
         count(*) AS n,
         concat('[', string_agg(concat('{"citingPaper":{"paperId":"O', CAST(o_orderkey AS VARCHAR), '"',
           CASE o_orderstatus WHEN 'P' THEN ',"title":null' WHEN 'F' THEN '' ELSE concat(',"title":"Order ', o_orderpriority, '"') END,
           CASE o_orderpriority WHEN '1-URGENT' THEN ',"abstract":null' WHEN '5-LOW' THEN ',"abstract":""' WHEN '2-HIGH' THEN ''
                ELSE concat(',"abstract":"Priority ', o_orderpriority, '"') END,
           ',"url":"/order/', CAST(o_orderkey AS VARCHAR), '"}}'), ',' ORDER BY o_orderkey), ']') AS items
  FROM cited GROUP BY parent_id, parent_ss_id, page),
landed AS (
  SELECT id, ss_id, direction, page, status, n, CASE WHEN p_type = 'ECONOMY' THEN items ELSE concat('{"data":', items, '}') END AS body
  FROM bodies
  UNION ALL
  SELECT p_partkey, concat('P', CAST(p_partkey AS VARCHAR)), CAST(1 AS INT), CAST(0 AS INT),
         CAST(CASE WHEN p_type = 'STANDARD' THEN 404 ELSE 200 END AS INT),
         CASE p_type WHEN 'LARGE' THEN 4 WHEN 'ECONOMY' THEN 0 END,
         CASE p_type WHEN 'STANDARD' THEN NULL WHEN 'PROMO' THEN '{}' WHEN 'SMALL' THEN '{"data":null}' WHEN 'MEDIUM' THEN '{bad'
           WHEN 'LARGE' THEN '{"data":[{},{"citedPaper":null},{"citedPaper":{"paperId":"","title":"x"}},7]}' ELSE '[]' END
  FROM part WHERE p_partkey NOT IN (SELECT parent_id FROM supplied)
  UNION ALL
  SELECT parent_id, parent_ss_id, CAST(1 AS INT), page, CAST(200 AS INT), count(*),
         concat('{"data":[', string_agg(concat('{"citedPaper":{"paperId":"S', CAST(s_suppkey AS VARCHAR), '","title":"', s_name,
           '","url":"/supplier/', CAST(s_suppkey AS VARCHAR), '"}}'), ',' ORDER BY s_suppkey), ']}')
  FROM supplied GROUP BY parent_id, parent_ss_id, page)
"""
)


def parsed_responses(spark, sf):
    renamed = tables.landed_responses(spark, sf).withColumnsRenamed({"id": "parent_id", "ss_id": "parent_ss_id"})
    return parse_responses(renamed)


def flat_neighbours(spark, sf):
    return flatten_neighbours(parsed_responses(spark, sf), "parent_id", "parent_ss_id")


@query("responses_scan", BODIES + "SELECT id, ss_id, direction, page, status, body FROM landed")
def responses_scan(spark, sf):
    """Look-ups landed as compressed JSON lines and read back."""
    path = Staging(spark, "landing").path("responses")
    tables.landed_responses(spark, sf).write.json(path, compression="gzip")
    return scan_responses(spark, path, "json")


@query("payload_items", BODIES + "SELECT id, direction, page, CAST(n AS INT) AS n FROM landed")
def payload_item_counts(spark, sf):
    """How many items each payload holds; null where there is no list."""
    items = payload_items(F.col("payload"))
    counted = parsed_responses(spark, sf).select(
        F.col("parent_id").alias("id"), "direction", "page", F.when(items.isNotNull(), F.size(items)).alias("n")
    )
    return counted


@query("payload_defaults", NEIGHBOURS + "SELECT * FROM flat")
def payload_defaults(spark, sf):
    return flat_neighbours(spark, sf).filter(F.col("pos").isNotNull())


def written_neighbours(spark, sf):
    """Written once, as in a hop: a filter on ``problem`` then reads a column and parses nothing again."""
    return Staging(spark, "neighbours").write(flat_neighbours(spark, sf))


@query("neighbours_valid", NEIGHBOURS + "SELECT * EXCLUDE (problem) FROM flat WHERE problem IS NULL")
def neighbours_valid(spark, sf):
    return valid_neighbours(written_neighbours(spark, sf))


@query(
    "neighbours_rejected",
    NEIGHBOURS
    + """SELECT parent_id, direction, page, pos, problem FROM flat WHERE problem IS NOT NULL
    UNION ALL SELECT p_partkey, CAST(1 AS INT), CAST(0 AS INT), NULL, CASE p_type WHEN 'SMALL' THEN 'null item list' ELSE 'malformed payload' END
    FROM part WHERE p_type IN ('SMALL', 'MEDIUM')""",
)
def neighbours_rejected(spark, sf):
    """Rejected items, and payloads without a readable list."""
    return rejected_neighbours(written_neighbours(spark, sf)).select("parent_id", "direction", "page", "pos", "problem")


LANDED_HOP = (
    NEIGHBOURS.rstrip()
    + """, cand AS (
  SELECT f.*, t.term_pos, p.search_term,
         row_number() OVER (PARTITION BY f.ss_id ORDER BY t.term_pos, f.parent_id, f.direction, f.page, f.pos) AS place
  FROM flat f JOIN g_papers p ON p.id = f.parent_id JOIN g_terms t ON p.search_term = t.term
  WHERE NOT p.is_processed AND f.problem IS NULL),
hop1 AS (
  SELECT CAST((SELECT max(id) FROM g_papers) + row_number() OVER (ORDER BY term_pos, parent_id, direction, page, pos) AS BIGINT) AS id,
         ss_id, title, abstract, search_term, CAST(1 AS INT) AS num_hops, url, false AS is_processed
  FROM cand WHERE place = 1)
"""
)


def landed_hop(spark, sf):
    staging = Staging(spark, "hop")
    # Landed once: the hop reads their keys and then their bodies.
    return ResponseHop(
        tables.part_papers(spark, sf),
        staging.write(tables.landed_responses(spark, sf), "responses"),
        tables.part_terms(spark, sf, staging),
        0,
        staging,
    )


@query("expand_responses_papers", LANDED_HOP + "SELECT * FROM hop1")
def expand_responses_papers(spark, sf):
    return landed_hop(spark, sf).papers


@query(
    "expand_responses_edges",
    LANDED_HOP
    + """SELECT DISTINCT CASE direction WHEN 0 THEN ss_id ELSE parent_ss_id END AS ss_id,
      CASE direction WHEN 0 THEN parent_ss_id ELSE ss_id END AS reference_id FROM cand""",
)
def expand_responses_edges(spark, sf):
    return landed_hop(spark, sf).edges


# --- pages -------------------------------------------------------------------------------


@query(
    "page_rows",
    r"""SELECT page_id, CAST(i - 1 AS INT) AS item, regexp_extract(links[i], 'href="([^"]*)"', 1) AS href,
      regexp_extract(links[i], '>([^<]*)</a>', 1) AS label
    FROM (SELECT page_id, links, unnest(generate_series(1, len(links))) AS i
          FROM (SELECT page_id, regexp_extract_all(html, '<li><a href="[^"]*">[^<]*</a></li>') AS links FROM pages) p) r""",
)
def link_rows(spark, sf):
    """The navigation entries of every page, in order."""
    rows = page_rows(tables.table(spark, sf, "pages"), Selector("li"), ["page_id"])
    link = Selector("a")
    return rows.select(
        "page_id",
        "item",
        element_attribute(F.col("row_html"), link, "href").alias("href"),
        element_text(F.col("row_html"), link).alias("label"),
    )


# Titles are cut off at a length, so their last entity may lack its semicolon.
TITLE = r"regexp_extract(html, '<h1>(.*?)</h1>', 1, 's')"
for entity, character in (("quot", "'\"'"), ("middot", "chr(183)"), ("copy", "chr(169)"), ("amp", "'&'")):
    TITLE = f"regexp_replace({TITLE}, '&{entity};?', {character}, 'g')"


@query("page_titles", f"SELECT page_id, {sql_strip(TITLE)} AS title FROM pages")
def page_titles(spark, sf):
    title = element_text(F.col("html"), Selector("h1"))
    return tables.table(spark, sf, "pages").select("page_id", title.alias("title"))


# Text behind the last expanded label of each result, as `workload.tables.result_pages` writes it.
EXPANDED = f"""CASE lang WHEN 'en' THEN {sql_strip("text")} WHEN 'es' THEN NULL
  ELSE concat('Abstract', {sql_strip("text")}, 'Collapse') END"""
RESULTS = f""", results AS (
  SELECT doc_id, source, doc_id // 10 AS page,
         CAST(row_number() OVER (PARTITION BY source, doc_id // 10 ORDER BY doc_id) - 1 AS INT) AS item,
         {sql_strip("split_part(text, chr(10), 1)")} AS title, {EXPANDED} AS opened, n_chars % 11 <> 0 AS readable
  FROM documents)
"""


def stored_pages(spark, sf, staging):
    path = staging.path("pages")
    tables.result_pages(spark, sf).write.parquet(path)
    return scan_result_pages(spark, path)


@query("page_expanded_text", RESULTS + "SELECT source AS term, page, item, opened FROM results")
def page_expanded_text(spark, sf):
    rows = page_rows(stored_pages(spark, sf, Staging(spark, "pages")), carry=("term", "page"))
    return rows.select("term", "page", "item", row_expanded_text(F.col("row_html")).alias("opened"))


@query(
    "collect_pages",
    RESULTS
    + f"""SELECT CAST(row_number() OVER (ORDER BY t.term_pos, page, item) AS BIGINT) AS id, concat('D', CAST(doc_id AS VARCHAR)) AS ss_id,
      title, coalesce({sql_clean("opened", "Abstract", "Collapse")}, 'No abstract available') AS abstract, source AS search_term,
      CAST(0 AS INT) AS num_hops, concat('{BASE_URL}', 'D', CAST(doc_id AS VARCHAR)) AS url, false AS is_processed
    FROM results r JOIN d_terms t ON r.source = t.term WHERE readable""",
)
def collected_pages(spark, sf):
    staging = Staging(spark, "collect")
    pages = stored_pages(spark, sf, staging)
    terms = tables.document_terms(spark, sf, staging)
    return collect_pages(pages, terms, tables.no_papers(spark), BASE_URL, staging)[0]


@query(
    "collect_rejects",
    RESULTS
    + """SELECT source AS search_term, page, item, 'no id' AS problem FROM results
    WHERE NOT readable AND (source <> 'src8' OR page > 20 OR (page = 20 AND item > 4))""",
)
def collect_rejects(spark, sf):
    """Results without a readable id, of a run that goes on after a stop."""
    staging = Staging(spark, "rejects")
    terms = tables.document_terms(spark, sf, staging)
    rows = listed_rows(stored_pages(spark, sf, staging), terms, BASE_URL, staging, resume=("src8", 20, 4))
    return rejected_results(rows)


# --- streams -----------------------------------------------------------------------------


INGESTED = (
    LANDED_HOP
    + """SELECT id, ss_id, title, abstract, search_term, num_hops, url, true AS is_processed FROM g_papers
    UNION ALL SELECT * FROM hop1"""
)


def ingested(spark, sf, later_first):
    """The corpus after look-ups landed in two parts by term; the second start goes on from the first one's checkpoint."""
    staging = Staging(spark, "stream")
    landing, checkpoint = staging.path("landing"), staging.path("checkpoint")
    terms = tables.part_terms(spark, sf, staging)
    papers = tables.part_papers(spark, sf)
    corpus = Corpus.below(staging.path("corpus"))
    corpus.create(spark)
    corpus.seed(papers)
    # Parts get the positions of their terms before there are bodies to move.
    ranked = papers.join(terms, papers["search_term"] == terms["term"]).select(F.col("id").alias("p_partkey"), "term_pos")
    looked_up = tables.table(spark, sf, "part").join(ranked, "p_partkey")
    responses = staging.write(tables.landed_responses(spark, sf, looked_up, ["term_pos"]), "responses")
    parts = (F.col("term_pos") < 10, F.col("term_pos") >= 10)
    for part in reversed(parts) if later_first else parts:
        responses.filter(part).drop("term_pos").write.mode("append").parquet(landing)
        ingest_responses(spark, landing, corpus, terms, 0, checkpoint, by_order=later_first).awaitTermination()
    if later_first:
        settle(corpus, spark, 0, 1000)
    return corpus


@query("stream_ingest", INGESTED)
def stream_ingest(spark, sf):
    return ingested(spark, sf, later_first=False).read_papers(spark)


@query("stream_ingest_any_order", INGESTED)
def stream_ingest_any_order(spark, sf):
    """The look-ups of the later terms land first; papers get the values and ids that one batch gives them."""
    return ingested(spark, sf, later_first=True).read_papers(spark)


FIRST_EVENTS = """SELECT user_id, event_id, event_type FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS place FROM events) e WHERE place = 1"""


def first_events(spark, sf, later_first):
    staging = Staging(spark, "seen")
    landing, target, checkpoint = staging.path("landing"), staging.path("first"), staging.path("checkpoint")
    events = tables.table(spark, sf, "events").select("user_id", "event_id", "event_type")
    half = events.agg(F.expr("(min(event_id) + max(event_id)) div 2").alias("half")).first()["half"]
    parts = (F.col("event_id") <= half, F.col("event_id") > half)
    for part in reversed(parts) if later_first else parts:
        events.filter(part).write.mode("append").parquet(landing)
        first_seen(spark, landing, events.schema, target, "user_id", ["event_id"], checkpoint, by_order=later_first).awaitTermination()
    return read_first(spark, target, events.schema, "user_id", ["event_id"])


@query("stream_first_seen", FIRST_EVENTS)
def stream_first_seen(spark, sf):
    """First event per user, with the events landed in two parts."""
    return first_events(spark, sf, later_first=False)


@query("stream_first_seen_any_order", FIRST_EVENTS)
def stream_first_seen_any_order(spark, sf):
    """The same, with the later half of the events landed first."""
    return first_events(spark, sf, later_first=True)
