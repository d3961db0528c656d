"""Queries over edges: neighbours, upserts, checks, subsets, expansion."""

from __future__ import annotations

from pyspark.sql import functions as F

from citeweave.operators import checks, neighbours, report, subset, upsert
from citeweave.operators.frontier import lookup_frontier
from citeweave.plans.curate import copy_seed, curated_edges
from citeweave.plans.expand import EdgeHop, expand_hops
from citeweave.plans.validate import check_orphans, validate
from citeweave.schemas import EDGES, PAPERS
from citeweave.sources.corpus import Corpus
from citeweave.sources.links import read_links, write_links
from citeweave.sources.tables import scan_table
from citeweave.sources.terms import slice_inclusive
from citeweave.staging import Staging
from workload import tables
from workload.registry import query

# Parts at hop 1 and orders at hops 0 and 1, as one table of papers.
ALL_PAPERS = """, k_papers AS (
  SELECT id, ss_id, title, abstract, search_term, num_hops, url, is_processed FROM o_papers
  UNION ALL
  SELECT 1000000000000 + id, ss_id, title, abstract, search_term, CAST(1 AS INT), url, is_processed FROM g_papers)
"""


def all_papers(spark, sf):
    columns = PAPERS.fieldNames()
    parts = tables.part_papers(spark, sf).withColumns(
        {"id": F.col("id") + 1_000_000_000_000, "num_hops": F.lit(1)}
    )
    return tables.order_papers(spark, sf).select(*columns).unionByName(parts.select(*columns))


# --- neighbours --------------------------------------------------------------------------

IN_ROWS = """SELECT t.term_pos, p.id AS parent_id, CAST(0 AS INT) AS direction, e.ss_id, p.search_term, p.ss_id AS parent_ss_id
  FROM g_papers p JOIN g_terms t ON p.search_term = t.term JOIN g_edges e ON e.reference_id = p.ss_id
  WHERE NOT p.is_processed"""
OUT_ROWS = """SELECT t.term_pos, p.id AS parent_id, CAST(1 AS INT) AS direction, e.reference_id AS ss_id, p.search_term, p.ss_id AS parent_ss_id
  FROM o_papers p JOIN o_terms t ON p.search_term = t.term JOIN g_edges e ON e.ss_id = p.ss_id
  WHERE NOT p.is_processed AND p.num_hops = 0"""


NEIGHBOUR = ["term_pos", "parent_id", "direction", "ss_id", "search_term", "parent_ss_id"]


def part_frontier(spark, sf, staging):
    return lookup_frontier(tables.part_papers(spark, sf), tables.part_terms(spark, sf, staging), 0)


def order_frontier(spark, sf, staging):
    return lookup_frontier(tables.order_papers(spark, sf), tables.order_terms(spark, sf, staging), 0)


@query("neighbours_in", IN_ROWS)
def neighbours_in(spark, sf):
    links = neighbours.citations_of(tables.part_edges(spark, sf))
    return neighbours.neighbours(part_frontier(spark, sf, Staging(spark, "in")), links).select(*NEIGHBOUR)


@query("neighbours_out", OUT_ROWS)
def neighbours_out(spark, sf):
    links = neighbours.references_of(tables.part_edges(spark, sf))
    return neighbours.neighbours(order_frontier(spark, sf, Staging(spark, "out")), links).select(*NEIGHBOUR)


@query("neighbours_both", f"SELECT * FROM ({IN_ROWS}) i UNION ALL SELECT * FROM ({OUT_ROWS}) o")
def neighbours_both(spark, sf):
    staging = Staging(spark, "both")
    frontier = part_frontier(spark, sf, staging).unionByName(order_frontier(spark, sf, staging))
    links = neighbours.both_directions(tables.part_edges(spark, sf))
    return neighbours.neighbours(frontier, links).select(*NEIGHBOUR)


@query(
    "first_discovery",
    f"""SELECT ss_id, term_pos, parent_id, direction, search_term, parent_ss_id FROM (
      SELECT *, row_number() OVER (PARTITION BY ss_id ORDER BY term_pos, parent_id, direction) AS place
      FROM ({IN_ROWS}) i) r WHERE place = 1""",
)
def first_discovery(spark, sf):
    return upsert.first_discovery(neighbours_in(spark, sf), "ss_id", ("term_pos", "parent_id", "direction"))


@query("edges_distinct", "SELECT ss_id, reference_id FROM g_edges")
def edges_distinct(spark, sf):
    return tables.part_edges(spark, sf)


@query(
    "edges_union_distinct",
    """SELECT ss_id, reference_id FROM raw_edges WHERE l_returnflag = 'A'
    UNION SELECT ss_id, reference_id FROM raw_edges WHERE l_linestatus = 'F'""",
)
def edges_union_distinct(spark, sf):
    raw = tables.raw_edges(spark, sf)
    returned, filled = raw.filter("l_returnflag = 'A'"), raw.filter("l_linestatus = 'F'")
    return returned.union(filled).select("ss_id", "reference_id").distinct()


# --- subsets -----------------------------------------------------------------------------


@query(
    "edges_semi_seed",
    ALL_PAPERS + "SELECT * FROM g_edges WHERE ss_id IN (SELECT ss_id FROM k_papers WHERE num_hops = 0)",
)
def edges_semi_seed(spark, sf):
    return subset.edges_from(tables.part_edges(spark, sf), all_papers(spark, sf).filter("num_hops = 0"))


@query(
    "edges_curated",
    ALL_PAPERS
    + """SELECT * FROM g_edges WHERE ss_id IN (SELECT ss_id FROM k_papers WHERE is_processed)
    AND reference_id IN (SELECT ss_id FROM k_papers WHERE is_processed)""",
)
def edges_curated(spark, sf):
    return curated_edges(tables.part_edges(spark, sf), all_papers(spark, sf).filter("is_processed"))


def copied(spark, sf, which):
    """Both copies, appended to another folder and read back from there."""
    staging = Staging(spark, "copy")
    target = staging.root
    edges = spark.createDataFrame([], EDGES)
    rows = copy_seed(all_papers(spark, sf), tables.part_edges(spark, sf), tables.no_papers(spark), edges, staging)
    names = ("papers", "references")
    rows[which].write.mode("append").parquet(f"{target}/{names[which]}")
    return scan_table(spark, names[which], folder=target)


@query("copy_seed_papers", ALL_PAPERS + "SELECT * FROM k_papers WHERE num_hops = 0")
def copy_seed_papers(spark, sf):
    return copied(spark, sf, 0)


@query(
    "copy_seed_edges",
    ALL_PAPERS + "SELECT * FROM g_edges WHERE ss_id IN (SELECT ss_id FROM k_papers WHERE num_hops = 0)",
)
def copy_seed_edges(spark, sf):
    return copied(spark, sf, 1)


# --- checks ------------------------------------------------------------------------------

SOME_PAPERS = ALL_PAPERS.rstrip() + """, some_papers AS (
  SELECT * FROM k_papers WHERE ss_id NOT IN (SELECT ss_id FROM o_papers WHERE o_orderstatus = 'P'))
"""


def papers_with_gaps(spark, sf):
    """All papers but the orders of one status, so that edges of those are orphans."""
    return all_papers(spark, sf).filter("abstract <> 'Status P'")


@query(
    "orphan_edges",
    SOME_PAPERS
    + """SELECT * FROM g_edges WHERE ss_id NOT IN (SELECT ss_id FROM some_papers)
    OR reference_id NOT IN (SELECT ss_id FROM some_papers)""",
)
def orphan_edges(spark, sf):
    staging = Staging(spark, "orphans")
    edges = staging.write(tables.part_edges(spark, sf), "edges")
    return checks.orphan_edges(edges, papers_with_gaps(spark, sf), staging)


@query(
    "orphan_edges_kept",
    SOME_PAPERS
    + """SELECT * FROM g_edges WHERE ss_id NOT IN (SELECT ss_id FROM some_papers)
    OR reference_id NOT IN (SELECT ss_id FROM some_papers)""",
)
def orphan_edges_kept(spark, sf):
    """The same orphans, kept up to date over two batches: parts and some edges first, then orders and the other edges."""
    corpus = Corpus.below(Staging(spark, "kept").path("corpus"))
    corpus.create(spark)
    papers, edges = papers_with_gaps(spark, sf), tables.part_edges(spark, sf)
    early = F.pmod(F.xxhash64("ss_id"), F.lit(3)) > 0
    for batch, (some_papers, some_edges) in enumerate((("id > 1000000000000", early), ("id <= 1000000000000", ~early))):
        with corpus.batch(spark, 2 * batch) as out:
            out.append("papers", papers.filter(some_papers))
            out.append("edges", edges.filter(some_edges))
        orphans = check_orphans(corpus, spark, 2 * batch + 1)
    return orphans.select("ss_id", "reference_id")


@query("violations_not_null", "SELECT id, ss_id FROM d_papers WHERE is_processed IS NULL OR title IS NULL")
def violations_not_null(spark, sf):
    return checks.null_violations(tables.document_papers(spark, sf), ["is_processed", "title"]).select("id", "ss_id")


@query(
    "violations_unique",
    "SELECT ss_id, reference_id, count(*) AS n FROM raw_edges GROUP BY ss_id, reference_id HAVING count(*) > 1",
)
def violations_unique(spark, sf):
    return checks.repeated_keys(tables.raw_edges(spark, sf), ["ss_id", "reference_id"])


@query(
    "validate_report",
    SOME_PAPERS.rstrip()
    + """, checked AS (SELECT id, ss_id, CASE WHEN num_hops = 1 AND is_processed THEN NULL ELSE title END AS title, abstract FROM some_papers)
    SELECT 'papers not null id' AS "check", count(*) FILTER (id IS NULL) AS violations FROM checked
    UNION ALL SELECT 'papers not null ss_id', count(*) FILTER (ss_id IS NULL) FROM checked
    UNION ALL SELECT 'papers not null title', count(*) FILTER (title IS NULL) FROM checked
    UNION ALL SELECT 'papers not null abstract', count(*) FILTER (abstract IS NULL) FROM checked
    UNION ALL SELECT 'edges not null ss_id', count(*) FILTER (ss_id IS NULL) FROM raw_edges
    UNION ALL SELECT 'edges not null reference_id', count(*) FILTER (reference_id IS NULL) FROM raw_edges
    UNION ALL SELECT 'papers unique id', count(*) FROM (SELECT id FROM checked GROUP BY id HAVING count(*) > 1)
    UNION ALL SELECT 'papers unique ss_id', count(*) FROM (SELECT ss_id FROM checked GROUP BY ss_id HAVING count(*) > 1)
    UNION ALL SELECT 'edges unique pair', count(*) FROM (
      SELECT ss_id, reference_id FROM raw_edges GROUP BY ss_id, reference_id HAVING count(*) > 1)
    UNION ALL SELECT 'edges ends are papers', count(*) FROM raw_edges
      WHERE ss_id NOT IN (SELECT ss_id FROM checked) OR reference_id NOT IN (SELECT ss_id FROM checked)""",
)
def validate_report(spark, sf):
    papers = papers_with_gaps(spark, sf)
    gap = (F.col("num_hops") == 1) & F.col("is_processed")
    papers = papers.withColumn("title", F.when(~F.coalesce(gap, F.lit(False)), F.col("title")))
    return validate(papers, tables.raw_edges(spark, sf).select("ss_id", "reference_id"), Staging(spark, "validate"))


# --- upserts -----------------------------------------------------------------------------


@query(
    "new_papers_anti",
    "SELECT id, ss_id, search_term FROM d_papers WHERE ss_id NOT IN (SELECT ss_id FROM d_papers WHERE is_processed)",
)
def new_papers_anti(spark, sf):
    papers = tables.document_papers(spark, sf)
    return upsert.unseen(papers.select("id", "ss_id", "search_term"), papers.filter("is_processed"), ["ss_id"])


@query(
    "insert_or_ignore_papers",
    """, known AS (SELECT id, ss_id FROM o_papers WHERE o_orderstatus = 'P'),
    cand AS (
      SELECT e.ss_id, p.title, coalesce(nullif(p.abstract, 'ECONOMY'), 'No abstract available') AS abstract,
             p.url, p.search_term, t.term_pos, p.id AS parent_id
      FROM g_edges e JOIN g_papers p ON e.reference_id = p.ss_id JOIN g_terms t ON p.search_term = t.term
      WHERE p.abstract <> 'PROMO'),
    first AS (
      SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ss_id ORDER BY term_pos, parent_id) AS place FROM cand) c
      WHERE place = 1 AND ss_id NOT IN (SELECT ss_id FROM known))
    SELECT CAST((SELECT max(id) FROM known) + row_number() OVER (ORDER BY term_pos, parent_id, ss_id) AS BIGINT) AS id, ss_id,
           title, abstract, search_term, CAST(1 AS INT) AS num_hops, url, false AS is_processed FROM first""",
)
def insert_or_ignore_papers(spark, sf):
    """Orders take the values of the first part they hold; parts without a title do not count."""
    staging = Staging(spark, "insert")
    parts = tables.part_papers(spark, sf)
    terms = tables.part_terms(spark, sf, staging)
    sources = parts.join(terms, parts["search_term"] == terms["term"]).select(
        F.col("ss_id").alias("reference_id"),
        F.when(F.col("abstract") != "PROMO", F.col("title")).alias("title"),
        F.nullif("abstract", F.lit("ECONOMY")).alias("abstract"),
        "url",
        "search_term",
        "term_pos",
        F.col("id").alias("parent_id"),
        F.lit(1).alias("num_hops"),
    )
    candidates = tables.part_edges(spark, sf).join(sources, "reference_id").drop("reference_id")
    known = tables.order_papers(spark, sf).filter("o_orderstatus = 'P'")
    return upsert.new_papers(candidates, known, ("term_pos", "parent_id"), staging)


@query(
    "insert_or_ignore_edges",
    SOME_PAPERS
    + """SELECT DISTINCT ss_id, reference_id FROM raw_edges r
    WHERE NOT EXISTS (SELECT 1 FROM raw_edges k WHERE k.l_returnflag = 'R' AND k.ss_id = r.ss_id AND k.reference_id = r.reference_id)
    AND ss_id IN (SELECT ss_id FROM some_papers) AND reference_id IN (SELECT ss_id FROM some_papers)""",
)
def insert_or_ignore_edges(spark, sf):
    raw = tables.raw_edges(spark, sf)
    staging = Staging(spark, "edges")
    fresh = staging.write(upsert.new_edges(raw, raw.filter("l_returnflag = 'R'")), "fresh")
    sound, _orphans = upsert.split_by_ends(fresh, papers_with_gaps(spark, sf), staging)
    return sound


@query(
    "edges_orphaned",
    SOME_PAPERS
    + """SELECT DISTINCT ss_id, CASE WHEN l_linestatus = 'F' THEN NULL ELSE reference_id END AS reference_id FROM raw_edges
    WHERE ss_id NOT IN (SELECT ss_id FROM some_papers) OR reference_id NOT IN (SELECT ss_id FROM some_papers) OR l_linestatus = 'F'""",
)
def edges_orphaned(spark, sf):
    """Edges that may not be inserted: an end is no paper, or missing."""
    staging = Staging(spark, "orphaned")
    cited = F.when(F.col("l_linestatus") != "F", F.col("reference_id"))
    edges = staging.write(tables.raw_edges(spark, sf).select("ss_id", cited.alias("reference_id")).distinct(), "edges")
    return upsert.split_by_ends(edges, papers_with_gaps(spark, sf), staging)[1]


@query("newly_fetched", "SELECT id FROM d_papers WHERE NOT coalesce(is_processed, false)")
def newly_fetched(spark, sf):
    return report.newly_fetched(tables.document_papers(spark, sf))


@query("schema_upgrade_edges", "SELECT ss_id, reference_id FROM raw_edges")
def schema_upgrade_edges(spark, sf):
    return upsert.upgrade_edges(tables.raw_edges(spark, sf).withColumnRenamed("ss_id", "paper_id"))


@query(
    "mark_processed",
    """SELECT id, ss_id, search_term, CASE WHEN id IN (SELECT doc_id FROM labels WHERE toxic = 1) THEN true
       ELSE is_processed END AS is_processed FROM d_papers""",
)
def mark_processed(spark, sf):
    papers = tables.document_papers(spark, sf).select("id", "ss_id", "search_term", "is_processed")
    done = tables.table(spark, sf, "labels").filter("toxic = 1")
    keys = done.select(F.concat(F.lit("D"), F.col("doc_id").cast("string")).alias("ss_id"))
    return upsert.mark_processed(papers, keys)


@query(
    "schema_upgrade",
    """SELECT id, ss_id, title, abstract, search_term, num_hops, url, false AS is_processed, false AS is_cleaned FROM g_papers""",
)
def schema_upgrade(spark, sf):
    legacy = tables.table(spark, sf, "part").select(
        F.col("p_partkey").cast("int").alias("id"),
        F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("paper_id"),
        F.lit(None).cast("string").alias("corpus_id"),
        F.col("p_name").alias("title"),
        F.col("p_brand").alias("author"),
        F.lit(None).cast("string").alias("publication_date"),
        F.col("p_type").alias("abstract"),
        F.col("p_brand").alias("search_term"),
        F.lit(0).alias("num_hops"),
        F.concat(F.lit("/part/"), F.col("p_partkey").cast("string")).alias("url"),
    )
    return upsert.upgrade_papers(legacy)


# --- collated lists ----------------------------------------------------------------------

COLLATED = ALL_PAPERS.rstrip() + """, links AS (
  SELECT reference_id AS ss_id, CAST(0 AS INT) AS direction, ss_id AS neighbour FROM g_edges
  UNION ALL SELECT ss_id, CAST(1 AS INT), reference_id FROM g_edges),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY ss_id, direction ORDER BY neighbour) - 1 AS place FROM links),
rows AS (
  SELECT p.id, p.ss_id, l.direction, l.place, l.neighbour, n.title, n.abstract, n.url
  FROM k_papers p LEFT JOIN placed l ON l.ss_id = p.ss_id LEFT JOIN k_papers n ON n.ss_id = l.neighbour)
"""


def collated(spark, sf, staging):
    """Orders with the parts they cite and parts with the orders that cite them."""
    edges = staging.write(tables.part_edges(spark, sf), "edges")
    return report.collated(all_papers(spark, sf), edges, staging)


@query("collated_rows", COLLATED + "SELECT * FROM rows")
def collated_rows(spark, sf):
    return collated(spark, sf, Staging(spark, "collated"))


@query(
    "adjacency_nested",
    COLLATED
    + """SELECT id, ss_id, direction, place // 1000 AS part, count(*) AS n, string_agg(neighbour, ',' ORDER BY place) AS neighbours,
      string_agg(title, ',' ORDER BY place) AS titles, string_agg(url, ',' ORDER BY place) AS urls
    FROM rows WHERE direction IS NOT NULL GROUP BY id, ss_id, direction, place // 1000""",
)
def adjacency_nested(spark, sf):
    staging = Staging(spark, "lists")
    lists = report.adjacency(collated(spark, sf, staging), staging)
    joined = [F.array_join(f"neighbours.{field}", ",").alias(name) for field, name in (("ss_id", "neighbours"), ("title", "titles"), ("url", "urls"))]
    return lists.select("id", "ss_id", "direction", "part", F.size("neighbours").cast("long").alias("n"), *joined)


@query(
    "adjacency_json",
    COLLATED
    + """SELECT id, direction, place, CASE WHEN direction IS NULL THEN concat('{"ss_id":"', ss_id, '"}') ELSE
      concat('{"ss_id":"', ss_id, '","direction":', CAST(direction AS VARCHAR), ',"place":', CAST(place AS VARCHAR), ',"neighbour":{"ss_id":"', neighbour,
             '","title":"', title, '","abstract":"', abstract, '","url":"', url, '"}}') END AS body FROM rows""",
)
def adjacency_json(spark, sf):
    return report.collated_json(collated(spark, sf, Staging(spark, "json")))


# --- expansion ---------------------------------------------------------------------------

FIRST_HOP = """, cand AS (
  SELECT *, row_number() OVER (PARTITION BY ss_id ORDER BY term_pos, parent_id) AS place FROM ({rows}) i),
hop1 AS (
  SELECT CAST((SELECT max(id) FROM {seeds}) + row_number() OVER (ORDER BY c.term_pos, c.parent_id, c.ss_id) AS BIGINT) AS id,
         c.ss_id, o.title, o.abstract, c.search_term, CAST(1 AS INT) AS num_hops, o.url, false AS is_processed
  FROM cand c JOIN o_papers o ON o.ss_id = c.ss_id WHERE c.place = 1)
"""


def hop_one(spark, sf):
    staging = Staging(spark, "hop")
    return EdgeHop(
        tables.part_papers(spark, sf),
        staging.write(tables.part_edges(spark, sf), "edges"),
        tables.part_terms(spark, sf, staging),
        0,
        staging,
        attributes=tables.order_papers(spark, sf),
    )


@query("expand_hop1_papers", FIRST_HOP.format(rows=IN_ROWS, seeds="g_papers") + "SELECT * FROM hop1")
def expand_hop1_papers(spark, sf):
    return hop_one(spark, sf).papers


@query(
    "expand_hop1_edges",
    "SELECT e.ss_id, e.reference_id FROM g_edges e JOIN g_papers p ON e.reference_id = p.ss_id WHERE NOT p.is_processed",
)
def expand_hop1_edges(spark, sf):
    return hop_one(spark, sf).edges


# All terms but the last one: its papers have to be found anew, else hop 2 would add nothing.
SECOND_HOP = (
    """, listed AS (SELECT * FROM g_terms WHERE term_pos < (SELECT max(term_pos) FROM g_terms)),
    seeds AS (
      SELECT p.*, t.term_pos FROM g_papers p JOIN listed t ON p.search_term = t.term)"""
    + FIRST_HOP.format(rows=IN_ROWS + " AND t.term_pos < (SELECT max(term_pos) FROM g_terms)", seeds="seeds").rstrip()
    + """, cand2 AS (
      SELECT t.term_pos, h.id AS parent_id, e.reference_id AS ss_id, h.search_term,
             row_number() OVER (PARTITION BY e.reference_id ORDER BY t.term_pos, h.id) AS place
      FROM hop1 h JOIN g_terms t ON h.search_term = t.term JOIN g_edges e ON e.ss_id = h.ss_id),
    hop2 AS (
      SELECT CAST((SELECT max(id) FROM hop1) + row_number() OVER (ORDER BY c.term_pos, c.parent_id, c.ss_id) AS BIGINT) AS id,
             c.ss_id, p.title, p.abstract, c.search_term, CAST(2 AS INT) AS num_hops, p.url, false AS is_processed
      FROM cand2 c JOIN g_papers p ON p.ss_id = c.ss_id
      WHERE c.place = 1 AND c.ss_id NOT IN (SELECT ss_id FROM seeds))
"""
)


def two_hops(spark, sf, stored=False):
    """Two hops from the papers of all terms but the last; the papers of that are found anew."""
    staging = Staging(spark, "hops")
    parts = tables.part_papers(spark, sf)
    terms = tables.part_terms(spark, sf, staging)
    last = terms.agg(F.max("term_pos")).first()[0] or 0
    terms = staging.write(slice_inclusive(terms, 0, last - 1), "terms")
    seeds = parts.join(terms.select(F.col("term").alias("search_term")), "search_term", "left_semi")
    columns = ["ss_id", "title", "abstract", "url"]
    attributes = parts.select(*columns).unionByName(tables.order_papers(spark, sf).select(*columns))
    edges = tables.part_edges(spark, sf)
    if stored:
        path = staging.path("links")
        write_links(edges, path)
        edges = read_links(spark, path)
    else:
        edges = staging.write(edges, "edges")
    return expand_hops(seeds.select(*PAPERS.fieldNames()), edges, terms, 2, staging, attributes=attributes)


SECOND_PAPERS = (
    SECOND_HOP
    + """
    SELECT id, ss_id, title, abstract, search_term, num_hops, url, true AS is_processed FROM seeds
    UNION ALL SELECT id, ss_id, title, abstract, search_term, num_hops, url, true FROM hop1
    UNION ALL SELECT * FROM hop2"""
)


@query("expand_hop2_papers", SECOND_PAPERS)
def expand_hop2_papers(spark, sf):
    return two_hops(spark, sf)[0]


@query("expand_hop2_from_links", SECOND_PAPERS)
def expand_hop2_from_links(spark, sf):
    """The same hops over a link table, of which each reads the slices of its frontier."""
    return two_hops(spark, sf, stored=True)[0]


@query(
    "expand_hop2_edges",
    SECOND_HOP
    + """
    SELECT e.ss_id, e.reference_id FROM g_edges e
    WHERE e.reference_id IN (SELECT ss_id FROM seeds WHERE NOT is_processed) OR e.ss_id IN (SELECT ss_id FROM hop1)""",
)
def expand_hop2_edges(spark, sf):
    """The edges that both hops met, each once."""
    return two_hops(spark, sf)[1]
