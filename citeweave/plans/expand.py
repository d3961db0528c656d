"""Growing the corpus along citations, hop by hop.

One job handles all terms of a hop: it reads only papers at hop ``h`` and adds only papers at
hop ``h + 1``, so the result is that of taking the terms one after the other. Discovery order
is the term's position, then the parent's id, citations before references, then the place in
the list of neighbours; the first discovery of a paper gives its values.
"""

from __future__ import annotations

from functools import cached_property, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeweave.functions.payload import flatten_neighbours, parse_responses, rejected_neighbours, valid_neighbours
from citeweave.operators.frontier import lookup_frontier
from citeweave.operators.identity import dense_position
from citeweave.operators.neighbours import as_edges, both_directions, neighbours
from citeweave.operators.upsert import as_papers, discover, first_discovery, improved, mark_processed, matching, new_edges, numbered_rows, unseen
from citeweave.schemas import EDGES, NO_ABSTRACT, PAYLOAD_ORDER, UNTITLED
from citeweave.sources.links import Links
from citeweave.sources.terms import first_positions
from citeweave.staging import Staging, broadcastable


class Hop:
    """What one hop adds; each part is worked out when it is asked for.

    ``papers`` are the new papers, ``edges`` the new edges, ``processed`` the keys of the
    parents that are done, ``rejects`` what the look-ups held but could not be used.
    """

    papers: DataFrame
    edges: DataFrame
    processed: DataFrame


def with_attributes(found: DataFrame, attributes: DataFrame | None, staged: DataFrame) -> DataFrame:
    """Title, abstract and url of discovered papers, with the defaults where nothing is known.

    ``staged`` holds the keys of ``found`` as a written table.
    """
    if attributes is None:
        missing = F.lit(None).cast("string")
        named = found.withColumns({"title": missing, "abstract": missing, "url": missing})
    else:
        fields = attributes.select("ss_id", "title", "abstract", "url")
        # A key that comes twice counts with its smallest values, so no paper is doubled.
        single = first_discovery(matching(fields, staged, ["ss_id"]), "ss_id", ("title", "abstract", "url"))
        named = found.join(single, "ss_id", "left")
    return named.withColumns(
        {"title": F.coalesce("title", F.lit(UNTITLED)), "abstract": F.coalesce("abstract", F.lit(NO_ABSTRACT))}
    )


class EdgeHop(Hop):
    """One hop over a known edge table.

    Every parent gets its turn as one number, so a discovery is the number ``2 * turn +
    direction``: finding the first one hashes and shuffles keys and numbers only. Terms and
    ``attributes`` are looked up for the new papers alone.
    """

    def __init__(
        self,
        papers: DataFrame,
        edges: DataFrame | Links,
        terms: DataFrame,
        hop: int,
        staging: Staging,
        *,
        attributes: DataFrame | None = None,
        known_edges: DataFrame | None = None,
    ):
        """``edges`` is a table of edges, or a link table in slices, of which the hop reads those of its frontier."""
        self._known, self._known_edges, self._attributes = papers, known_edges, attributes
        self._hop, self._staging = hop, staging
        waiting = lookup_frontier(papers, first_positions(terms), hop)
        self._frontier = dense_position(waiting, ["term_pos", "parent_id"], staging, column="turn")
        links = edges.of(self._frontier) if isinstance(edges, Links) else both_directions(edges)
        found = neighbours(self._frontier.select("parent_ss_id", "turn"), links)
        # Papers and edges both come from it, so the join with the edges is done once.
        self._found = staging.write(found.select("parent_ss_id", "turn", "direction", "ss_id"), f"found-{hop}")

    @cached_property
    def papers(self) -> DataFrame:
        number = F.col("turn") * 2 + F.col("direction")
        candidates = self._found.select("ss_id", number.alias("discovery"))
        fresh = discover(candidates, self._known, ["discovery"], self._staging)
        turns = self._frontier.select("turn", "search_term")
        placed = fresh.withColumn("turn", F.shiftright("discovery", 1)).join(turns, "turn")
        placed = placed.select("id", "ss_id", "search_term", F.lit(self._hop + 1).alias("num_hops"))
        return as_papers(with_attributes(placed, self._attributes, fresh))

    @cached_property
    def edges(self) -> DataFrame:
        linked = as_edges(self._found)
        return linked if self._known_edges is None else new_edges(linked, self._known_edges)

    @cached_property
    def processed(self) -> DataFrame:
        return self._frontier.select(F.col("parent_ss_id").alias("ss_id"))


class ResponseHop(Hop):
    """One hop over landed look-ups.

    The frontier is cut to the parents that have landed, and look-ups of other parents are left unread as far
    as the planner would broadcast the frontier; beyond that size bodies stay where they lie, and what other
    parents brought goes with the join. Bodies are parsed once and written flat before anything
    is joined, and only keys and places meet the frontier. Titles and abstracts move once, for the new
    papers. Parents with a landed look-up are done afterwards, failed ones included, unless ``retry_failed``
    leaves those for another run. ``after`` is the highest id in use, ``look_up`` reduces the known papers to some keys.
    """

    def __init__(
        self,
        papers: DataFrame,
        responses: DataFrame,
        terms: DataFrame,
        hop: int,
        staging: Staging,
        *,
        known_edges: DataFrame | None = None,
        done: DataFrame | None = None,
        retry_failed: bool = False,
        reject_missing: bool = False,
        after: int | None = None,
        look_up=matching,
    ):
        self._known, self._known_edges, self._responses = papers, known_edges, responses
        self._hop, self._staging, self._retry_failed = hop, staging, retry_failed
        self._after, self._look_up = after, look_up
        # A hub has many pages of look-ups, so its key is made single before any join.
        answered = staging.write(responses.select("ss_id").distinct(), f"answered-{hop}")
        waiting = lookup_frontier(look_up(papers, answered, ["ss_id"]), first_positions(terms), hop, done)
        self._frontier = staging.write(waiting, f"frontier-{hop}")
        landed = responses.select(F.col("ss_id").alias("parent_ss_id"), "direction", "page", "status", "body")
        if broadcastable(self._frontier):
            landed = matching(landed, self._frontier, ["parent_ss_id"])
        flat = flatten_neighbours(parse_responses(landed), "parent_ss_id", reject_missing=reject_missing)
        self._flat = staging.write(numbered_rows(flat), f"neighbours-{hop}")
        places = self._flat.select("parent_ss_id", "direction", "page", "pos", "ss_id", "problem", "row_id")
        self._placed = staging.write(places.join(self._frontier, "parent_ss_id"), f"places-{hop}")

    def _keys(self) -> DataFrame:
        return valid_neighbours(self._placed).select("ss_id", *PAYLOAD_ORDER, "row_id")

    def _with_texts(self, chosen: DataFrame) -> DataFrame:
        """Title, abstract, url, term and hop of written rows that are told by their ``row_id``."""
        terms = matching(self._placed.select("row_id", "search_term"), chosen, ["row_id"])
        texts = self._flat.select("row_id", "title", "abstract", "url")
        return texts.join(chosen.join(terms, "row_id"), "row_id").withColumn("num_hops", F.lit(self._hop + 1))

    @cached_property
    def papers(self) -> DataFrame:
        found = discover(self._keys(), self._known, PAYLOAD_ORDER, self._staging, after=self._after, look_up=self._look_up)
        return as_papers(self._with_texts(self._staging.write(found.select("row_id", "id", "ss_id"), "chosen")))

    def discoveries(self, versions: DataFrame) -> DataFrame:
        """The first discoveries in this batch that come before all ``versions`` so far, of papers that are not known."""
        first = self._staging.write(first_discovery(self._keys(), "ss_id", PAYLOAD_ORDER), "first-discovery")
        fresh = unseen(first, self._look_up(self._known.select("ss_id"), first, ["ss_id"]), ["ss_id"])
        better = improved(self._staging.write(fresh, "fresh"), versions, "ss_id", PAYLOAD_ORDER, self._look_up)
        return self._with_texts(self._staging.write(better, "better"))

    @cached_property
    def edges(self) -> DataFrame:
        linked = as_edges(valid_neighbours(self._placed))
        return linked if self._known_edges is None else new_edges(linked, self._known_edges)

    @cached_property
    def processed(self) -> DataFrame:
        parents = self._frontier.select(F.col("parent_ss_id").alias("ss_id"))
        if self._retry_failed:
            failed = self._responses.filter(~F.coalesce(F.col("status") == 200, F.lit(False)))
            parents = parents.join(failed.select("ss_id").distinct(), "ss_id", "left_anti")
        return parents

    @cached_property
    def rejects(self) -> DataFrame:
        return rejected_neighbours(self._placed).select(
            "search_term", "parent_ss_id", "direction", "page", "pos", "problem"
        )


def expand_hops(
    papers: DataFrame,
    edges: DataFrame | Links,
    terms: DataFrame,
    hops: int,
    staging: Staging,
    *,
    attributes: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """All papers after up to ``hops`` hops, with the flags of the parents set, and the edges met.

    Only what a hop adds is written, and the next hop reads it back: the papers known before
    are never copied, and plans grow by one scan per hop. Flags are set once at the end, since
    the parents of a hop are new papers of the hop before. The loop ends early when a hop
    finds nothing.
    """
    known, processed, met = papers, [], None
    for hop in range(hops):
        step = EdgeHop(known, edges, terms, hop, staging, attributes=attributes)
        added, some = staging.write_some(step.papers, f"papers-{hop + 1}")
        processed.append(step.processed)
        # A hop inserts its edges whether or not they lead to a new paper.
        found = staging.write(step.edges if met is None else new_edges(step.edges, met), f"edges-{hop + 1}")
        met = found if met is None else met.unionByName(found)
        known = known.unionByName(added)
        if not some:
            break
    if met is None:
        met = papers.sparkSession.createDataFrame([], EDGES)
    return mark_processed(known, reduce(DataFrame.unionByName, processed)) if processed else known, met
