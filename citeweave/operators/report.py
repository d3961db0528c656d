"""Counts over the corpus and the collated view of its look-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from citeweave.operators.frontier import unprocessed
from citeweave.operators.identity import place_within
from citeweave.operators.neighbours import both_directions
from citeweave.schemas import CITATION, REFERENCE
from citeweave.staging import Staging

BATCH_SIZE = 300
SHARE_ROWS = 1_000
HUB_LINKS = 1_000_000
BUCKETS = 1 << 14


def processed_per_term(papers: DataFrame) -> DataFrame:
    """How many papers of each search term are done; papers without a term form a group."""
    return papers.filter("is_processed").groupBy("search_term").agg(F.count("*").alias("count"))


def batch_counts(papers: DataFrame, batch_size: int = BATCH_SIZE) -> DataFrame:
    """Per term and hop: papers seen, papers to fetch, and batches of the given size."""
    return (
        papers.groupBy("search_term", "num_hops")
        .agg(F.count("*").alias("seen"), F.count_if(~F.coalesce("is_processed", F.lit(False))).alias("fetched"))
        .withColumn("batches", F.ceil(F.col("seen") / batch_size))
    )


def newly_fetched(papers: DataFrame) -> DataFrame:
    """Ids that a run would look up."""
    return unprocessed(papers).select("id")


def latest_per_key(rows: DataFrame, key: str, version: str) -> DataFrame:
    """Per key the row of the highest version; reduced in each task before the shuffle."""
    latest = F.max_by(F.struct(*rows.columns), F.col(version)).alias("latest")
    return rows.groupBy(key).agg(latest).select("latest.*")


def _placed(papers: DataFrame, edges: DataFrame, staging: Staging, hub: int) -> DataFrame:
    """The links of every paper with its id and their places, as a written table.

    Links are counted by a hash of their list. Lists of buckets with at most ``hub`` links are numbered by a window where they are
    dealt for the join; those of other buckets, hubs among them, are joined first and numbered in a sort by ranges.
    """
    links = both_directions(edges).withColumnsRenamed({"ss_id": "neighbour", "parent_ss_id": "ss_id"}).where("ss_id IS NOT NULL")
    named = papers.where("ss_id IS NOT NULL").select("id", "ss_id")
    bucket = F.pmod(F.xxhash64("ss_id", "direction"), F.lit(BUCKETS))
    large = links.groupBy(bucket.alias("bucket")).count().where(F.col("count") > hub).select("bucket")
    # At most one number for each ``hub`` links.
    large = [row["bucket"] for row in large.collect()]
    few = links.where(~bucket.isin(large)) if large else links
    numbered = few.repartition("ss_id").withColumn("place", F.row_number().over(Window.partitionBy("ss_id", "direction").orderBy("neighbour")) - 1)
    # Papers that repeat a key share its places: each has every ``copies``-th one.
    same = Window.partitionBy("ss_id")
    copies = named.withColumns({"copy": F.row_number().over(same.orderBy("id")) - 1, "copies": F.count(F.lit(1)).over(same)})
    columns = ["id", "ss_id", "direction", "neighbour"]
    placed = numbered.join(copies, "ss_id").select(*columns, (F.col("place") * F.col("copies") + F.col("copy")).alias("place"))
    if large:
        linked = links.where(bucket.isin(large)).join(named, "ss_id").select(*columns)
        placed = placed.unionByName(place_within(linked, ["ss_id", "direction"], ["neighbour"], staging))
    return staging.write(placed, "places")


def collated(papers: DataFrame, edges: DataFrame, staging: Staging, hub: int = HUB_LINKS) -> DataFrame:
    """One row per paper, direction and place: the neighbours of every paper with what is known of them.

    ``place`` counts from 0 in the order of the neighbours' keys. Every neighbour is a row, however many
    a paper has; a paper without neighbours has one row with a null direction. Neighbours that
    are no papers of the corpus have null fields. Links get ids and places as narrow rows; a hub, a paper with more than ``hub``
    links in a direction, fills as many ranges as it needs. Titles and abstracts are joined last, to each direction by
    itself, which halves what a task sorts, and not moved again.
    """
    placed = _placed(papers, edges, staging, hub)
    known = papers.select(F.col("ss_id").alias("neighbour"), "title", "abstract", "url")
    columns = ["id", "ss_id", "direction", "place", "neighbour", "title", "abstract", "url"]
    citations, references = (placed.where(F.col("direction") == way).join(known, "neighbour", "left").select(*columns) for way in (CITATION, REFERENCE))
    rows = citations.unionByName(references)
    # A hub's key is made single before the join.
    alone = papers.select("id", "ss_id").join(placed.select("ss_id").distinct(), "ss_id", "left_anti")
    missing = [F.lit(None).cast(rows.schema[name].dataType).alias(name) for name in columns[2:]]
    return rows.unionByName(alone.select("id", "ss_id", *missing))


def collated_json(rows: DataFrame) -> DataFrame:
    """Each collated row as one JSON text; null fields are left out."""
    neighbour = F.when(F.col("neighbour").isNotNull(), F.struct(F.col("neighbour").alias("ss_id"), "title", "abstract", "url"))
    body = F.to_json(F.struct("ss_id", "direction", "place", neighbour.alias("neighbour")))
    return rows.select("id", "direction", "place", body.alias("body"))


def adjacency(rows: DataFrame, staging: Staging, share: int = SHARE_ROWS) -> DataFrame:
    """Collated rows as lists: one row per paper, direction and ``share`` of places, in order.

    The grain is the same for every paper, and no list is longer than ``share``. Each share is
    grouped by itself, so the lists of a hub are built by many tasks. Rows are dealt by share as they are
    joined, and lists are made where they have come to lie: texts move once and are not written before.
    """
    keys = ["id", "ss_id", "direction", "part"]
    placed = rows.where("direction IS NOT NULL").withColumn("part", F.floor(F.col("place") / share))
    neighbour = F.struct("place", F.col("neighbour").alias("ss_id"), "title", "abstract", "url")
    return placed.repartition(*keys).groupBy(*keys).agg(F.sort_array(F.collect_list(neighbour)).alias("neighbours"))
