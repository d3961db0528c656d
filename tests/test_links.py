"""Link tables in slices: all links of a paper in one folder, and hops that open their frontier's alone."""

from pyspark.sql import functions as F

from citeweave.operators.neighbours import both_directions, neighbours, slice_of
from citeweave.schemas import EDGES, PAPERS
from citeweave.plans.expand import expand_hops
from citeweave.sources.links import read_links, write_links
from model import random_corpus
from test_plans import plan_of, settings


def test_links_come_back(spark, frame, values, staging):
    edges = frame([("a", "b"), ("b", "a"), ("a", "a"), ("it's \n", "")], EDGES)
    path = staging.path("links")
    write_links(edges, path, slices=5)
    links = read_links(spark, path)
    assert links.slices == 5
    assert values(links.rows.select("parent_ss_id", "direction", "ss_id")) == values(both_directions(edges))
    assert links.rows.where(F.col("slice") != slice_of(F.col("parent_ss_id"), 5)).isEmpty()
    empty = staging.path("links")
    write_links(edges.limit(0), empty)
    assert read_links(spark, empty).of(frame([("a",)], "parent_ss_id string")).isEmpty()


def test_a_small_frontier_opens_its_slices_alone(spark, frame, staging):
    """Files of all other slices can't be read any more, and nobody does."""
    edges = spark.range(20_000).select(F.concat(F.lit("n"), F.col("id").cast("string")).alias("ss_id"), F.lit("hub").alias("reference_id"))
    path = staging.path("links")
    with settings(spark, spark__sql__shuffle__partitions="32", spark__sql__adaptive__coalescePartitions__enabled="false"):
        write_links(edges, path, slices=8)
    links = read_links(spark, path)
    hub = spark.range(1).select(slice_of(F.lit("hub"), 8)).first()[0]
    files = [name for name in links.rows.inputFiles() if f"slice={hub}/" in name]
    # The slice of the hub is dealt over files, so that many tasks write and read it.
    assert len(files) >= 3
    frontier = staging.write(frame([("n17", 0), ("n4000", 1)], "parent_ss_id string, turn long"))
    wanted = {row[0] for row in frontier.select(slice_of(F.col("parent_ss_id"), 8)).collect()}
    for name in links.rows.inputFiles():
        if int(name.split("slice=")[1].split("/")[0]) not in wanted:
            with open(name.removeprefix("file://").replace("file:", ""), "wb") as file:
                file.write(b"broken")
    found = neighbours(frontier, links.of(frontier))
    assert sorted((r["parent_ss_id"], r["ss_id"]) for r in found.collect()) == [("n17", "hub"), ("n4000", "hub")]
    assert "slice#" in plan_of(found).split("PartitionFilters:")[1].split("]")[0]


def test_hops_over_links(spark, frame, values, staging):
    """As over the edges themselves; the loop stops by itself where nothing new is found."""
    seeds, edges, about = random_corpus(5, papers=15, edges=60)
    terms = staging.write(frame([(0, "t0"), (1, "t1"), (2, "t2"), (3, "other")], "term_pos long, term string"))
    attributes = frame([(n, *texts) for n, texts in about.items()], "ss_id string, title string, abstract string, url string")
    papers, table = frame(seeds, PAPERS), staging.write(frame(edges, EDGES))
    path = staging.path("links")
    write_links(table, path, slices=7)
    for hops in (0, 1, 3, 50):
        one = expand_hops(papers, table, terms, hops, staging, attributes=attributes)
        other = expand_hops(papers, read_links(spark, path), terms, hops, staging, attributes=attributes)
        assert [values(x) for x in one] == [values(x) for x in other]
