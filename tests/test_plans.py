"""Physical plans: skewed joins are split, filters reach the files, nothing goes through one task."""

import contextlib

import pytest
from pyspark.sql import functions as F

from citeweave.operators import checks, neighbours, subset, upsert
from citeweave.operators.frontier import papers_by_term
from citeweave.operators.ranking import top_n_per_group
from citeweave.operators.report import adjacency, collated
from workload import tables

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@contextlib.contextmanager
def settings(spark, **values):
    keys = {key.replace("__", "."): value for key, value in values.items()}
    before = {key: spark.conf.get(key, None) for key in keys}
    for key, value in keys.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


@pytest.fixture
def eager_skew(spark):
    """Thresholds small enough for test data to count as skewed, and no broadcasts."""
    with settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20KB",
        spark__sql__adaptive__coalescePartitions__minPartitionSize="10KB",
        spark__sql__shuffle__partitions="16",
        spark__sql__files__maxPartitionBytes="100KB",
    ):
        yield


@pytest.fixture
def hub_edges(spark, staging):
    """Half of all edges cite one paper."""
    edges = spark.range(0, 60_000, 1, 12).select(
        F.concat(F.lit("n"), F.col("id").cast("string")).alias("ss_id"),
        F.when(F.col("id") % 2 == 0, "n0").otherwise(F.concat(F.lit("n"), (F.col("id") % 999).cast("string"))).alias("reference_id"),
    )
    return staging.write(edges)


@pytest.fixture
def hub_papers(spark, staging):
    papers = spark.range(0, 60_000, 1, 4).select(
        "id", F.concat(F.lit("n"), F.col("id").cast("string")).alias("ss_id"), F.lit("t").alias("search_term")
    )
    return staging.write(papers)


def test_hub_lookups_are_split(eager_skew, hub_edges, hub_papers):
    frontier = hub_papers.select(F.col("ss_id").alias("parent_ss_id"), F.col("id").alias("turn"))
    found = neighbours.neighbours(frontier, neighbours.both_directions(hub_edges))
    assert len(found.collect()) == 120_000
    assert "SortMergeJoin(skew=true)" in plan_of(found)


def test_hub_subsets_are_split(eager_skew, hub_edges, hub_papers):
    cited = hub_edges.select(F.col("reference_id").alias("ss_id"), F.col("ss_id").alias("reference_id"))
    kept = subset.edges_from(cited, hub_papers)
    assert len(kept.collect()) == 60_000
    assert "SortMergeJoin(skew=true)" in plan_of(kept)


def test_a_hot_term_is_split(eager_skew, hub_papers, frame):
    terms = frame([(0, "t"), (1, "u")], "term_pos long, term string").repartition(2)
    joined = papers_by_term(hub_papers, terms)
    assert len(joined.collect()) == 60_000
    assert "SortMergeJoin(skew=true)" in plan_of(joined)


def test_orphans_around_a_hub(eager_skew, hub_edges, hub_papers, staging):
    orphans = checks.orphan_edges(hub_edges, hub_papers.filter("ss_id <> 'n0'"), staging)
    assert len(orphans.collect()) == hub_edges.filter("ss_id = 'n0' or reference_id = 'n0'").count()
    assert "SortMergeJoin(skew=true)" in plan_of(orphans)


def test_the_lists_of_a_hub_are_built_by_many_tasks(eager_skew, hub_edges, hub_papers, staging):
    texts = hub_papers.withColumns({name: F.col("ss_id") for name in ("title", "abstract", "url")})
    lists = adjacency(collated(texts, hub_edges, staging), staging, share=500)
    tasks = staging.write(lists.withColumn("task", F.spark_partition_id()), "lists")
    sizes = tasks.select("ss_id", "task", F.size("neighbours").alias("n"))
    assert sizes.agg(F.sum("n")).first()[0] == 120_000
    assert sizes.agg(F.max("n")).first()[0] <= 500
    assert sizes.filter("ss_id = 'n0'").select("task").distinct().count() > 4


def test_a_hot_term_is_ranked_by_many_tasks(eager_skew, hub_papers, frame, staging):
    terms = frame([(0, "t"), (1, "u")], "term_pos long, term string").repartition(2)
    joined = papers_by_term(hub_papers, terms)
    ranked = top_n_per_group(joined, "search_term", "id", 20)
    assert sorted(r["id"] for r in ranked.collect()) == list(range(20))
    plan = plan_of(ranked)
    assert "_share" in plan and "REPARTITION" in plan and "SortMergeJoin(skew=true)" in plan


def test_first_discovery_shrinks_before_the_shuffle(spark, hub_edges):
    candidates = hub_edges.select(F.col("reference_id").alias("ss_id"), F.col("ss_id").alias("via"), F.lit(1).alias("place"))
    wide = plan_of(upsert.first_discovery(candidates, "ss_id", ["place", "via"]))
    assert "partial_min" in wide
    narrow = plan_of(upsert.first_discovery(candidates.select("ss_id", "place"), "ss_id", ["place"]))
    assert narrow.count("HashAggregate") == 2 and "SortAggregate" not in narrow


def test_small_batches_leave_the_corpus_in_place(spark, staging, hub_papers):
    """Known papers are scanned against a broadcast batch and not shuffled."""
    batch = staging.write(hub_papers.select("ss_id").limit(10))
    known = upsert.matching(hub_papers.select("ss_id"), batch, ["ss_id"])
    plan = plan_of(known)
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_filters_and_columns_reach_the_files(spark):
    papers = tables.table(spark, SF, "part")
    plan = plan_of(papers.filter("p_brand = 'Brand#2'").select("p_partkey"))
    assert "EqualTo(p_brand,Brand#2)" in plan and "p_name" not in plan
