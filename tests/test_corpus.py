"""The corpus on disk: whole batches, clustered tables, ids that go on."""

import pytest
from pyspark.sql import functions as F

from citeweave.operators.checks import orphan_edges
from citeweave.operators.upsert import discover, first_discovery, improved, mark_processed, unseen
from citeweave.plans.validate import check_orphans
from citeweave.schemas import EDGES, PAPERS
from citeweave.sources.corpus import SEED_BATCH, Corpus, touched
from test_plans import plan_of, settings

PAPER = [(2, "b", "B", "x", "t", 0, None, False), (1, "a", "A", "x", "t", 0, None, True)]


@pytest.fixture
def corpus(spark, staging):
    made = Corpus.below(staging.path("corpus"))
    made.create(spark, buckets=8)
    return made


@pytest.fixture
def large(spark, corpus):
    """Thousands of papers in three batches, half of them noted as done, and an edge for each."""
    key = F.concat(F.lit("n"), F.col("id").cast("string"))
    for batch in range(3):
        ids = spark.range(batch * 2000, batch * 2000 + 2000)
        papers = ids.select("id", key.alias("ss_id"), F.lit("T").alias("title"), F.lit("x").alias("abstract"), F.lit("t").alias("search_term"), F.lit(batch).alias("num_hops"), F.lit(None).alias("url"), F.lit(False).alias("is_processed"))
        with corpus.batch(spark, batch) as out:
            out.append("papers", papers)
            out.append("edges", papers.select("ss_id", F.lit("n0").alias("reference_id")))
            out.append("done", papers.where("id % 2 = 0").select("ss_id"))
    return corpus


def test_created_once(spark, frame, values, corpus):
    assert corpus.read(spark, "papers").isEmpty() and corpus.read(spark, "papers").columns == PAPERS.fieldNames()
    corpus.seed(frame(PAPER, PAPERS))
    corpus.create(spark, buckets=3)
    assert values(corpus.read(spark, "papers")) == sorted(PAPER)
    assert corpus.batches(spark)[0]["batch"] == SEED_BATCH and corpus._state(spark)["buckets"] == 8
    with pytest.raises(FileNotFoundError):
        Corpus.below(corpus.root + "-none").read(spark, "papers")


def test_a_batch_written_again_replaces_itself(spark, frame, values, corpus):
    for batch, rows in ((0, [("a", "b")]), (1, [("c", "d"), ("e", "f")])):
        with corpus.batch(spark, batch) as out:
            out.append("edges", frame(rows, EDGES))
    assert values(corpus.read(spark, "edges", before=1)) == [("a", "b")]
    earlier = corpus.read(spark, "edges")
    with corpus.batch(spark, 1) as out:
        out.append("edges", frame([("c", "d")], EDGES))
    assert values(corpus.read(spark, "edges")) == [("a", "b"), ("c", "d")]
    # Files that a reader has begun with are left alone until they are cleaned up.
    assert values(earlier) == [("a", "b"), ("c", "d"), ("e", "f")]
    assert corpus.clean(spark) == [f"edges/{name}" for name in {r.split("/")[-2] for r in earlier.inputFiles()} - {e["tables"]["edges"] for e in corpus.batches(spark)}]
    assert values(corpus.read(spark, "edges")) == [("a", "b"), ("c", "d")]


def test_a_stopped_batch_is_not_seen(spark, frame, values, corpus):
    with pytest.raises(RuntimeError), corpus.batch(spark, 0) as out:
        out.append("papers", frame(PAPER, PAPERS))
        raise RuntimeError("stopped")
    assert corpus.read(spark, "papers").isEmpty() and not corpus.has_batch(spark, 0) and corpus.highest_id(spark) == 0


def test_two_writers(spark, frame, corpus):
    """The one that comes second fails, and what the first one wrote counts."""
    with pytest.raises(RuntimeError, match="another writer"), corpus.batch(spark, 0) as out:
        out.append("papers", frame(PAPER, PAPERS))
        state = corpus._state(spark)
        corpus._put(spark, state | {"version": state["version"] + 1})
        corpus._put(spark, state | {"version": state["version"] + 1})
    assert corpus.batches(spark) == []


def test_ids_go_on_without_a_scan(spark, frame, corpus, staging, values):
    corpus.seed(frame(PAPER, PAPERS))
    with corpus.batch(spark, 3) as out:
        out.append("papers", frame([(9, "z", "Z", "x", "t", 1, None, False)], PAPERS))
    assert corpus.highest_id(spark) == 9 and corpus.highest_id(spark, before=3) == 2
    known = corpus.read(spark, "papers")
    found = discover(frame([("q", 1), ("z", 0), ("p", 2)], "ss_id string, place int"), known, ["place"], staging, after=corpus.highest_id(spark), look_up=touched)
    assert values(found.select("id", "ss_id")) == [(10, "q"), (11, "p")]


def test_odd_keys(spark, frame, values, corpus):
    """Null fields, quotes and line breaks in keys, empty tables."""
    rows = [(1, "it's \"x\"\n", "T", "x", None, None, None, None), (2, "", "T", "x", "t", 3, "/u", True)]
    with corpus.batch(spark, 0) as out:
        out.append("papers", frame(rows, PAPERS))
        out.append("edges", frame([], EDGES))
        out.append("rejects", frame([], "search_term string, parent_ss_id string, direction int, page int, pos int, problem string"))
    assert values(corpus.read(spark, "papers")) == sorted(rows, key=repr)
    assert corpus.read(spark, "edges").isEmpty() and corpus.read(spark, "rejects").isEmpty()
    one = frame([("it's \"x\"\n",)], "ss_id string")
    assert values(touched(corpus.read(spark, "papers"), one, ["ss_id"]).select("id")) == [(1,)]


def test_bucket_meets_bucket(spark, large):
    """Flags are merged, and a large batch is compared, without moving a stored row."""
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        merged = large.read_papers(spark).agg(F.count_if("is_processed"))
        assert merged.first()[0] == 3000
        plan = plan_of(large.read_papers(spark))
        assert "SortMergeJoin" in plan and "Bucketed: true" in plan
        papers = large.read(spark, "papers")
        assert "Exchange" not in plan_of(mark_processed(papers, large.read(spark, "done"))).split("SortMergeJoin")[1].split("HashAggregate")[0]
        batch = spark.range(0, 9000, 3).select(F.concat(F.lit("n"), F.col("id").cast("string")).alias("ss_id"))
        fresh = unseen(batch, papers, ["ss_id"])
        assert fresh.count() == 1000
        plan = plan_of(fresh)
        # One exchange: the batch's own.
        assert plan.count("Exchange hashpartitioning") == 1 and "SelectedBucketsCount: 8 out of 8" in plan
        edges = large.read(spark, "edges")
        again = unseen(edges.limit(500), edges, EDGES.fieldNames())
        assert again.isEmpty()
        assert plan_of(again).split("LocalLimit")[0].count("Exchange hashpartitioning") == 1


def test_flags_are_merged_where_there_are_new_ones(spark, large, values):
    """Batches without an unmerged flag keep their files."""
    with large.batch(spark, 3) as out:
        out.append("papers", spark.createDataFrame([(9000, "z", "Z", "x", "t", 3, None, False)], PAPERS))
    before, files = values(large.read_papers(spark)), set(large.read(spark, "papers").inputFiles())
    last = set(spark.read.parquet(f"{large.root}/papers/{large.batches(spark)[-1]['tables']['papers']}").inputFiles())
    assert large.merge_flags(spark) == [0, 1, 2]
    assert values(large.read(spark, "papers")) == before == values(large.read_papers(spark))
    assert set(large.read(spark, "papers").inputFiles()) & files == last
    assert large.merge_flags(spark) == [] and large.highest_id(spark) == 9000
    with large.batch(spark, 4) as out:
        out.append("done", spark.createDataFrame([("n2001",)], "ss_id string"))
    files = set(large.read(spark, "papers").inputFiles())
    assert large.merge_flags(spark) == [1]
    kept = set(large.read(spark, "papers").inputFiles()) & files
    assert all(name in kept for name in files if f"/{large.batches(spark)[1]['tables']['papers']}/" not in name and "batch-1-" not in name)
    assert large.read(spark, "papers").where("ss_id = 'n2001'").first()["is_processed"]


def test_a_small_batch_opens_its_buckets_alone(spark, large, staging):
    batch = staging.write(spark.createDataFrame([("n17",), ("n4000",), ("new",)], "ss_id string"))
    with settings(spark, spark__sql__sources__bucketing__autoBucketedScan__enabled="false"):
        plan = plan_of(touched(large.read(spark, "papers"), batch, ["ss_id"]))
        assert "SelectedBucketsCount: 3 out of 8" in plan or "SelectedBucketsCount: 2 out of 8" in plan
    many = staging.write(spark.range(2000).select(F.concat(F.lit("n"), F.col("id").cast("string")).alias("ss_id")))
    assert touched(large.read(spark, "papers"), many, ["ss_id"]).count() == 2000
    # The files of all other buckets can't be read any more, and nobody does.
    buckets = [F.pmod(F.hash(F.lit(key)), F.lit(8)) for key in ("n17", "n4000", "new")]
    wanted = set(spark.range(1).select(*buckets).first())
    for name in large.read(spark, "papers").inputFiles():
        path = name.removeprefix("file://").replace("file:", "")
        if int(path.rsplit("_", 1)[1].split(".")[0]) not in wanted:
            with open(path, "wb") as file:
                file.write(b"broken")
    found = touched(large.read(spark, "papers"), batch, ["ss_id"])
    assert sorted(r["ss_id"] for r in found.collect()) == ["n17", "n4000"]
    with pytest.raises(Exception, match="(?i)parquet"):
        large.read(spark, "papers").collect()


def test_versions(frame, values, staging):
    """Whatever the order of the batches, the smallest version of a key is kept and read."""
    schema = "ss_id string, at int, sub int, what string"
    batches = [[("a", 2, 1, "x"), ("b", 1, 0, "y")], [("a", 2, 0, "z"), ("b", 1, 1, "w")], [("a", 2, 0, "z"), ("c", None, 1, "n")], [("c", 5, 1, "m")]]
    for order in (batches, batches[::-1]):
        held = staging.write(frame([], schema))
        for rows in order:
            better = improved(staging.write(frame(rows, schema)), held, "ss_id", ["at", "sub"])
            held = staging.write(held.unionByName(better))
        assert values(first_discovery(held, "ss_id", ["at", "sub"])) == [("a", 2, 0, "z"), ("b", 1, 0, "y"), ("c", None, 1, "n")]
        assert held.count() <= 6


def test_orphans_are_kept_up_to_date(spark, frame, values, corpus, staging):
    """After each batch the same as a check of everything, whether papers or edges come first, or a batch comes again."""
    paper = lambda i, key: (i, key, "T", "x", "t", 0, None, False)
    steps = [
        ([paper(1, "a")], [("a", "b"), ("b", "c"), ("a", "a"), (None, "a"), (None, "z"), ("d", None)]),
        ([paper(2, "b")], []),
        ([], [("c", "b"), ("a", "d")]),
        ([paper(3, "c"), paper(4, "d")], [("e", "f")]),
    ]
    for number, (papers, edges) in enumerate([*steps, ([], [])]):
        with corpus.batch(spark, 2 * number if number < 4 else 2) as out:
            out.append("papers", frame(papers, PAPERS))
            # Rows as they may have come from elsewhere, null ends among them.
            out.append("edges", frame(edges, "ss_id string, reference_id string"))
        kept = check_orphans(corpus, spark, 2 * number + 1)
        edges = corpus.read(spark, "edges", before=100)
        assert values(kept.select("ss_id", "reference_id")) == values(orphan_edges(edges, corpus.read(spark, "papers"), staging))
    assert values(kept.where("no_source").select("ss_id")) == [("b",), ("e",), (None,), (None,)]
