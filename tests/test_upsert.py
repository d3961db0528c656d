"""Upserts, numbering, checks, ranking and reports."""

import random

import pytest
from pyspark.sql import functions as F

from citeweave.operators import checks, frontier, identity, ranking, report, subset, upsert
from citeweave.plans.curate import copy_seed, curate
from citeweave.plans.validate import validate
from citeweave.schemas import EDGES, LEGACY_EDGES, LEGACY_PAPERS, PAPERS

KEYED = "ss_id string, place long, title string, abstract string, url string, search_term string, num_hops int"


def test_insert_or_ignore(frame, staging):
    candidates = frame(
        [
            ("a", 3, "third", "x", None, "t", 1),
            ("a", 1, "first", None, None, "t", 1),
            ("b", 2, None, "x", None, "t", 1),
            (None, 0, "no id", "x", None, "t", 1),
            ("known", 0, "new title", "x", None, "t", 1),
            ("", 4, "", "x", None, None, None),
        ],
        KEYED,
    )
    known = frame([(41, "known", "old title", "x", "s", 0, None, True)], PAPERS)
    rows = upsert.new_papers(candidates, known, ["place"], staging).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [
        (42, "a", "first", "No abstract available", "t", 1, None, False),
        (43, "", "", "x", None, None, None, False),
    ]


def test_a_key_found_by_most_candidates(frame, staging):
    rng = random.Random(0)
    rows = [("hot" if rng.random() < 0.6 else f"k{rng.randrange(200)}", i, f"t{i}", "x", None, "t", 1) for i in range(3000)]
    rng.shuffle(rows)
    first = {}
    for row in sorted(rows, key=lambda r: r[1]):
        first.setdefault(row[0], row)
    none = frame([], PAPERS)
    got = upsert.new_papers(frame(rows, KEYED).repartition(7), none, ["place"], staging).collect()
    want = sorted(first.values(), key=lambda r: r[1])
    assert [(r["id"], r["ss_id"], r["title"]) for r in sorted(got)] == [(i + 1, w[0], w[2]) for i, w in enumerate(want)]


@pytest.mark.parametrize("rows", [0, 1, 1000])
def test_dense_positions(frame, staging, rows):
    values = list(range(rows))
    random.Random(1).shuffle(values)
    # The first part of the order is the same for most rows.
    df = frame([(0 if v % 3 else v, v) for v in values], "hot int, v int").repartition(6)
    got = identity.dense_position(df, ["hot", "v"], staging, first=10).collect()
    want = {v: 10 + i for i, (_, v) in enumerate(sorted((0 if v % 3 else v, v) for v in values))}
    assert {r["v"]: r["position"] for r in got} == want


def test_top_n_with_a_hot_group(frame):
    rng = random.Random(2)
    rows = [("hot" if rng.random() < 0.7 else f"g{rng.randrange(9)}", i) for i in rng.sample(range(10000), 2000)]
    rows += [(None, 10001), (None, 10002)]
    want = []
    for group in {g for g, _ in rows}:
        want += [(group, i) for i in sorted(i for g, i in rows if g == group)[:5]]
    got = ranking.top_n_per_group(frame(rows, "g string, id int").repartition(9), "g", "id", 5, shares=3)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_top_n_limits_rows_before_the_shuffle(frame):
    df = ranking.top_n_per_group(frame([("a", 1)], "g string, id int"), "g", "id", 5)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2


def test_new_edges_and_ends(frame, values, staging):
    papers = frame([(i, k, "T", "x", None, 0, None, False) for i, k in enumerate("abc")], PAPERS)
    candidates = frame([("a", "b"), ("a", "b"), ("b", "c"), ("x", "a"), ("a", "y"), ("x", "y"), ("a", None), (None, "b")], "ss_id string, reference_id string")
    fresh = upsert.new_edges(candidates, frame([("b", "c")], EDGES))
    sound, orphaned = upsert.split_by_ends(fresh, papers, staging)
    assert values(sound) == [("a", "b")]
    loose = [("a", "y"), ("a", None), ("x", "a"), ("x", "y"), (None, "b")]
    assert values(orphaned) == loose
    assert values(checks.orphan_edges(candidates, papers, staging)) == loose
    assert values(subset.edges_between(candidates, papers.filter("id < 2"))) == [("a", "b"), ("a", "b")]


def test_mark_processed_and_frontier(frame, values):
    papers = frame(
        [(1, "a", "T", "x", "t", 0, None, None), (2, "b", "T", "x", "t", 0, None, True), (3, "c", "T", "x", "T", 1, None, False)], PAPERS
    )
    done = frame([("a",), ("a",), ("zz",)], "ss_id string")
    marked = upsert.mark_processed(papers, done)
    assert values(marked.select("ss_id", "is_processed")) == [("a", True), ("b", True), ("c", False)]
    assert values(frontier.unprocessed(papers).select("id")) == [(1,), (3,)]
    assert values(frontier.unprocessed(papers, done).select("id")) == [(3,)]
    assert values(frontier.frontier_of(papers, "t", 0).select("id")) == [(1,), (2,)]
    assert values(report.newly_fetched(papers)) == [(1,), (3,)]
    assert frontier.frontier_page(papers, 1, 1).first()["id"] == 2


def test_resume(frame, values):
    rows = [(t, p, i) for t in ("a", "b", None) for p in range(3) for i in range(3)]
    left = frontier.resume_after(frame(rows, "term string, page int, item int"), "a", 1, 1)
    assert values(left) == sorted([r for r in rows if r[0] != "a" or r[1:] > (1, 1)], key=repr)


def test_curate_resets_and_ignores(frame, staging):
    papers = frame([(i, f"p{i}", "T", "x", f"t{i % 3}", i // 20, "/u", True) for i in range(40)], PAPERS)
    terms = frame([(0, "t1"), (1, "t0"), (2, "t1")], "term_pos long, term string")
    curated = frame([(100, "p1", "old", "x", "t1", 0, None, True)], PAPERS)
    rows = curate(papers, terms, curated, staging, 3).orderBy("id").collect()
    assert [(r["id"], r["ss_id"], r["is_processed"]) for r in rows] == [
        (101, "p4", False), (102, "p7", False), (103, "p0", False), (104, "p3", False), (105, "p6", False)
    ]


def test_copy(frame, values, staging):
    papers = frame([(1, "a", "T", "x", "t", 0, None, False), (2, "b", "T", "x", "t", 1, None, False), (3, "c", "T", "x", "t", 0, None, False)], PAPERS)
    edges = frame([("a", "b"), ("a", "c"), ("b", "a")], EDGES)
    none, no_edges = frame([], PAPERS), frame([], EDGES)
    copied, leaving = copy_seed(papers, edges, none, no_edges, staging)
    assert values(copied.select("ss_id")) == [("a",), ("c",)]
    assert values(leaving) == [("a", "b"), ("a", "c")]
    assert values(copy_seed(papers, edges, none, no_edges, staging, both_ends=True)[1]) == [("a", "c")]
    with pytest.raises(ValueError, match="already in the target"):
        copy_seed(papers, edges, papers.filter("id = 3"), no_edges, staging)
    with pytest.raises(ValueError, match="reference_id"):
        copy_seed(papers, edges, none, frame([("a", "b")], EDGES), staging)
    with pytest.raises(ValueError, match="repeat their ss_id"):
        copy_seed(papers.union(papers.withColumn("id", F.col("id") + 10)), edges, none, no_edges, staging)
    with pytest.raises(ValueError, match="repeat their ss_id, reference_id"):
        copy_seed(papers, edges.union(edges), none, no_edges, staging)


def test_validation_report(frame, staging):
    loose = "id long, ss_id string, title string, abstract string"
    papers = frame([(1, "a", "T", "x"), (1, "b", None, "x"), (3, "b", "T", None), (None, None, "T", "x")], loose)
    edges = frame([("a", "b"), ("a", "b"), ("a", "z"), (None, "a")], "ss_id string, reference_id string")
    got = {r["check"]: r["violations"] for r in validate(papers, edges, staging).collect()}
    assert got == {
        "papers not null id": 1, "papers not null ss_id": 1, "papers not null title": 1, "papers not null abstract": 1,
        "edges not null ss_id": 1, "edges not null reference_id": 0, "papers unique id": 1, "papers unique ss_id": 1,
        "edges unique pair": 1, "edges ends are papers": 1,
    }


def test_reports(frame, values):
    papers = frame([(i, f"p{i}", "T", "x", None if i == 4 else "t", 0, None, i % 2 == 0) for i in range(5)], PAPERS)
    assert values(report.processed_per_term(papers)) == [("t", 2), (None, 1)]
    assert values(report.batch_counts(papers, 2)) == [("t", 0, 4, 2, 2), (None, 0, 1, 0, 1)]
    versions = frame([(1, 1, "a"), (1, 3, "c"), (1, 2, "b"), (2, 1, None)], "id int, v int, x string")
    assert values(report.latest_per_key(versions, "id", "v")) == [(1, 3, "c"), (2, 1, None)]


def test_legacy_layout(frame, values):
    papers = frame([(1, "a", "c1", "T", "who", "2020", "x", "t", 0, "/u")], LEGACY_PAPERS)
    upgraded = upsert.upgrade_papers(papers)
    assert upgraded.columns == [*PAPERS.fieldNames(), "is_cleaned"]
    assert values(upgraded) == [(1, "a", "T", "x", "t", 0, "/u", False, False)]
    edges = upsert.upgrade_edges(frame([("a", "b")], LEGACY_EDGES))
    assert edges.columns == EDGES.fieldNames() and values(edges) == [("a", "b")]


def test_null_checks(frame):
    df = frame([(1, None), (None, "x"), (2, "y")], "a int, b string")
    assert checks.null_violations(df, ["a", "b"]).count() == 2
    assert checks.repeated_keys(df.select(F.lit(1).alias("k")), ["k"]).first()["n"] == 3
