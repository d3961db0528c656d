"""Expansion against the step-by-step model, on graphs with a hub."""

import os
import random

import pytest
from pyspark.sql import functions as F

from citeweave.operators import report
from citeweave.operators.checks import orphan_edges
from citeweave.operators.upsert import mark_processed
from citeweave.plans.expand import EdgeHop, ResponseHop, expand_hops
from citeweave.schemas import EDGES, PAPERS, RESPONSES
from citeweave.staging import Staging
from model import Model, landed, random_corpus
from test_plans import plan_of, settings

TERMS = ["t0", "t1", "t2"]


def term_list(frame):
    # The repeated term counts at its first position only.
    return frame([(i, t) for i, t in enumerate([*TERMS, "t0"])], "term_pos long, term string")


def sides(edges, about):
    def look_up(key):
        citing = [(a, *about[a]) for a, b in edges if b == key]
        cited = [(b, *about[b]) for a, b in edges if a == key]
        return sorted(citing), sorted(cited)

    return look_up


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_edge_hops_equal_the_sequential_run(frame, values, staging, seed):
    seeds, edges, about = random_corpus(seed)
    model = Model(seeds)
    for hop in range(2):
        model.expand(TERMS, hop, sides(edges, about))
    attributes = frame([(n, *a) for n, a in about.items()], "ss_id string, title string, abstract string, url string")
    # Rows in any order and partitioning give the same result.
    known = frame(seeds, PAPERS).repartition(3).orderBy(F.rand(seed))
    # A key that comes twice among the attributes makes no second paper.
    twice = attributes.union(attributes.withColumn("title", F.concat("title", F.lit("~"))))
    grown, met = expand_hops(known, frame(edges, EDGES).repartition(5), term_list(frame), 2, staging, attributes=twice)
    assert values(grown) == model.rows()
    assert values(met) == sorted(model.edges, key=repr)


@pytest.mark.parametrize("seed", [4, 5])
def test_response_hop_equals_the_sequential_run(frame, values, staging, seed):
    seeds, edges, about = random_corpus(seed)
    in_list_order = lambda key: (
        [(a, *about[a]) for a, b in edges if b == key],
        [(b, *about[b]) for a, b in edges if a == key],
    )
    model = Model(seeds)
    model.expand(TERMS, 0, in_list_order)
    known = frame(seeds, PAPERS)
    responses = frame(landed([s[1] for s in seeds], edges, about), RESPONSES)
    step = ResponseHop(known, responses, term_list(frame), 0, staging)
    after = mark_processed(known, step.processed).unionByName(step.papers)
    assert values(after) == model.rows()
    assert values(step.edges) == sorted(model.edges, key=repr)
    assert step.rejects.isEmpty()
    assert after.groupBy("ss_id").count().filter("count > 1").isEmpty()
    assert orphan_edges(step.edges, after, staging).isEmpty()


def test_running_a_hop_again_adds_nothing(frame, staging):
    seeds, edges, about = random_corpus(6)
    known, links = frame(seeds, PAPERS), frame(edges, EDGES)
    first = EdgeHop(known, links, term_list(frame), 0, staging)
    after = staging.write(known.unionByName(first.papers))
    again = EdgeHop(after, links, term_list(frame), 0, staging, known_edges=first.edges)
    assert not first.papers.isEmpty()
    assert again.papers.isEmpty() and again.edges.isEmpty()
    done = staging.write(mark_processed(after, first.processed))
    assert EdgeHop(done, links, term_list(frame), 0, staging).processed.isEmpty()


def test_known_papers_and_first_term_win(frame, staging):
    known = frame(
        [
            (5, "a", "A", "x", "t1", 0, None, False),
            (9, "b", "B", "x", "t0", 0, None, None),
            (2, "old", "Old", "x", None, None, "/old", True),
        ],
        PAPERS,
    )
    edges = frame([("c", "a"), ("c", "b"), ("a", "a"), ("old", "a"), ("a", "d")], EDGES)
    step = EdgeHop(known, edges, term_list(frame), 0, staging)
    rows = [(r["id"], r["ss_id"], r["search_term"], r["num_hops"], r["title"]) for r in step.papers.orderBy("id").collect()]
    assert rows == [(10, "c", "t0", 1, "No Title"), (11, "d", "t1", 1, "No Title")]
    assert step.edges.count() == 5


def test_failed_look_ups(frame, values, staging):
    known = frame([(i, k, "T", "x", "t0", 0, None, False) for i, k in enumerate("abc")], PAPERS)
    responses = frame(
        [(0, "a", 0, 0, 200, "[]"), (0, "a", 1, 0, 500, None), (1, "b", 0, 0, 200, "[]"), (1, "b", 1, 0, 200, "{bad")], RESPONSES
    )
    step = ResponseHop(known, responses, term_list(frame), 0, staging)
    assert values(step.processed) == [("a",), ("b",)]
    assert [r["problem"] for r in step.rejects.collect()] == ["malformed payload"]
    later = ResponseHop(known, responses, term_list(frame), 0, staging, retry_failed=True)
    assert values(later.processed) == [("b",)]


def test_collated_rows_keep_every_neighbour(frame, staging):
    seeds, edges, _ = random_corpus(7, edges=220)
    papers = frame(seeds, PAPERS)
    rows = report.collated(papers, frame(edges, EDGES), staging)
    found, titles = {}, {s[1]: s[2] for s in seeds}
    for row in sorted(rows.collect(), key=lambda r: (r["ss_id"], r["direction"] or 0, r["place"] or 0)):
        lists = found.setdefault(row["ss_id"], ([], []))
        if row["direction"] is not None:
            assert row["place"] == len(lists[row["direction"]]) and row["title"] == titles.get(row["neighbour"])
            lists[row["direction"]].append(row["neighbour"])
    assert set(found) == {s[1] for s in seeds}
    for key, (citations, references) in found.items():
        assert citations == sorted(a for a, b in edges if b == key)
        assert references == sorted(b for a, b in edges if a == key)
    parts = report.adjacency(rows, staging, share=5).collect()
    assert len({(r["ss_id"], r["direction"], r["part"]) for r in parts}) == len(parts)
    assert all(len(r["neighbours"]) <= 5 and r["neighbours"][0]["place"] == 5 * r["part"] for r in parts)
    assert sum(len(r["neighbours"]) for r in parts) == rows.filter("direction IS NOT NULL").count()
    assert report.collated_json(rows).count() == rows.count()


def test_lists_are_made_without_writing_their_texts_first(frame, staging):
    papers = frame([(1, "a", "A", "x", "t", 0, "u", False), (2, "b", "B", "y", "t", 0, "v", False)], PAPERS)
    rows = report.collated(papers, frame([("a", "b")], EDGES), staging)
    folders = set(os.listdir(staging.root))
    lists = report.adjacency(rows, staging).collect()
    assert set(os.listdir(staging.root)) == folders
    assert {(r["ss_id"], r["direction"], r["part"], r["neighbours"][0]["title"]) for r in lists} == {("a", 1, 0, "B"), ("b", 0, 0, "A")}


def staged_plans(monkeypatch):
    plans, write = [], Staging.write
    monkeypatch.setattr(Staging, "write", lambda self, df, name="table": (plans.append(plan_of(df)), write(self, df, name))[1])
    return plans


def test_short_lists_are_numbered_where_they_are_dealt(spark, frame, staging, monkeypatch):
    """Only hubs go through ranges and Arrow; the others are dealt once, for numbering and for the join with their papers."""
    seeds, edges, _ = random_corpus(7, edges=220)
    table = staging.write(frame(edges, EDGES))
    plans = staged_plans(monkeypatch)
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        rows = report.collated(staging.write(frame(seeds, PAPERS)), table, staging)
        assert not any("MapInArrow" in plan or "rangepartitioning" in plan for plan in plans)
        assert plans[-1].count("Exchange hashpartitioning") == 2
        # The titles meet citations and references apart.
        assert plan_of(rows).count("LeftOuter") == 2
        report.collated(frame(seeds, PAPERS), table, staging, hub=3)
        assert any("rangepartitioning" in plan for plan in plans)


@pytest.mark.parametrize("hub", [0, 3, 10, 1_000])
def test_places_of_hubs_and_short_lists(frame, values, staging, hub):
    """The same rows wherever lists are numbered, also where papers and edges repeat or miss a key."""
    draw = random.Random(hub)
    keys = [*"abcdefgh", None]
    papers = [(k, key, f"T{key}", "x", "t", 0, "u", False) for k, key in enumerate([*keys, "lonely", "b", "b", None])]
    edges = [(draw.choice(keys), draw.choice(["hub", *keys])) for _ in range(200)] + [(f"n{i}", "a") for i in range(40)]
    columns = "id int, ss_id string, title string, abstract string, search_term string, num_hops int, url string, is_processed boolean"
    found = report.collated(frame(papers, columns), frame(edges, "ss_id string, reference_id string"), staging, hub=hub)
    links = [(b, 0, a) for a, b in edges] + [(a, 1, b) for a, b in edges]
    expected, titles = [], {}
    for _, key, title, *_ in papers:
        titles.setdefault(key, []).append(title)
    for key in {p[1] for p in papers}:
        copies = [p[0] for p in papers if p[1] == key]
        lists = {way: sorted((n for k, w, n in links if k == key is not None and w == way), key=lambda n: (n is not None, n or "")) for way in (0, 1)}
        for way, names in lists.items():
            # Copies of a paper share the places of its list.
            for place, name in enumerate(n for n in names for _ in copies):
                expected += [(key, way, place, name, title) for title in titles.get(name, [None]) if name is not None] or [(key, way, place, name, None)]
        if not any(lists.values()):
            expected += [(key, None, None, None, None)] * len(copies)
    assert values(found.select("ss_id", "direction", "place", "neighbour", "title")) == sorted(expected, key=repr)
    by_id = found.where("ss_id = 'b' AND direction = 1").groupBy("id").count().collect()
    assert len({row["count"] for row in by_id}) == 1 and len(by_id) == 3
