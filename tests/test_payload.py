"""Look-up bodies of every shape."""

import json

import pytest
from pyspark.sql import functions as F

from citeweave.functions.payload import flatten_neighbours, parse_responses, rejected_neighbours, valid_neighbours
from citeweave.operators.neighbours import as_edges
from citeweave.schemas import RESPONSES

NONE = "No abstract available"
CASES = [
    # body, neighbours (id, title, abstract, url), problems
    ('{"data":[{"citingPaper":{"paperId":"x","title":"T","abstract":"A","url":"u"}}]}', [("x", "T", "A", "u")], []),
    ('{"data":[{"citingPaper":{"paperId":"x","title":"T","abstract":null}}]}', [("x", "T", NONE, None)], []),
    ('{"data":[{"citingPaper":{"paperId":"x","title":"T","abstract":""}}]}', [("x", "T", NONE, None)], []),
    ('{"data":[{"citingPaper":{"paperId":null,"title":"T"}}]}', [], ["no id"]),
    ('{"data":[{"citingPaper":{"paperId":"","title":"T"}}]}', [], ["no id"]),
    ('{"data":[{"citingPaper":{"title":"T"}}]}', [("unknown_id", "T", NONE, None)], []),
    ('{"data":[{"citingPaper":{"paperId":"x"}}]}', [("x", "No Title", NONE, None)], []),
    ('{"data":[{"citingPaper":{"paperId":"x","title":null}}]}', [], ["no title"]),
    ('{"data":[{}]}', [("unknown_id", "No Title", NONE, None)], []),
    ('{"data":[{"citingPaper":null}]}', [], ["null paper"]),
    ('{"data":[{"citingPaper":"text"}]}', [], ["paper is no object"]),
    ('{"data":[7,null,"a"]}', [], ["item is no object"] * 3),
    ("{}", [], []),
    ('{"data":[]}', [], []),
    ('{"data":null}', [], ["null item list"]),
    ('{"data":"text"}', [], ["item list is no list"]),
    ("17", [], ["item list is no list"]),
    ('[{"citingPaper":{"paperId":"x","title":"T"}}]', [("x", "T", NONE, None)], []),
    ("[]", [], []),
    ("{bad", [], ["malformed payload"]),
    (None, [], ["malformed payload"]),
]


@pytest.fixture
def landed(frame):
    rows = [(i, f"p{i}", 0, 0, 200, body) for i, (body, _, _) in enumerate(CASES)]
    return frame([*rows, (99, "p99", 0, 0, 404, "{bad"), (99, "p99", 1, None, None, None)], RESPONSES)


def test_every_shape(landed):
    flat = flatten_neighbours(parse_responses(landed), "id")
    valid, rejected = {}, {}
    for row in valid_neighbours(flat).orderBy("id", "pos").collect():
        valid.setdefault(row["id"], []).append((row["ss_id"], row["title"], row["abstract"], row["url"]))
    for row in rejected_neighbours(flat).orderBy("id", "pos").collect():
        rejected.setdefault(row["id"], []).append(row["problem"])
    for i, (body, neighbours, problems) in enumerate(CASES):
        assert valid.get(i, []) == neighbours, body
        assert rejected.get(i, []) == problems, body
    assert 99 not in valid and 99 not in rejected


def test_absent_values_can_be_rejected(landed):
    flat = flatten_neighbours(parse_responses(landed), "id", reject_missing=True)
    assert {row["ss_id"] for row in valid_neighbours(flat).collect()} == {"x"}
    assert valid_neighbours(flat).filter("title = 'No Title'").isEmpty()


def test_edges_round_trip_through_payloads(frame, values):
    edges = {(f"a{i % 7}", f"b{i % 11}") for i in range(60)} | {("b1", "b1"), ("b2", "b1")}
    bodies = [
        (1, parent, 0, 0, 200, json.dumps({"data": [{"citingPaper": {"paperId": a, "title": "t"}} for a, b in edges if b == parent]}))
        for parent in {b for _, b in edges}
    ]
    parsed = parse_responses(frame(bodies, RESPONSES).withColumnRenamed("ss_id", "parent_ss_id"))
    flat = flatten_neighbours(parsed, "parent_ss_id")
    assert values(as_edges(valid_neighbours(flat))) == sorted(edges, key=repr)


def test_order_within_a_list_is_kept(frame):
    body = json.dumps([{"citedPaper": {"paperId": f"n{i}", "title": "t"}} for i in range(50)])
    flat = flatten_neighbours(parse_responses(frame([(1, "p", 1, 4, 200, body)], RESPONSES)), "id")
    rows = flat.orderBy("pos").select("page", "pos", "ss_id").collect()
    assert [tuple(row) for row in rows] == [(4, i, f"n{i}") for i in range(50)]
    assert flat.filter(F.col("problem").isNotNull()).isEmpty()
