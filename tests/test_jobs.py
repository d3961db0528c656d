"""The commands, one after the other on one corpus."""

import json

import pytest
from pyspark.sql import functions as F

from citeweave.jobs import parser
from citeweave.schemas import LEGACY_EDGES, LEGACY_PAPERS, RESPONSES, RESULT_PAGES
from citeweave.sources.corpus import Corpus
from citeweave.staging import Staging


def run(spark, *arguments):
    args = parser().parse_args([str(a) for a in arguments])
    with Staging(spark, args.job) as staging:
        args.run(spark, args, staging)


def row(key, title):
    return f'<div class="cl-paper-row"><h2 class="cl-paper-title" id="paper-{key}">{title}</h2></div>'


def test_upgrade(spark, frame, values, tmp_path):
    frame([(1, "a", "c1", "T", "who", "2020", "x", "t", 0, "/u")], LEGACY_PAPERS).write.parquet(str(tmp_path / "old/papers"))
    frame([("a", "b")], LEGACY_EDGES).write.parquet(str(tmp_path / "old/edges"))
    run(spark, "upgrade", "--corpus", tmp_path / "old", "--target", tmp_path / "new")
    assert values(spark.read.parquet(str(tmp_path / "new/papers"))) == [(1, "a", "T", "x", "t", 0, "/u", False, False)]
    assert values(spark.read.parquet(str(tmp_path / "new/edges"))) == [("a", "b")]


def test_from_pages_to_a_copied_corpus(spark, frame, values, tmp_path):
    root = tmp_path / "corpus"
    (tmp_path / "terms.csv").write_text("deep nets\ngraphs\nlogic\n")
    pages = [("graphs", 1, row("b", "B") + row("a", "A")), ("deep%20nets", 1, row("c", "C") + row("b", "again")), ("logic", 1, row("z", "Z"))]
    frame(pages, RESULT_PAGES).write.parquet(str(tmp_path / "pages"))
    listed = ["--terms", tmp_path / "terms.csv", "--corpus", root]
    collect = ["collect", *listed, "--end", 1, "--inclusive", "--pages", tmp_path / "pages", "--base-url", "/p/", "--batch", 0]
    run(spark, *collect)
    run(spark, *collect)
    corpus = Corpus.below(str(root))
    seeds = corpus.read(spark, "papers").select("id", "ss_id", "title", "search_term", "url")
    assert values(seeds) == [
        (1, "c", "C", "deep nets", "/p/c"), (2, "b", "again", "deep nets", "/p/b"), (3, "a", "A", "graphs", "/p/a")
    ]

    def body(key, *names):
        return json.dumps({"data": [{key: {"paperId": n, "title": n.upper()}} for n in names]})

    frame(
        [(1, "c", 0, 0, 200, body("citingPaper", "x", "a")), (3, "a", 1, 0, 200, body("citedPaper", "y", "x")), (2, "b", 0, 0, 500, None)],
        RESPONSES,
    ).write.parquet(str(tmp_path / "landed"))
    expand = ["expand", *listed, "--end", 2, "--responses", tmp_path / "landed", "--batch", 1]
    run(spark, *expand)
    run(spark, *expand)
    run(spark, *expand[:-1], 2)
    grown = corpus.read(spark, "papers").filter("num_hops = 1").select("id", "ss_id", "search_term")
    assert values(grown) == [(4, "x", "deep nets"), (5, "y", "graphs")]
    assert values(corpus.read(spark, "edges")) == [("a", "c"), ("a", "x"), ("a", "y"), ("x", "c")]

    run(spark, "progress", "--corpus", root, "--target", tmp_path / "counts")
    counts = spark.read.option("header", True).csv(str(tmp_path / "counts"))
    assert values(counts) == [("deep nets", "2"), ("graphs", "1")]
    run(spark, "validate", "--corpus", root, "--target", tmp_path / "violations")
    assert spark.read.option("header", True).csv(str(tmp_path / "violations")).filter("violations > 0").isEmpty()
    run(spark, "fetched", "--corpus", root, "--target", tmp_path / "waiting")
    assert values(spark.read.parquet(str(tmp_path / "waiting"))) == [(4,), (5,)]

    run(spark, "dump", "--corpus", root, "--target", tmp_path / "dump")
    dumped = [json.loads(r["value"]) for r in spark.read.text(str(tmp_path / "dump")).collect()]
    of = lambda key: [(d["direction"], d["place"], d["neighbour"]["ss_id"]) for d in dumped if d["ss_id"] == key]
    assert sorted(of("a")) == [(1, 0, "c"), (1, 1, "x"), (1, 2, "y")]
    assert {d["ss_id"] for d in dumped} == set("abcxy")
    assert {"ss_id": "b"} in dumped

    run(spark, "compact", "--corpus", root, "--target", tmp_path / "compacted")
    small = Corpus.below(str(tmp_path / "compacted"))
    assert values(small.read_papers(spark)) == values(corpus.read_papers(spark))
    assert values(small.read(spark, "papers")) == values(corpus.read_papers(spark))
    assert values(small.read(spark, "edges")) == values(corpus.read(spark, "edges"))
    one_hop = corpus.read(spark, "papers", before=9).filter("num_hops = 1")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(num_hops,1)" in one_hop and "folder" in one_hop.split("PartitionFilters:")[1].split("]")[0]

    grow = ["grow", "--terms", tmp_path / "terms.csv", "--end", 2, "--corpus", tmp_path / "grown", "--source", root, "--batch", 1]
    grown_to = Corpus.below(str(tmp_path / "grown"))
    grown_to.create(spark)
    grown_to.seed(corpus.read(spark, "papers").filter("num_hops = 0").withColumn("is_processed", F.lit(False)))
    run(spark, *grow)
    run(spark, *grow)
    assert values(grown_to.read_papers(spark).select("id", "ss_id", "title", "is_processed")) == [
        (1, "c", "C", True), (2, "b", "again", True), (3, "a", "A", True), (4, "x", "X", False), (5, "y", "Y", False)
    ]
    assert values(grown_to.read(spark, "edges")) == [("a", "c"), ("a", "x"), ("a", "y"), ("x", "c")]

    run(spark, "curate", *listed, "--end", 2, "--curated", tmp_path / "curated", "--per-term", 1, "--batch", 0)
    assert values(Corpus.below(str(tmp_path / "curated")).read(spark, "papers").select("id", "ss_id")) == [(1, "c"), (2, "a")]

    run(spark, "curated-edges", "--corpus", root, "--curated", tmp_path / "curated", "--target", tmp_path / "between")
    assert values(spark.read.parquet(str(tmp_path / "between"))) == [("a", "c")]

    run(spark, "copy", "--corpus", root, "--target", tmp_path / "target", "--batch", 0)
    target = Corpus.below(str(tmp_path / "target"))
    assert values(target.read(spark, "papers").select("ss_id", "is_processed")) == [("a", True), ("b", True), ("c", True)]
    assert values(target.read(spark, "edges")) == [("a", "c"), ("a", "x"), ("a", "y")]

    frame([(2, "b", 0, 1, 200, body("citingPaper", "w"))], RESPONSES).write.parquet(str(tmp_path / "later"))
    follow = ["follow", *listed, "--end", 2, "--responses", tmp_path / "later", "--checkpoint", tmp_path / "progress", "--batch"]
    with pytest.raises(ValueError, match="already has batches"):
        run(spark, *follow, 0)
    run(spark, *follow, 10)
    run(spark, *follow, 10)
    ids = corpus.read(spark, "papers").select("id", "ss_id")
    assert values(ids) == [(1, "c"), (2, "b"), (3, "a"), (4, "x"), (5, "y"), (6, "w")]
