"""Streams: same tables as one batch, also after a stop in the middle, whatever lands first."""

import random

import pytest

from citeweave.plans.expand import ResponseHop
from citeweave.operators.upsert import mark_processed
from citeweave.schemas import PAPERS, RESPONSES
from citeweave.sources.corpus import Batch, Corpus
from citeweave.staging import Staging
from citeweave.streaming.ingest import first_seen, ingest_responses, read_first, settle
from model import landed, random_corpus

TERMS = ["t0", "t1", "t2"]


@pytest.fixture
def scene(spark, frame, staging):
    seeds, edges, about = random_corpus(11, papers=20, edges=80)
    seeds = sorted(seeds, key=lambda s: (s[4], s[0]))
    terms = staging.write(frame(list(enumerate(TERMS)), "term_pos long, term string"))
    rows = landed([s[1] for s in seeds], edges, about)
    papers = staging.write(frame(seeds, PAPERS))
    return papers, terms, rows, staging


def whole(scene, frame):
    papers, terms, rows, staging = scene
    step = ResponseHop(papers, frame(rows, RESPONSES), terms, 0, staging)
    return mark_processed(papers, step.processed).unionByName(step.papers), step.edges


def start(spark, scene, name):
    papers, _terms, _rows, staging = scene
    corpus = Corpus.below(staging.path(name))
    corpus.create(spark)
    corpus.seed(papers)
    return corpus, staging.path("landing"), staging.path("checkpoint")


def run(spark, scene, corpus, landing, checkpoint, **options):
    ingest_responses(spark, landing, corpus, scene[1], 0, checkpoint, **options).awaitTermination()


def halves(rows):
    middle = rows[len(rows) // 2][0]
    return [r for r in rows if r[0] < middle], [r for r in rows if r[0] >= middle]


def test_two_landings_equal_one_batch(spark, frame, values, scene):
    corpus, landing, checkpoint = start(spark, scene, "corpus")
    for part in halves(scene[2]):
        frame(part, RESPONSES).write.mode("append").parquet(landing)
        run(spark, scene, corpus, landing, checkpoint)
    papers, edges = whole(scene, frame)
    assert values(corpus.read_papers(spark)) == values(papers)
    assert values(corpus.read(spark, "edges")) == values(edges)
    # Nothing new has landed: a further start changes nothing.
    run(spark, scene, corpus, landing, checkpoint)
    assert values(corpus.read_papers(spark)) == values(papers)


def test_a_stop_between_the_writes_of_a_batch(spark, frame, values, scene, monkeypatch):
    corpus, landing, checkpoint = start(spark, scene, "corpus")
    first, second = halves(scene[2])
    frame(first, RESPONSES).write.mode("append").parquet(landing)
    run(spark, scene, corpus, landing, checkpoint)
    frame(second, RESPONSES).write.mode("append").parquet(landing)

    before = [values(corpus.read(spark, table)) for table in ("papers", "edges", "done")]
    append = Batch.append

    def breaks_at_edges(self, table, rows):
        if table == "edges":
            raise RuntimeError("stopped")
        append(self, table, rows)

    with monkeypatch.context() as patch:
        patch.setattr(Batch, "append", breaks_at_edges)
        with pytest.raises(Exception, match="stopped"):
            run(spark, scene, corpus, landing, checkpoint)
    # The papers of the batch are written, and no reader sees them.
    assert [values(corpus.read(spark, table)) for table in ("papers", "edges", "done")] == before
    run(spark, scene, corpus, landing, checkpoint)
    papers, edges = whole(scene, frame)
    assert values(corpus.read_papers(spark)) == values(papers)
    assert values(corpus.read(spark, "edges")) == values(edges)
    assert len(corpus.clean(spark)) == 1
    assert values(corpus.read_papers(spark)) == values(papers)


def test_any_landing_order(spark, frame, values, scene):
    """Look-ups in a random order over many batches, settled twice, give what one batch gives."""
    corpus, landing, checkpoint = start(spark, scene, "corpus")
    rows = random.Random(3).sample(scene[2], len(scene[2]))
    cut = len(rows) // 4
    for part in [rows[i : i + cut] for i in range(0, len(rows), cut)] + [rows[:cut]]:
        frame(part, RESPONSES).write.mode("append").parquet(landing)
        run(spark, scene, corpus, landing, checkpoint, by_order=True)
    seeds = values(corpus.read(spark, "papers"))
    assert len(seeds) == 20
    settle(corpus, spark, 0, 100)
    papers, edges = whole(scene, frame)
    assert values(corpus.read_papers(spark)) == values(papers)
    assert values(corpus.read(spark, "edges")) == values(edges)
    settle(corpus, spark, 0, 101)
    assert values(corpus.read_papers(spark)) == values(papers)


def test_pages_of_one_parent_in_two_landings(spark, frame, values, scene):
    """A parent noted as done still takes the pages that land later."""
    corpus, landing, checkpoint = start(spark, scene, "corpus")
    for part in ([r for r in scene[2] if r[3] == 0], [r for r in scene[2] if r[3] > 0]):
        frame(part, RESPONSES).write.mode("append").parquet(landing)
        run(spark, scene, corpus, landing, checkpoint)
    papers, edges = whole(scene, frame)
    assert values(corpus.read_papers(spark).select("ss_id")) == values(papers.select("ss_id"))
    assert values(corpus.read(spark, "edges")) == values(edges)


def test_first_seen(spark, frame, values):
    schema = frame([], "user int, at int, what string").schema
    parts = ([(1, 5, "a"), (1, 3, "b"), (2, 9, "c")], [(1, 1, "d"), (3, 4, "e"), (3, 2, "f"), (2, 9, "c")])
    for by_order, want in ((False, [(1, 3, "b"), (2, 9, "c"), (3, 2, "f")]), (True, [(1, 1, "d"), (2, 9, "c"), (3, 2, "f")])):
        staging = Staging(spark, "seen")
        landing, target, checkpoint = staging.path("landing"), staging.path("target"), staging.path("checkpoint")
        for part in parts:
            frame(part, schema).write.mode("append").parquet(landing)
            first_seen(spark, landing, schema, target, "user", ["at"], checkpoint, by_order=by_order).awaitTermination()
        # Landing order decides between landings unless the order is to, the order column within one.
        assert values(read_first(spark, target, schema, "user", ["at"])) == want
