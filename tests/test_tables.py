"""Sources, sinks and staged tables."""

import pytest

from citeweave.schemas import PAPERS, RESPONSES, RESULT_PAGES
from citeweave.sources import tables
from citeweave.sources.landed import scan_responses, scan_result_pages
from citeweave.sources.terms import first_positions, read_terms, slice_exclusive, slice_inclusive
from citeweave.staging import Staging, shared_folder

PAPER = [(2, "b", "B", "x", "t", 0, None, False), (1, "a", "A", "x", "t", 0, None, True)]


def test_terms_keep_file_order(spark, staging, values, tmp_path):
    path = tmp_path / "terms.csv"
    path.write_text('Machine Learning\nAI\n"Vision, 3D"\nAI\n"say ""hi"""\n')
    terms = staging.write(read_terms(spark, str(path), staging))
    assert values(terms) == [(0, "Machine Learning"), (1, "AI"), (2, "Vision, 3D"), (3, "AI"), (4, 'say "hi"')]
    assert values(first_positions(terms).filter("term = 'AI'")) == [(1, "AI")]
    assert values(slice_inclusive(terms, 0, 2).select("term_pos")) == [(0,), (1,), (2,)]
    assert values(slice_exclusive(terms, 0, 2).select("term_pos")) == [(0,), (1,)]


def test_only_the_first_column_counts(spark, staging, values, tmp_path):
    path = tmp_path / "terms.csv"
    path.write_text("AI,x,y\n robots ,z\n")
    assert values(read_terms(spark, str(path), staging)) == [(0, "AI"), (1, " robots ")]


def test_terms_in_many_splits(spark, staging, tmp_path):
    """The order holds however the file is cut and the cuts are packed into tasks."""
    names = [f"term {i:05d} " + "x" * (i % 40) for i in range(5000)]
    names.reverse()
    path = tmp_path / "long.csv"
    path.write_text("\n".join(names) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    try:
        rows = read_terms(spark, str(path), staging).orderBy("term_pos").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [row["term"] for row in rows] == [name.rstrip("\n") for name in names]
    assert [row["term_pos"] for row in rows] == list(range(5000))


def test_scans(spark, frame, tmp_path):
    papers = frame(PAPER, PAPERS)
    assert [r["id"] for r in tables.scan_papers(papers).collect()] == [1, 2]
    papers.write.parquet(str(tmp_path / "papers"))
    assert tables.scan_table(spark, "papers", folder=str(tmp_path)).schema.fieldNames() == PAPERS.fieldNames()
    with pytest.raises(ValueError):
        tables.scan_table(spark, "papers")


def test_landed_files(spark, frame, values, tmp_path):
    rows = [(1, "a", 0, 0, 200, "[]"), (1, "a", 1, 0, 429, "slow down"), (2, "b", 0, 0, None, "x")]
    for kind in ("json", "parquet"):
        frame(rows, RESPONSES).write.format(kind).save(str(tmp_path / kind))
        got = scan_responses(spark, str(tmp_path / kind), kind)
        assert values(got.select("id", "direction", "status", "body")) == [(1, 0, 200, "[]"), (1, 1, 429, None), (2, 0, None, None)]
    frame([("ai", 1, "<p>")], RESULT_PAGES).write.parquet(str(tmp_path / "pages"))
    assert values(scan_result_pages(spark, str(tmp_path / "pages"))) == [("ai", 1, "<p>")]


def test_staging_uses_the_shared_folder(spark, frame, values):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert shared_folder(spark) == configured.rstrip("/")
    with Staging(spark, "once") as staging:
        assert staging.root.startswith(shared_folder(spark))
        kept = staging.write(frame([(1,)], "a int"))
        assert values(kept) == [(1,)]
        # The planner knows the size, so it decides about broadcasting by itself.
        joined = frame([(1,)], "a int").repartition(2).join(kept, "a")
        assert "BroadcastHashJoin" in joined._jdf.queryExecution().executedPlan().toString()
        root = staging.root
    assert not tables.path_exists(spark, root)
