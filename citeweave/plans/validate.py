"""One report over all constraints of a corpus, and its orphaned edges kept up to date."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeweave.operators.checks import orphan_edges, orphans_after, repeated_keys
from citeweave.schemas import EDGES, PAPERS
from citeweave.sources.corpus import Corpus, touched
from citeweave.staging import Staging


def _null_counts(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """Nulls of all columns from one scan, as rows."""
    counts = df.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in columns])
    return counts.unpivot([], columns, "column", "violations").select(
        F.concat(F.lit(f"{table} not null "), "column").alias("check"), "violations"
    )


def _row_count(df: DataFrame, check: str) -> DataFrame:
    return df.agg(F.count("*").alias("violations")).select(F.lit(check).alias("check"), "violations")


def validate(papers: DataFrame, edges: DataFrame, staging: Staging) -> DataFrame:
    """``(check, violations)`` for every constraint: nulls, repeated keys, orphaned edges."""
    required = [field.name for field in PAPERS.fields if not field.nullable]
    parts = [
        _null_counts(papers, "papers", required),
        _null_counts(edges, "edges", EDGES.fieldNames()),
        _row_count(repeated_keys(papers, ["id"]), "papers unique id"),
        _row_count(repeated_keys(papers, ["ss_id"]), "papers unique ss_id"),
        _row_count(repeated_keys(edges, ["ss_id", "reference_id"]), "edges unique pair"),
        # A null end is counted above, as a foreign key lets nulls pass.
        _row_count(orphan_edges(edges.na.drop(), papers, staging), "edges ends are papers"),
    ]
    return reduce(DataFrame.unionByName, parts)


def check_orphans(corpus: Corpus, spark: SparkSession, batch: int) -> DataFrame:
    """The orphans of a corpus, kept as a table of batch ``batch`` and brought up to date by what came since the last check.

    Where a batch that was checked has been written again, everything is checked anew.
    """
    entries = corpus.batches(spark, before=batch)
    now = {table: {entry["tables"][table] for entry in entries if table in entry["tables"]} for table in ("papers", "edges")}
    last = max((entry for entry in entries if "checked" in entry), key=lambda entry: entry["batch"], default=None)
    checked = {table: set(last["checked"][table]) if last else set() for table in now}
    if any(checked[table] - now[table] for table in now):
        last, checked = None, {table: set() for table in now}
    new = {table: corpus.read_folders(spark, table, sorted(now[table] - checked[table])) for table in now}
    previous = corpus.read_folders(spark, "orphans", [last["tables"]["orphans"]] if last else [])
    papers = corpus.read(spark, "papers", before=batch)
    with Staging(spark, "orphans") as staging, corpus.batch(spark, batch) as out:
        out.append("orphans", orphans_after(previous, new["edges"], new["papers"], papers, staging, touched))
        out.notes["checked"] = {table: sorted(now[table]) for table in now}
    return corpus.read_folders(spark, "orphans", [out.tables["orphans"]])
