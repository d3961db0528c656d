"""Every registered query beside its SQL."""

import duckdb
import pytest

from __spark_entry__ import entry
from check import TABLES, rows_of
from citeweave.staging import Staging
from workload.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def check_plan(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert operator not in plan
    assert "Window" not in plan or "SinglePartition" not in plan


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name, monkeypatch):
    """Rows as those of the SQL; the plan of the query and of every table it stages is sound."""
    write = Staging.write
    monkeypatch.setattr(Staging, "write", lambda self, df, name="table": (check_plan(df), write(self, df, name))[1])
    df = QUERIES[name](spark, SF)
    result = duck.execute(ORACLES[name])
    names = [column[0] for column in result.description]
    assert sorted(df.columns) == sorted(names)
    assert rows_of(df.columns, [tuple(row) for row in df.collect()]) == rows_of(names, result.fetchall())
    check_plan(df)


def test_entry(spark):
    assert not entry(spark).isEmpty()
