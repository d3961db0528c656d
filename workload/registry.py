"""Registration of queries and of the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# Views over the test tables, in SQL; `workload.tables` has the same ones as DataFrames.
VIEWS = r"""
WITH g_papers AS (
  SELECT p_partkey AS id, concat('P', CAST(p_partkey AS VARCHAR)) AS ss_id, p_name AS title,
         p_type AS abstract, p_brand AS search_term, CAST(0 AS INT) AS num_hops,
         concat('/part/', CAST(p_partkey AS VARCHAR)) AS url, (p_size % 2 = 0) AS is_processed
  FROM part),
raw_edges AS (
  SELECT concat('O', CAST(l_orderkey AS VARCHAR)) AS ss_id, concat('P', CAST(l_partkey AS VARCHAR)) AS reference_id,
         l_returnflag, l_linestatus
  FROM lineitem),
g_edges AS (SELECT DISTINCT ss_id, reference_id FROM raw_edges),
g_terms AS (
  SELECT p_brand AS term, CAST(row_number() OVER (ORDER BY p_brand) - 1 AS BIGINT) AS term_pos
  FROM (SELECT DISTINCT p_brand FROM part)),
d_papers AS (
  SELECT doc_id AS id, concat('D', CAST(doc_id AS VARCHAR)) AS ss_id, split_part(text, chr(10), 1) AS title,
         text AS abstract, source AS search_term, CAST(0 AS INT) AS num_hops,
         concat('/doc/', CAST(doc_id AS VARCHAR)) AS url, quality = 1 AS is_processed, lang
  FROM documents LEFT JOIN labels USING (doc_id)),
d_terms AS (
  SELECT source AS term, CAST(row_number() OVER (ORDER BY source) - 1 AS BIGINT) AS term_pos
  FROM (SELECT DISTINCT source FROM documents)),
o_papers AS (
  SELECT o_orderkey AS id, concat('O', CAST(o_orderkey AS VARCHAR)) AS ss_id,
         concat('Order ', o_orderpriority) AS title, concat('Status ', o_orderstatus) AS abstract,
         o_orderpriority AS search_term, CAST(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS INT) AS num_hops,
         concat('/order/', CAST(o_orderkey AS VARCHAR)) AS url, o_orderstatus = 'F' AS is_processed, o_orderstatus
  FROM orders),
o_terms AS (
  SELECT o_orderpriority AS term, CAST(row_number() OVER (ORDER BY o_orderpriority) - 1 AS BIGINT) AS term_pos
  FROM (SELECT DISTINCT o_orderpriority FROM orders))
"""


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``sql`` may use the views above."""

    def register(build: Query) -> Query:
        QUERIES[name] = build
        if sql is not None:
            body = sql.strip()
            # A body with further views of its own goes on with the list.
            ORACLES[name] = VIEWS.rstrip() + (body if body.startswith(",") else "\n" + body)
        return build

    return register
