"""How look-ups land in the queries."""

import pytest
from pyspark.sql import functions as F

from citeweave.functions.payload import payload_problem
from workload import landed_queries, tables


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def sf(frame, tmp_path):
    """Four parts, of two terms and of types that differ in how they answer, each cited by three orders."""
    rows = {
        "part": ([(k, f"part {k}", f"Brand#{k % 2}", ("ECONOMY", "PROMO", "LARGE", "STANDARD")[k], k) for k in range(4)],
                 "p_partkey long, p_name string, p_brand string, p_type string, p_size int"),
        "orders": ([(k, "OFP"[k % 3], ("1-URGENT", "3-MEDIUM")[k % 2]) for k in range(12)], "o_orderkey long, o_orderstatus string, o_orderpriority string"),
        "lineitem": ([(k, k % 4, k % 2) for k in range(12)] * 2, "l_orderkey long, l_partkey long, l_suppkey long"),
        "supplier": ([(k, f"Supplier {k}") for k in range(2)], "s_suppkey long, s_name string"),
    }
    for name, (values, schema) in rows.items():
        frame(values, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


@pytest.mark.parametrize("carry", [(), ("p_brand",)])
def test_bodies_are_written_where_rows_have_come_to_lie(spark, sf, carry):
    landed = tables.landed_responses(spark, sf, tables.table(spark, sf, "part"), carry)
    before, moved = plan_of(landed).split("Exchange", 1)
    assert "citingPaper" in before and "citingPaper" not in moved
    assert landed.columns[6:] == list(carry)
    bodies = {row["id"]: row["body"] for row in landed.filter("direction = 0").collect()}
    assert bodies[0] == (
        '[{"citingPaper":{"paperId":"O0","title":"Order 1-URGENT","abstract":null,"url":"/order/0"}},'
        '{"citingPaper":{"paperId":"O4","abstract":null,"url":"/order/4"}},'
        '{"citingPaper":{"paperId":"O8","title":null,"abstract":null,"url":"/order/8"}}]'
    )
    assert bodies[1].startswith('{"data":[{"citingPaper":{"paperId":"O1","abstract":"Priority 3-MEDIUM"') and bodies[1].endswith("]}")


def test_a_list_with_a_first_item_is_not_made_to_see_that_it_is_one(frame):
    bodies = ['{"data":[null]}', "[7]", '{"data":[]}', "[]", '{"data":"x"}', '{"data":null}']
    rows = frame([(200, body) for body in bodies], "status int, body string").withColumn("payload", F.try_parse_json("body"))
    problem = payload_problem(F.col("status"), F.col("body"), F.col("payload"))
    found = [row[0] for row in rows.select(problem).collect()]
    assert found == [None, None, None, None, "item list is no list", "null item list"]
    assert "$.data[0]" in plan_of(rows.select(problem))


def test_a_hop_reads_look_ups_that_were_written(spark, sf):
    hop = landed_queries.landed_hop(spark, sf)
    assert "Exchange" not in plan_of(hop._responses)


def test_landed_lines_are_compressed(spark, sf):
    files = landed_queries.responses_scan(spark, sf).inputFiles()
    assert files and all(name.endswith(".json.gz") for name in files)
