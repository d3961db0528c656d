"""Places within groups that fill many ranges."""

import random

import pytest
from pyspark.sql import functions as F

from citeweave.operators.identity import place_within
from test_plans import plan_of, settings


def plain(rows):
    found, seen = [], {}
    order = sorted(rows, key=lambda r: tuple((x is not None, x) for x in r))
    for a, b, c in order:
        seen[a, b] = seen.get((a, b), -1) + 1
        found.append((a, b, c, seen[a, b]))
    return sorted(found, key=repr)


@pytest.mark.parametrize("parts", ["1", "3", "40"])
def test_places(spark, frame, staging, values, parts):
    draw = random.Random(int(parts))
    rows = {(draw.choice(["a", "b", None, "", "hub"]), draw.choice([0, 1, None]), i) for i in range(300)}
    rows |= {("hub", 0, 1000 + i) for i in range(700)}
    with settings(spark, spark__sql__shuffle__partitions=parts, spark__sql__adaptive__coalescePartitions__enabled="false"):
        found = place_within(frame(sorted(rows, key=repr), "a string, b int, c int"), ["a", "b"], ["c"], staging)
        assert values(found) == plain(rows)
        empty = place_within(frame([], "a string, b int, c int"), ["a", "b"], ["c"], staging)
        assert values(empty) == []


def test_one_hub_over_all_ranges(spark, staging):
    with settings(spark, spark__sql__shuffle__partitions="16", spark__sql__adaptive__coalescePartitions__enabled="false"):
        rows = spark.range(50_000).select(F.lit("hub").alias("a"), F.col("id").alias("c"))
        found = place_within(rows, ["a"], ["c"], staging)
        assert found.where("place <> c").isEmpty() and found.count() == 50_000
        ranged = spark.read.parquet(f"{staging.root}/*-place-ranged")
        assert ranged.select("_part").distinct().count() == 16 and ranged.where("_head").count() == 50_000
        # The rows were dealt once, by ranges, and what follows reads them where they lie.
        assert "Exchange" not in plan_of(found)
