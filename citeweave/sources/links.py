"""Edges stored from either end, in slices by the paper they are seen from.

Every edge is there twice, as a citation of one paper and as a reference of the other, and all links of a paper are
in one slice, a folder that the key's hash tells. A slice is as many files as the salts it was dealt by, so a hub's
slice is written and read by many tasks; rows are sorted by the paper within a file. The number of slices stands in the
folders' names, so a table says by itself how it was cut.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeweave.operators.neighbours import both_directions, links_of, slice_of

SLICES = 64
LINKS = "parent_ss_id string, direction int, ss_id string, of int, slice int"


@dataclass(frozen=True)
class Links:
    """A link table as it was written."""

    rows: DataFrame
    slices: int

    def of(self, frontier: DataFrame) -> DataFrame:
        return links_of(frontier, self.rows, self.slices)


def write_links(edges: DataFrame, path: str, slices: int = SLICES) -> None:
    """Write both views of every edge, in place of what was in ``path``."""
    salts = max(1, int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions")) // slices)
    links = both_directions(edges).withColumns({"of": F.lit(slices), "slice": slice_of(F.col("parent_ss_id"), slices)})
    dealt = links.repartition("slice", F.pmod(F.xxhash64("ss_id"), F.lit(salts))).sortWithinPartitions("slice", "parent_ss_id")
    dealt.write.mode("overwrite").partitionBy("of", "slice").parquet(path)


def read_links(spark: SparkSession, path: str) -> Links:
    """A table without a link has no slices, and needs none."""
    rows = spark.read.schema(LINKS).parquet(path)
    first = rows.select("of").first()
    return Links(rows, first["of"] if first else 1)
