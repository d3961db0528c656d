"""Connected components of a graph of any size, by rounds of star contraction.

Each round points every node at the smallest node among its neighbours, first for the neighbours
above it and then for those below (large star, small star), until nothing changes; the number of
rounds grows with the logarithm of the number of nodes. Each half round is a minimum per node (with a
map-side part) and a join that Spark can split at a hub, written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeweave.staging import Staging


def component_labels(edges: DataFrame, staging: Staging) -> DataFrame:
    """(node, component) for every node that isn't the smallest of its component.

    ``edges`` has the long columns ``a`` and ``b``; repeated edges, loops and edges with a null end do no harm.
    """
    pairs = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    pairs = staging.write(pairs, "edges")
    state = None
    while True:
        both = pairs.union(pairs.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = staging.write(large.where("a <> b").distinct(), "large-star")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        pairs = staging.write(small.select("e.*").where("a <> b").distinct(), "small-star")
        now = pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            return pairs.select(F.col("a").alias("node"), F.col("b").alias("component"))
        state = now
