"""Shards of near equal bytes as the leaves of a K-d tree over document metadata.

Units are the groups of equal texts; a group larger than a fraction of a shard is first cut by hashes
of its document ids. A unit is a point (size, language, source) with its bytes as weight. A node that
has to become n shards is split where the share floor(n/2)/n of its bytes is reached along the dimension in
which it is widest, measured against the whole table; names are placed by hash. All nodes of a level are
split together: weighted histograms over the node's range are refined until the cut is fine enough, so
the driver holds ``BINS`` sums per node and no task sorts a node. Units with equal keys stay together.

The size of a document is its UTF-8 bytes (none for a null text) and ``OVERHEAD``. Null languages and
sources are a value of their own. Rows that repeat an id are documents each. Only the columns ``doc_id``,
``text``, ``lang`` and ``source`` are looked at. An empty table gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeweave.llm.common import number_within, two_hashes
from citeweave.staging import Staging

OVERHEAD = 16
BINS = 2048
DIMENSIONS = ("by_size", "by_lang", "by_source")
#: A group of equal texts above this part of a shard is cut.
GROUP_PART = 64
#: A cut is fine enough when it misses its share by this part of a shard.
TOLERANCE = 0.0005


@dataclass
class Node:
    shards: int
    first: int  # number of its first shard
    dimension: str | None = None
    cut: int | None = None  # keys below it go left
    left: Node | None = None
    right: Node | None = None


@dataclass
class _Search:
    """Where a node's cut can lie, and the bytes below that range."""

    dimension: str
    low: int
    high: int
    below: int
    goal: float
    cut: int | None = None


def sized_rows(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    h1, h2 = two_hashes(text)
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + OVERHEAD).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        h1.alias("h1"),
        h2.alias("h2"),
        F.coalesce("lang", F.lit("")).alias("lang"),
        F.coalesce("source", F.lit("")).alias("source"),
    )


def units_of(rows: DataFrame, shards: int, staging: Staging) -> tuple[DataFrame, DataFrame]:
    """``rows`` with their ``piece``, and one row per unit: (h1, h2, piece, weight, dimensions, tie)."""
    groups = rows.groupBy("h1", "h2").agg(F.sum("size").alias("bytes"))
    most = (rows.agg(F.sum("size")).first()[0] or 0) / (shards * GROUP_PART)
    # Each has over most bytes, so there are at most shards * GROUP_PART of them, whatever the table's size.
    large = groups.where(F.col("bytes") > most).select("h1", "h2", F.ceil(F.col("bytes") / F.lit(max(most, 1.0))).alias("pieces"))
    large = staging.write(large, "large-groups")
    piece = F.coalesce(F.pmod(F.xxhash64("doc_id", "size"), F.col("pieces")), F.lit(0)).cast("int")
    rows = staging.write(rows.join(F.broadcast(large), ["h1", "h2"], "left").withColumn("piece", piece).drop("pieces"), "rows")
    name = lambda c: F.pmod(F.xxhash64(c), F.lit(1 << 31))
    units = rows.groupBy("h1", "h2", "piece").agg(
        F.sum("size").alias("weight"), F.max("size").alias("one"), F.min("lang").alias("lang"), F.min("source").alias("source")
    )
    units = units.select(
        "h1",
        "h2",
        "piece",
        "weight",
        F.floor(F.log2(F.col("one").cast("double")) * (1 << 25)).alias("by_size"),
        name("lang").alias("by_lang"),
        name("source").alias("by_source"),
        # The pieces of a group follow each other.
        (F.shiftleft(F.pmod("h1", F.lit(1 << 20)), 12) + F.col("piece")).alias("tie"),
    )
    return rows, staging.write(units, "units")


def _key(dimension: str) -> Column:
    return F.shiftleft(dimension, 32) + F.col("tie")


def _leaf(node: Node, leaves: list[Node], value: dict[int, Column]) -> Column:
    """The value of the leaf that a unit falls into."""
    if node.left is None:
        return value[leaves.index(node)]
    return F.when(_key(node.dimension) < node.cut, _leaf(node.left, leaves, value)).otherwise(_leaf(node.right, leaves, value))


def _leaves(node: Node) -> list[Node]:
    return [node] if node.left is None else _leaves(node.left) + _leaves(node.right)


def _refine(units: DataFrame, root: Node, leaves: list[Node], searches: dict[int, _Search], tolerance: float) -> None:
    """One pass over the units: a histogram of each open search, and the search narrowed to one bin or ended."""
    open_ = {i: s for i, s in searches.items() if s.cut is None}
    width = {i: max(1, -(-(s.high - s.low + 1) // BINS)) for i, s in open_.items()}
    nothing = F.lit(None).cast("long")
    of = lambda give: _leaf(root, leaves, {i: give(i, open_[i]) if i in open_ else nothing for i in range(len(leaves))})
    inside = units.select(
        "weight",
        of(lambda i, s: F.lit(i).cast("long")).alias("leaf"),
        of(lambda i, s: F.when(_key(s.dimension).between(s.low, s.high), _key(s.dimension))).alias("key"),
        of(lambda i, s: F.floor((_key(s.dimension) - s.low) / F.lit(width[i])).cast("long")).alias("bin"),
    ).where("key IS NOT NULL")
    sums = inside.groupBy("leaf", "bin").agg(F.sum("weight").alias("weight"), F.min("key").alias("low"), F.max("key").alias("high")).collect()
    by_leaf: dict[int, list] = {}
    for row in sorted(sums, key=lambda row: row["low"]):
        by_leaf.setdefault(row["leaf"], []).append(row)
    for i, s in open_.items():
        below = s.below
        for row in by_leaf[i]:
            over = below + row["weight"]
            if over >= s.goal:
                # The nearer edge will do if it is near enough, or if the bin is a single key.
                if min(s.goal - below, over - s.goal) <= tolerance or row["low"] == row["high"]:
                    s.cut = row["low"] if s.goal - below <= over - s.goal else row["high"] + 1
                s.low, s.high, s.below = row["low"], row["high"], below
                break
            below = over
        else:
            s.cut = s.high + 1


def build_tree(units: DataFrame, shards: int) -> Node:
    root, ranges = Node(shards, 0), None
    while True:
        leaves = _leaves(root)
        if all(leaf.shards == 1 for leaf in leaves):
            return root
        number = _leaf(root, leaves, {i: F.lit(i) for i in range(len(leaves))})
        bounds = [f(d).alias(f"{n}_{d}") for d in DIMENSIONS for n, f in (("low", F.min), ("high", F.max))]
        keys = [f(_key(d)).alias(f"{n}_key_{d}") for d in DIMENSIONS for n, f in (("low", F.min), ("high", F.max))]
        stats = {row["leaf"]: row for row in units.groupBy(number.alias("leaf")).agg(F.sum("weight").alias("weight"), *bounds, *keys).collect()}
        extent = lambda row, d: row[f"high_{d}"] - row[f"low_{d}"]
        if ranges is None:
            ranges = {d: max((extent(row, d) for row in stats.values()), default=0) or 1 for d in DIMENSIONS}
            total = sum(row["weight"] for row in stats.values())
        searches = {}
        for i, leaf in enumerate(leaves):
            if leaf.shards > 1:
                row = stats.get(i)
                if row is None:  # no unit left: empty shards
                    searches[i] = _Search(DIMENSIONS[0], 0, 0, 0, 0, cut=0)
                    continue
                widest = max(DIMENSIONS, key=lambda d: extent(row, d) / ranges[d])
                goal = row["weight"] * (leaf.shards // 2) / leaf.shards
                searches[i] = _Search(widest, row[f"low_key_{widest}"], row[f"high_key_{widest}"], 0, goal)
        while any(s.cut is None for s in searches.values()):
            _refine(units, root, leaves, searches, TOLERANCE * total / shards)
        for i, s in searches.items():
            leaf = leaves[i]
            half = leaf.shards // 2
            leaf.dimension, leaf.cut = s.dimension, s.cut
            leaf.left, leaf.right = Node(half, leaf.first), Node(leaf.shards - half, leaf.first + half)


def kd_shards(docs: DataFrame, staging: Staging, shards: int = 40) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) for every row of ``docs``."""
    rows, units = units_of(sized_rows(docs), shards, staging)
    root = build_tree(units, shards)
    leaves = _leaves(root)
    placed = units.select("h1", "h2", "piece", _leaf(root, leaves, {i: F.lit(leaf.first) for i, leaf in enumerate(leaves)}).cast("int").alias("shard"))
    found = rows.join(placed.hint("merge"), ["h1", "h2", "piece"]).select("doc_id", "size", "text_crc32", "h1", "h2", "shard")
    return number_within(found, ["shard"], ["doc_id", "h1", "h2"], "slot", staging).select("doc_id", "size", "text_crc32", "shard", F.col("slot").cast("long").alias("slot"))
