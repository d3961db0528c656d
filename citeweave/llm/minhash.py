"""Near-duplicate texts by an inverted join over MinHash coordinates.

1. Every text becomes the set of its runs of words. Texts with equal sets form a class, and only
   classes go on, so that a text which a third of the rows share is one row from here.
2. A class is posted under each of its ``COORDINATES`` pairs (coordinate, minimum). A pair of sets
   with the wanted similarity agrees in ``MATCHES`` of them but for a chance of some millionths. Values
   that no other class has can't match, so they are dropped; the rest are put in order of frequency, and
   only a prefix is kept: two classes with enough matches meet in the prefixes, and frequent values,
   which come from passages that many documents share, are met last.
3. Within a posting list each member is first compared with one pivot, the member with the most
   frequent values, which stands in the middle of a group of copies. Most of a large group is linked
   then, and pairs inside one component need no further look. Members of different components are
   compared in a second join, which skips a pair except under the first value they share, and counts
   the collisions of the whole signatures. Long lists are dealt over several tasks in both.
4. Before a pair is a row, a parity bitmap bounds the symmetric difference of the sets from below and
   rules out pairs that can't be similar enough. All others are compared on their full sets.
5. Components of the links are found by star contraction.

A null text, an empty text or one of white space only has no words and links with nothing. With fewer
words than a run has, the whole sequence is the one run. A class is known by its smallest ``doc_id``;
null ids come last, and a group of null ids only has a null component. Rows that repeat a ``doc_id`` and
a text get equal results. Only ``doc_id`` and ``text`` are looked at. Empty tables give empty tables.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache, reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citeweave.llm.components import component_labels
from citeweave.operators.identity import dense_position
from citeweave.staging import Staging

# Of 24 coordinates a pair of similarity 0.8 shares fewer than 10 once in 170,000 times.
COORDINATES = 24
MATCHES = 10
BITMAP_WORDS = 8
BLOCK = 2048

_SKETCH = "doc_id long, digest binary, n_shingles long, signature array<int>, " + ", ".join(f"b{i} long" for i in range(BITMAP_WORDS))
_BITS = [f"b{i}" for i in range(BITMAP_WORDS)]


class _Words(dict):
    """64-bit hashes of words, kept while there is room."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


@cache
def _words() -> _Words:
    return _Words()


@cache
def _permutations() -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(20240229).integers(0, 1 << 64, (2, COORDINATES, 1), dtype=np.uint64)
    return draw[0] | np.uint64(1), draw[1]


def shingles(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of ``words`` words, A-Z in lower case."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(_words().__getitem__, found), np.uint64, len(found))
    width = min(words, len(found))
    mixed = np.full(len(found) - width + 1, width, np.uint64)
    for k in range(width):
        mixed = (mixed ^ hashes[k : len(found) - width + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(32)
    return np.unique(mixed)


def digest(found: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(found.tobytes())


def signature(found: np.ndarray) -> np.ndarray:
    a, b = _permutations()
    least = np.full(COORDINATES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(found), 65_536):
        least = np.minimum(least, (found[at : at + 65_536] * a + b).min(axis=1))
    return (least >> np.uint64(32)).astype(np.uint32).view(np.int32)


def bitmap(found: np.ndarray) -> np.ndarray:
    """Parity of the number of members in each of 512 classes of hashes."""
    odd = np.bincount((found >> np.uint64(55)).astype(np.int64), minlength=64 * BITMAP_WORDS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def sketches(docs: DataFrame, words: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, sizes, signatures, bits = [], [], [], []
            for text in batch.column(1):
                found = shingles(text.as_py(), words)
                digests.append(digest(found))
                sizes.append(len(found))
                signatures.append(signature(found))
                bits.append(bitmap(found))
            flat = np.concatenate(signatures) if signatures else np.zeros(0, np.int32)
            table = np.array(bits, np.int64).reshape(-1, BITMAP_WORDS)
            offsets = pa.array(np.arange(len(sizes) + 1) * COORDINATES, pa.int32())
            columns = [batch.column(0), pa.array(digests, pa.binary()), pa.array(sizes, pa.int64())]
            columns += [pa.ListArray.from_arrays(offsets, pa.array(flat, pa.int32())), *(pa.array(table[:, i]) for i in range(BITMAP_WORDS))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "digest", "n_shingles", "signature", *_BITS])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, _SKETCH)


def posting_entries(classes: DataFrame, staging: Staging) -> DataFrame:
    """(key, at, node, n_shingles, b0.., hits, weight): the prefix of each class in order of frequency.

    ``hits`` are all its keys that other classes have too, ``at`` is the place of ``key`` in them, and
    ``weight`` is how often they occur.
    """
    # A key is the coordinate above the 32 bits of its minimum.
    keys = F.transform("signature", lambda value, i: F.shiftleft(i.cast("long"), 32).bitwiseOR(value.cast("long").bitwiseAND(F.lit((1 << 32) - 1))))
    posted = classes.select("node", F.explode(keys).alias("key"))
    shared = staging.write(posted.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "shared-minima")
    hits = (
        posted.join(shared.hint("merge"), "key")
        .groupBy("node")
        .agg(F.sort_array(F.collect_list(F.struct("n", "key"))).alias("found"))
        .where(F.size("found") >= MATCHES)
    )
    hits = hits.select(
        "node",
        F.transform("found", lambda x: x["key"]).alias("hits"),
        F.aggregate("found", F.lit(0).cast("long"), lambda total, x: total + x["n"]).alias("weight"),
    )
    rows = staging.write(hits, "hits").join(classes.select("node", "n_shingles", *_BITS).hint("merge"), "node")
    prefix = F.slice("hits", F.lit(1), F.size("hits") - MATCHES + 1)
    entries = rows.select("node", "n_shingles", *_BITS, "hits", "weight", F.posexplode(prefix).alias("at", "key"))
    return staging.write(entries, "entries")


def _may_be_similar(one: str, other: str, percent: int) -> Column:
    """False only where sizes or bitmaps rule out the similarity."""
    a, b = F.col(f"{one}.n_shingles"), F.col(f"{other}.n_shingles")
    apart = reduce(lambda x, y: x + y, [F.bit_count(F.col(f"{one}.{i}").bitwiseXOR(F.col(f"{other}.{i}"))) for i in _BITS])
    return (100 * F.least(a, b) >= percent * F.greatest(a, b)) & ((100 + percent) * apart <= (100 - percent) * (a + b))


def pivot_pairs(entries: DataFrame, percent: int, staging: Staging) -> DataFrame:
    """Each member of a posting list with the list's pivot: distinct (a, b), a < b."""
    # The pivot's number alone goes through the aggregate; its set's size and bitmap are joined to it.
    top = entries.groupBy("key").agg(F.max(F.struct("weight", (-F.col("node")).alias("minus"))).alias("top"), F.count("*").alias("members"))
    nodes = entries.where("at = 0").select("node", "n_shingles", *_BITS)
    pivots = top.where("members > 1").select("key", (-F.col("top.minus")).alias("node")).join(nodes.hint("merge"), "node")
    pivots = staging.write(pivots, "pivots")
    e, p = entries.alias("e"), pivots.hint("merge").alias("p")
    met = e.join(p, (F.col("e.key") == F.col("p.key")) & (F.col("e.node") != F.col("p.node")) & _may_be_similar("e", "p", percent))
    pairs = met.select(F.least("e.node", "p.node").alias("a"), F.greatest("e.node", "p.node").alias("b"))
    return staging.write(pairs.distinct(), "pivot-pairs")


def cross_pairs(entries: DataFrame, labels: DataFrame, tested: DataFrame, percent: int, staging: Staging) -> DataFrame:
    """Pairs of different components that enough coordinates share and that aren't in ``tested``."""
    own = entries.join(labels.hint("merge"), "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = own.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("members")).where("low < high")
    own = own.join(staging.write(mixed.select("key", "members"), "mixed-lists").hint("merge"), "key")
    parts = F.ceil(F.col("members") / BLOCK).cast("int")
    own = staging.write(own.withColumn("parts", parts), "mixed-entries")
    left = own.withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    right = own.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    l, r = left.alias("l"), right.hint("merge").alias("r")
    earlier = F.arrays_overlap(F.slice("l.hits", F.lit(1), F.col("l.at")), F.slice("r.hits", F.lit(1), F.col("r.at")))
    matches = F.size(F.array_intersect("l.hits", "r.hits"))
    met = l.join(
        r,
        (F.col("l.key") == F.col("r.key"))
        & (F.col("l.part") == F.col("r.part"))
        & (F.col("l.node") < F.col("r.node"))
        & (F.col("l.component") != F.col("r.component"))
        & _may_be_similar("l", "r", percent)
        & ~earlier
        & (matches >= MATCHES),
    )
    pairs = met.select(F.col("l.node").alias("a"), F.col("r.node").alias("b"))
    return staging.write(pairs.join(tested.hint("merge"), ["a", "b"], "left_anti"), "cross-pairs")


def class_texts(docs: DataFrame, wanted: DataFrame, words: int, staging: Staging) -> DataFrame:
    """(node, text) of a document of each class in ``wanted`` (node, doc_id, digest)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Rows that repeat the id with another text belong to another class.
            fits = [digest(shingles(text.as_py(), words)) == own.as_py() for text, own in zip(batch.column(1), batch.column(2), strict=True)]
            yield batch.filter(pa.array(fits, pa.bool_())).select([0, 1])

    wanted = wanted.withColumnRenamed("doc_id", "_doc").hint("merge")
    found = docs.select("doc_id", "text").join(wanted, F.col("doc_id").eqNullSafe(F.col("_doc")))
    return staging.write(found.select("node", "text", "digest").mapInArrow(run, "node long, text string"), "class-texts")


def verified(pairs: DataFrame, texts: DataFrame, words: int, percent: int, staging: Staging) -> DataFrame:
    """The pairs whose full sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, np.ndarray] = {}

        def of(node: int, text: pa.Scalar) -> np.ndarray:
            if node not in kept:
                if len(kept) >= 256:
                    kept.clear()
                kept[node] = shingles(text.as_py(), words)
            return kept[node]

        for batch in batches:
            fits = []
            for a, b, one, other in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3), strict=True):
                x, y = of(a, one), of(b, other)
                union = len(np.union1d(x, y))
                fits.append(100 * (len(x) + len(y) - union) >= percent * union)
            yield batch.filter(pa.array(fits, pa.bool_())).select([0, 1])

    one = texts.select(F.col("node").alias("a"), F.col("text").alias("one"))
    other = texts.select(F.col("node").alias("b"), F.col("text").alias("other"))
    joined = pairs.join(one.hint("merge"), "a").join(other.hint("merge"), "b").select("a", "b", "one", "other")
    return staging.write(joined.mapInArrow(run, "a long, b long"), "links")


def grouped(docs: DataFrame, staging: Staging, words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The sketches of all rows, and (digest, component_id, head) of each class; one class of a component is its head."""
    rows = staging.write(sketches(docs, words), "sketches")
    some = ["n_shingles", "signature", *_BITS]
    classes = rows.where("n_shingles > 0").groupBy("digest").agg(F.min("doc_id").alias("doc_id"), *(F.first(c).alias(c) for c in some))
    classes = dense_position(classes.withColumn("_last", F.col("doc_id").isNull()), ["_last", "doc_id", "digest"], staging, column="node").drop("_last")
    classes = staging.write(classes, "classes")
    entries = posting_entries(classes, staging)
    tested = pivot_pairs(entries, percent, staging)
    candidates = entries.where("at = 0").select("node").join(classes.select("node", "doc_id", "digest").hint("merge"), "node")
    texts = class_texts(docs, candidates, words, staging)
    links = verified(tested, texts, words, percent, staging)
    labels = component_labels(links, staging)
    more = verified(cross_pairs(entries, labels, tested, percent, staging), texts, words, percent, staging)
    labels = component_labels(links.union(more), staging)
    heads = classes.select(F.col("node").alias("component"), F.col("doc_id").alias("component_id"))
    named = (
        classes.select("digest", "node")
        .join(labels.hint("merge"), "node", "left")
        .select("digest", "node", F.coalesce("component", "node").alias("component"))
        .join(heads.hint("merge"), "component")
        .select("digest", "component_id", (F.col("node") == F.col("component")).alias("head"))
    )
    return rows, staging.write(named, "components").hint("merge")


def near_duplicates(docs: DataFrame, staging: Staging, words: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``."""
    rows, named = grouped(docs, staging, words, percent)
    own = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return (
        rows.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("digest")).alias("digest"))
        .join(named, "digest", "left")
        .select("doc_id", "n_shingles", own.alias("component_id"), F.col("doc_id").eqNullSafe(own).alias("kept"))
    )


def one_per_group(docs: DataFrame, staging: Staging, words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each component and all rows without words.

    The row is of the head class and has its smallest ``doc_id``; among several of those the smallest hash of the row decides.
    """
    rows, named = grouped(docs, staging, words, percent)
    wordless = F.col("n_shingles") == 0
    chosen = F.col("head") & F.col("doc_id").eqNullSafe(F.col("component_id"))
    decided = rows.select("doc_id", "n_shingles", "digest").join(named, "digest", "left").select("doc_id", F.when(wordless, True).otherwise(chosen).alias("kept"))
    # An id that no other row has decides for its row. The rows of other ids are looked at one by one.
    ids = decided.groupBy(F.col("doc_id").alias("_id")).agg(F.max("kept").alias("_kept"), (F.count("*") > 1).alias("_repeated"))
    ids = staging.write(ids.where("_repeated OR NOT _kept"), "ids")
    same = F.col("doc_id").eqNullSafe(F.col("_id"))
    single = docs.join(ids.hint("merge"), same, "left_anti")
    repeated = ids.where("_repeated")
    if repeated.isEmpty():
        return single

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(text.as_py(), words) for text in batch.column(batch.schema.get_field_index("text"))]
            added = [pa.array([digest(x) for x in sets], pa.binary()), pa.array([len(x) for x in sets], pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], [*batch.schema.names, "_digest", "_words"])

    added = T.StructType.fromDDL("_digest binary, _words long")
    copies = docs.join(repeated, same, "left_semi").mapInArrow(run, T.StructType(docs.schema.fields + added.fields))
    copies = staging.write(copies, "repeated-ids")
    row = F.struct(*docs.columns)
    first = copies.where("_words > 0").groupBy("_digest", "doc_id").agg(F.min_by(row, F.xxhash64(row)).alias("_row")).select("_digest", "_row")
    heads = named.where("head").select(F.col("digest").alias("_digest"), "component_id")
    first = first.join(heads, "_digest").where(F.col("_row.doc_id").eqNullSafe(F.col("component_id"))).select("_row.*")
    return single.unionByName(first).unionByName(copies.where("_words = 0").select(*docs.columns))
