"""SimHash fingerprints, and the fingerprints within a Hamming radius by permuted block tables.

A text's terms are its runs of five words (all words where there are fewer), A-Z in lower case; each
occurrence of a term votes with the bits of its 64-bit hash, so a term weighs as often as it occurs.
A bit of the fingerprint is set if more than half of the votes are. Votes are counted inside the
aggregate, two bits of the hash in one long (32 bits for each count).

Block tables: the fingerprint is cut into ``radius + 2`` blocks. Two fingerprints that differ in at
most ``radius`` bits agree in two blocks at least, so each choice of two blocks is a table that is
keyed by them. Only distinct fingerprints enter the tables. A key's fingerprints are gathered in
chunks of bounded size and neighbours are counted chunk by chunk: no pair becomes a row.

Null texts count as empty; an empty text has one term, the empty one. Documents with equal ids are
ordered by their texts; null ids come last. An empty table gives an empty table. Columns other than
``doc_id`` and ``text`` are not looked at.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citeweave.llm.common import SPACES, ascii_lower
from citeweave.staging import Staging

SHINGLE = 5
BITS = 64
_PAIR = (1 << 32) | 1


def word_hashes(text: Column) -> Column:
    words = F.split(F.trim(ascii_lower(text), F.lit(SPACES)), r"[\x20\x09-\x0D]+", -1)
    return F.transform(words, lambda word: F.xxhash64(word))


def term_hashes(hashes: Column, words: int = SHINGLE) -> Column:
    """A hash for each run of ``words`` words. ``hashes`` has to be a column, not an expression."""
    last = F.greatest(F.size(hashes) - words + 1, F.lit(1))
    return F.transform(F.sequence(F.lit(1), last), lambda i: F.xxhash64(F.slice(hashes, i, words)))


def fingerprints(texts: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` and ``fingerprint`` (long) for rows of ``keys`` and ``text``; ``keys`` tell the rows apart."""
    hashed = texts.select(*keys, word_hashes(F.coalesce("text", F.lit(""))).alias("_words"))
    terms = hashed.select(*keys, F.explode(term_hashes(F.col("_words"))).alias("_term"))
    votes = [F.sum(F.shiftrightunsigned("_term", i).bitwiseAND(F.lit(_PAIR))).alias(f"_v{i}") for i in range(32)]
    counted = terms.groupBy(*keys).agg(F.count("*").alias("_n"), *votes)
    bits = F.lit(0).cast("long")
    for i in range(32):
        low = F.col(f"_v{i}").bitwiseAND(F.lit((1 << 32) - 1))
        high = F.shiftrightunsigned(f"_v{i}", 32)
        for count, bit in ((low, i), (high, i + 32)):
            mask = 1 << bit if bit < 63 else -(1 << 63)
            bits = bits.bitwiseOR(F.when(2 * count > F.col("_n"), F.lit(mask)).otherwise(F.lit(0)).cast("long"))
    return counted.select(*keys, bits.alias("fingerprint"))


def likeness(one: Column, other: Column) -> Column:
    """Share of equal bits, 0 to 1."""
    return F.lit(1.0) - F.bit_count(one.bitwiseXOR(other)) / F.lit(float(BITS))


def as_text(fingerprint: Column) -> Column:
    return F.lpad(F.lower(F.hex(fingerprint)), 16, "0")


def _bucket(doc_id: Column, bounds: list[int]) -> Column:
    """How many of the sorted ``bounds`` are below ``doc_id``, by halving."""
    array = F.lit(bounds).cast("array<bigint>")
    steps = [1 << k for k in range(len(bounds).bit_length() - 1, -1, -1)]
    found = F.aggregate(
        F.lit(steps).cast("array<int>"),
        F.lit(0),
        lambda at, step: at + F.when(F.get(array, at + step - 1) < doc_id, step).otherwise(F.lit(0)),
    )
    return F.coalesce(found, F.lit(0))


def next_texts(docs: DataFrame) -> DataFrame:
    """(bucket, place, guard, doc_id, text, next_text): the next document by descending doc_id, after the last the first.

    Documents are dealt by ranges of ids, and the highest document of each range is also dealt, as a
    guard, to the range above, where it follows the last row. One shuffle moves each text once; the
    driver sees the bounds only. Where no document has an id, the last one has no next text.
    """
    spark = docs.sparkSession
    ranges = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = [(i + 1) / ranges for i in range(ranges)]
    found = docs.agg(F.percentile_approx("doc_id", cuts, max(10_000, 20 * ranges)).alias("bounds")).first()["bounds"]
    bounds = sorted(set(found or []))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    if bounds:
        at = _bucket(F.col("doc_id"), bounds)
        own = F.struct(F.col("_at").alias("bucket"), F.lit(0).alias("guard"))
        above = F.struct(F.pmod(F.col("_at") + 1, F.lit(len(bounds))).alias("bucket"), F.lit(1).alias("guard"))
        is_bound = F.get(F.lit(bounds).cast("array<bigint>"), F.col("_at")) == F.col("doc_id")
        rows = (
            rows.withColumn("_at", at)
            .withColumn("_to", F.explode(F.when(is_bound, F.array(own, above)).otherwise(F.array(own))))
            .select("_to.bucket", "_to.guard", "doc_id", "text")
        )
    else:
        rows = rows.select(F.lit(0).alias("bucket"), F.lit(0).alias("guard"), "doc_id", "text")
    order = Window.partitionBy("bucket").orderBy("guard", F.col("doc_id").desc_nulls_last(), "text")
    return rows.withColumn("next_text", F.coalesce(F.lead("text").over(order), F.lit(""))).withColumn(
        "place", F.row_number().over(order)
    )


def edited_text(text: Column, following: Column) -> Column:
    """The last third of ``text`` replaced by the first as many code points of ``following``."""
    size = F.char_length(text)
    third = F.floor(size / 3).cast("int")
    return F.concat(F.substring(text, F.lit(1), size - third), F.substring(following, F.lit(1), third))


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, own, edited, following): fingerprints as longs, one row per document.

    Everything after the dealing by id ranges stays in the partition of the range.
    """
    pairs = next_texts(docs).withColumn("edited", edited_text(F.col("text"), F.col("next_text")))
    row = [F.struct(F.lit(0).alias("which"), F.col("text").alias("text")), F.struct(F.lit(1).alias("which"), F.col("edited").alias("text"))]
    keys = ["bucket", "place", "guard", "doc_id", "n_chars", "sha"]
    texts = pairs.select(
        "bucket",
        "place",
        "guard",
        "doc_id",
        F.char_length("text").cast("long").alias("n_chars"),
        F.unhex(F.sha2("edited", 256)).alias("sha"),
        F.explode(F.array(*row)).alias("_one"),
    ).select(*keys, "_one.which", "_one.text")
    marks = fingerprints(texts, [*keys, "which"])
    both = marks.groupBy(*keys).agg(
        F.max(F.when(F.col("which") == 0, F.col("fingerprint"))).alias("own"),
        F.max(F.when(F.col("which") == 1, F.col("fingerprint"))).alias("edited"),
    )
    order = Window.partitionBy("bucket").orderBy("place")
    return (
        both.withColumn("following", F.lead("own").over(order))
        .where(F.col("guard") == 0)
        .select("doc_id", "n_chars", F.lower(F.hex("sha")).alias("edited_sha256"), "own", "edited", "following")
    )


def block_masks(radius: int) -> list[int]:
    """A mask for each choice of two of ``radius + 2`` blocks, as signed longs."""
    edges = [round(BITS * i / (radius + 2)) for i in range(radius + 3)]
    blocks = [((1 << high) - 1) ^ ((1 << low) - 1) for low, high in zip(edges, edges[1:], strict=False)]
    return [mask - (1 << 64) if mask >> 63 else mask for mask in (a | b for a, b in combinations(blocks, 2))]


def neighbour_counts(prints: DataFrame, staging: Staging, radius: int = 3, chunk: int = 512) -> DataFrame:
    """(fingerprint, docs, near): documents with this fingerprint, and documents with another one within ``radius``.

    ``prints`` has one row per document, with ``fingerprint``. Exact: every pair within the radius
    meets in a table and counts in the first one it meets in.
    """
    masks = block_masks(radius)
    distinct = staging.write(prints.groupBy("fingerprint").agg(F.count("*").alias("docs")), "fingerprints")
    key = lambda mask: F.col("fingerprint").bitwiseAND(F.lit(mask))
    entries = distinct.select(
        "fingerprint", "docs", F.posexplode(F.array(*[key(mask) for mask in masks])).alias("table", "key")
    )
    shared = entries.groupBy("table", "key").agg(F.count("*").alias("members")).where("members > 1")
    shared = staging.write(shared, "shared-blocks")
    members = staging.write(entries.join(shared, ["table", "key"]), "block-tables")
    parts = F.ceil(F.col("members") / chunk)
    part = F.pmod(F.xxhash64("fingerprint", F.lit(1)), parts)
    chunks = members.groupBy("table", "key", part.alias("part")).agg(
        F.collect_list(F.struct(F.col("fingerprint").alias("f"), F.col("docs").alias("n"))).alias("others")
    )

    def counts(other: Column) -> Column:
        x = other["f"].bitwiseXOR(F.col("fingerprint"))
        fits = (x != 0) & (F.bit_count(x) <= radius)
        for k, mask in enumerate(masks[:-1]):
            fits = fits & ((F.col("table") <= k) | (x.bitwiseAND(F.lit(mask)) != 0))
        return fits

    near = F.aggregate(F.filter("others", counts), F.lit(0).cast("long"), lambda total, other: total + other["n"])
    # Every member asks every chunk of its key; the chunk is part of the key, so those of a hot key are asked by many tasks.
    asking = members.select("table", "key", "fingerprint", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)).alias("part"))
    found = (
        asking.join(chunks, ["table", "key", "part"])
        .select("fingerprint", near.alias("near"))
        .groupBy("fingerprint")
        .agg(F.sum("near").alias("near"))
    )
    return distinct.join(found, "fingerprint", "left").withColumn("near", F.coalesce("near", F.lit(0)).cast("long"))
