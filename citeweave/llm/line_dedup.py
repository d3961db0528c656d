"""Lines that recur across documents, removed by counting the documents of every line hash.

Lines are exploded with their document and place, hashed and counted; a key found in enough documents stays
only in the largest document id that holds it. The places that a text must lose are then gathered per
text (never more than its own lines) and it is put together again from the places that stay. Only
hashes are counted and shuffled; a text moves once, in the last join. Work grows with the lines of a document,
not with their square.

Null and empty texts are one empty line. A null ``doc_id`` counts as one document of its own, below
all others. Rows that repeat a ``doc_id`` are one document for the count, and each of them is
cleaned. An empty table gives an empty table. ``n_lines`` and ``n_dropped`` are new columns, in place of input columns of
these names; other columns of the input pass through untouched, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeweave.llm.common import SPACES, ascii_lower, two_hashes, unused
from citeweave.staging import Staging


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z in lower case."""
    return ascii_lower(F.trim(line, F.lit(SPACES)))


def key_hash(line: Column, min_chars: int) -> Column:
    """128 bits of the line's key, null for keys that are too short to count."""
    key = line_key(line)
    first, second = two_hashes(key)
    # Bytes are never fewer than code points, so most short lines are told without counting those.
    long_enough = (F.octet_length(line) >= min_chars) & (F.char_length(key) >= min_chars)
    return F.when(long_enough, F.struct(first.alias("h1"), second.alias("h2")))


def text_key(text: Column) -> Column:
    """Tells the texts of one ``doc_id`` apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def repeated_lines(docs: DataFrame, staging: Staging, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """What each text loses: (doc_id, text_key, n_gone, marks), with a byte ``1`` in ``marks`` at the places of its lines that live on elsewhere."""
    # The key is worked out before the lines are exploded, else once for each line.
    keyed = docs.select("doc_id", text_key(F.col("text")).alias("text_key"), lines_of(F.col("text")).alias("lines"))
    found = keyed.select("doc_id", "text_key", F.posexplode("lines").alias("place", "line"))
    keys = found.select("doc_id", "text_key", "place", key_hash(F.col("line"), min_chars).alias("key")).where("key IS NOT NULL")
    keys = staging.write(keys.select("doc_id", "text_key", "place", "key.h1", "key.h2"), "line-keys")
    frequent = (
        keys.groupBy("h1", "h2", "doc_id")
        .agg(F.lit(1).alias("one"))
        .groupBy("h1", "h2")
        .agg(F.count("*").alias("docs"), F.max("doc_id").alias("keeper"))
        .where(F.col("docs") >= min_docs)
        .select("h1", "h2", "keeper")
    )
    frequent = staging.write(frequent, "frequent-lines")
    gone = (
        keys.join(frequent, ["h1", "h2"])
        .where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
        .groupBy("doc_id", "text_key")
        .agg(F.sort_array(F.collect_set("place")).alias("gone"))
    )
    before = F.concat(F.array(F.lit(-1)), F.slice("gone", 1, F.size("gone") - 1))
    marks = F.zip_with("gone", before, lambda place, last: F.concat(F.repeat(F.lit("0"), place - last - 1), F.lit("1")))
    return gone.select("doc_id", "text_key", F.size("gone").alias("n_gone"), F.array_join(marks, "").cast("binary").alias("marks"))


def drop_repeated_lines(docs: DataFrame, staging: Staging, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """``docs`` with ``text`` cleaned, and new columns ``n_lines`` (before) and ``n_dropped``."""
    names = [name for name in docs.columns if name not in ("n_lines", "n_dropped")]
    doc, key, gone, marks = (unused(docs.columns, name) for name in ("_doc", "_key", "_gone", "_marks"))
    lost = repeated_lines(docs, staging, min_chars, min_docs).toDF(doc, key, gone, marks)
    lost = staging.write(lost, "lines-to-drop")
    # The same join at every size: texts always move once, whether or not the other side is small.
    same = F.col("doc_id").eqNullSafe(F.col(doc)) & (text_key(F.col("text")) == F.col(key))
    joined = docs.select(*names).join(lost.hint("merge"), same, "left")
    every = lines_of(F.col("text"))
    # Bytes are found by their place, so this is one pass over the lines.
    kept = F.array_join(F.filter(every, lambda _, place: F.substring(F.col(marks), place + 1, F.lit(1)) != F.lit(b"1")), "\n")
    cleaned = F.when(F.col(gone).isNull(), F.coalesce(F.col("text"), F.lit(""))).otherwise(kept)
    return joined.select(
        *[cleaned.alias(name) if name == "text" else F.col(name) for name in names],
        F.size(every).cast("long").alias("n_lines"),
        F.coalesce(F.col(gone), F.lit(0)).cast("long").alias("n_dropped"),
    )
