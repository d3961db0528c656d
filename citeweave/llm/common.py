"""Small helpers that several training-data operators share."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from citeweave.staging import Staging

# The white space [\x20\x09-\x0D] of the line, word and secret rules.
SPACES = " \t\n\x0b\x0c\r"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all other characters as they are."""
    # Where bytes and code points are equally many the text is ASCII, and lower() means the same.
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, CAPITALS, CAPITALS.lower())
    )


def unused(columns: Sequence[str], name: str) -> str:
    """``name``, made longer until no column has it, whatever the case of its letters."""
    taken = {column.lower() for column in columns}
    while name.lower() in taken:
        name += "_"
    return name


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often the body and its lambdas use it."""
    return F.get(F.transform(F.array(value), body), 0)


def in_chunks(array: Column) -> Column:
    """An array cut into as many chunks as each has elements; ``array`` has to be a column or a lambda's variable, and not empty."""
    size = F.ceil(F.sqrt(F.size(array))).cast("int")
    return F.transform(F.sequence(F.lit(0), F.size(array) - 1, size), lambda at: F.slice(array, at + 1, size))


def two_hashes(value: Column) -> tuple[Column, Column]:
    """128 bits of hash as two longs, so that equal hashes mean equal values at any corpus size."""
    return F.xxhash64(value), F.xxhash64(F.lit(1), value)


def number_within(df: DataFrame, groups: Sequence[str], order_by: Sequence[str], column: str, staging: Staging) -> DataFrame:
    """Number the rows of each group from 0 without gaps, however large a group is.

    A group is dealt by hash over as many buckets as there are shuffle partitions; each bucket is
    numbered by itself and shifted by the sizes of the group's buckets before it. Rows equal in
    ``order_by`` share a bucket and get consecutive numbers.
    """
    buckets = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    stored = staging.write(df.withColumn("_bucket", F.pmod(F.xxhash64(*order_by), F.lit(buckets))), f"{column}-rows")
    before = Window.partitionBy(*groups).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        stored.groupBy(*groups, "_bucket")
        .agg(F.count("*").alias("_rows"))
        .select(*groups, "_bucket", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_shift"))
    )
    shifts = staging.write(shifts, f"{column}-shifts")
    place = F.row_number().over(Window.partitionBy(*groups, "_bucket").orderBy(*order_by))
    return (
        stored.join(shifts, [*groups, "_bucket"])
        .withColumn(column, F.col("_shift") + place - 1)
        .drop("_bucket", "_shift")
    )
