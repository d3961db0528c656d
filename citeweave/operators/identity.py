"""Consecutive numbers in a given order, without putting all rows into one task."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citeweave.staging import Staging


def dense_position(
    df: DataFrame, order_by: Sequence[str], staging: Staging, *, column: str = "position", first: int = 0
) -> DataFrame:
    """Add ``column`` = ``first``, ``first + 1``, ... in the order of ``order_by``.

    Rows are range-partitioned and sorted, written once, and shifted by the sizes of the
    partitions before them. The driver sees one count per partition and no row. ``order_by``
    must tell all rows apart for the numbers to be reproducible.
    """
    ranged = (
        df.repartitionByRange(*order_by)
        .sortWithinPartitions(*order_by)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_row", F.monotonically_increasing_id())
    )
    stored = staging.write(ranged, f"{column}-ranged")
    parts = stored.groupBy("_part").agg(F.count("*").alias("size"), F.min("_row").alias("low")).collect()
    shifts = [0] * (1 + max((part["_part"] for part in parts), default=0))
    for part in sorted(parts, key=lambda part: part["_part"]):
        shifts[part["_part"]] = first - part["low"]
        first += part["size"]
    return stored.withColumn(column, F.col("_row") + _by_part(shifts)).drop("_part", "_row")


def _by_part(values: Sequence[int]) -> Column:
    """The value of each ``_part``; one constant array keeps the size of a table known to the planner."""
    return F.get(F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>"), F.col("_part"))


def place_within(df: DataFrame, group: Sequence[str], order_by: Sequence[str], staging: Staging, *, column: str = "place") -> DataFrame:
    """Add ``column`` = 0, 1, ... within each group, in the order of ``order_by``.

    A scan in segments: rows are dealt by ranges of group and order, numbered where they lie, and written. A group may fill many
    ranges; what goes before a range's first group is carried over from the ranges before it, of which the driver sees
    one row each. The rows move once.
    """
    names = list(group)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, place, head = TaskContext.get().partitionId(), None, 0, True
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            keys = [batch.column(batch.schema.get_field_index(name)) for name in names]
            new = np.zeros(n, bool)
            for key in keys:
                # Two nulls are one group, a null and a value are two.
                differs = pc.fill_null(pc.not_equal(key.slice(1), key.slice(0, n - 1)), False).to_numpy(zero_copy_only=False)
                null = pc.is_null(key).to_numpy(zero_copy_only=False)
                new[1:] |= differs | (null[1:] != null[:-1])
            new[0] = last is not None and [key[0].as_py() for key in keys] != last
            begins = np.flatnonzero(new)
            at = np.arange(n)
            since = np.maximum.accumulate(np.where(new, at, -1))
            places = np.where(since < 0, place + at, at - since)
            heads = np.full(n, head)
            heads[begins[0] if len(begins) else n :] = False
            head = head and not len(begins)
            last, place = [key[n - 1].as_py() for key in keys], int(places[-1]) + 1
            added = [pa.array(places, pa.int64()), pa.array(np.full(n, part, np.int32)), pa.array(heads)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], [*batch.schema.names, column, "_part", "_head"])

    order = [*group, *order_by]
    added = [T.StructField(column, T.LongType()), T.StructField("_part", T.IntegerType()), T.StructField("_head", T.BooleanType())]
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    stored = staging.write(ranged.mapInArrow(number, T.StructType([*df.schema.fields, *added])), f"{column}-ranged")
    key = F.struct(*group)
    parts = stored.groupBy("_part").agg(
        F.min(key).alias("first"), F.max(F.struct(key.alias("key"), F.col(column).alias("place"))).alias("last"), F.bool_and("_head").alias("one")
    )
    parts = sorted(parts.collect(), key=lambda part: part["_part"])
    carried, before, running = [0] * (1 + max((part["_part"] for part in parts), default=0)), None, 0
    for part in parts:
        goes_on = before is not None and part["first"] == before
        carried[part["_part"]] = running if goes_on else 0
        running = part["last"]["place"] + 1 + (carried[part["_part"]] if part["one"] else 0)
        before = part["last"]["key"]
    shift = F.when(F.col("_head"), _by_part(carried)).otherwise(F.lit(0))
    return stored.withColumn(column, F.col(column) + shift).drop("_part", "_head")


def assign_ids(df: DataFrame, order_by: Sequence[str], staging: Staging, *, after: int = 0) -> DataFrame:
    """Give rows the ids ``after + 1``, ``after + 2``, ... in the order of ``order_by``."""
    return dense_position(df, order_by, staging, column="id", first=after + 1)


def highest_id(papers: DataFrame) -> int:
    """The largest id in use, 0 for an empty table."""
    return papers.agg(F.max("id").alias("id")).first()["id"] or 0
