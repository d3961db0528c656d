"""JSON payloads of landed look-ups.

VARIANT keeps apart what a typed reader would merge: a key that is absent, a key that is
null, and a value of an unexpected kind.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeweave.functions.text import or_default
from citeweave.schemas import CITATION, NO_ABSTRACT, UNKNOWN_ID, UNTITLED

# Key of the neighbour inside an item, by direction, and key of the item list.
CITING_KEY = "$.citingPaper"
CITED_KEY = "$.citedPaper"
ITEMS_KEY = "$.data"


def _is_object(value: Column) -> Column:
    return F.startswith(F.schema_of_variant(value), F.lit("OBJECT"))


def payload_items(payload: Column) -> Column:
    """The items of a payload: the list under ``data``, or the payload itself if it is a list."""
    return F.coalesce(
        F.try_variant_get(payload, ITEMS_KEY, "array<variant>"),
        F.try_variant_get(payload, "$", "array<variant>"),
    )


def payload_problem(status: Column, body: Column, payload: Column) -> Column:
    """Why a payload yields no item although it should have been readable; null if all is well."""
    data = F.try_variant_get(payload, ITEMS_KEY, "variant")
    # Most lists have a first item; only for others it is worth making the list to see whether there is one.
    first = F.coalesce(F.try_variant_get(payload, f"{ITEMS_KEY}[0]", "variant"), F.try_variant_get(payload, "$[0]", "variant"))
    return (
        F.when(~F.coalesce(status == 200, F.lit(False)), F.lit(None).cast("string"))
        .when(body.isNull() | payload.isNull(), F.lit("malformed payload"))
        .when(first.isNotNull() | payload_items(payload).isNotNull(), F.lit(None).cast("string"))
        .when(F.is_variant_null(data), F.lit("null item list"))
        .when(data.isNull() & _is_object(payload), F.lit(None).cast("string"))
        .otherwise(F.lit("item list is no list"))
    )


def text_or_missing(found: Column, missing: Column) -> Column:
    """Text of a looked-up value: ``missing`` if its key is absent, null if the value is null."""
    return F.when(found.isNull(), missing).otherwise(F.try_variant_get(found, "$", "string"))


def parse_responses(responses: DataFrame) -> DataFrame:
    """Add ``payload`` and ``problem``; a failed look-up has no payload and is no problem."""
    parsed = responses.withColumn("payload", F.when(F.col("status") == 200, F.try_parse_json("body")))
    return parsed.withColumn("problem", payload_problem(F.col("status"), F.col("body"), F.col("payload")))


def flatten_neighbours(parsed: DataFrame, *carry: str, reject_missing: bool = False) -> DataFrame:
    """One row per item of every payload with the defaults applied, and one per unreadable payload.

    ``problem`` is null for a neighbour that counts: its id and title are there and not empty.
    A payload without a readable list has a null ``pos``. ``reject_missing`` turns down absent
    ids and titles instead of filling them in. ``carry`` names columns of the look-up to keep.
    """
    items = parsed.select(
        *carry,
        "direction",
        F.coalesce("page", F.lit(0)).alias("page"),
        F.col("problem").alias("unreadable"),
        F.posexplode_outer(payload_items(F.col("payload"))).alias("pos", "item"),
    ).filter(F.col("pos").isNotNull() | F.col("unreadable").isNotNull())
    paper = F.when(F.col("direction") == CITATION, F.try_variant_get("item", CITING_KEY, "variant")).otherwise(
        F.try_variant_get("item", CITED_KEY, "variant")
    )
    place = [*carry, "direction", "page", "pos"]
    keys = {"ss_id": "$.paperId", "title": "$.title", "abstract": "$.abstract"}
    found = (
        items.select(*place, "unreadable", "item", paper.alias("paper"))
        .withColumns({f"_{name}": F.try_variant_get("paper", key, "variant") for name, key in keys.items()})
        .withColumn("url", F.try_variant_get("paper", "$.url", "string"))
    )
    # An absent neighbour counts as an empty one, provided the item is an object at all. A
    # paper in which a key was found is an object, so the kind is asked for only in doubt.
    in_doubt = F.col("paper").isNotNull() & F.col("_ss_id").isNull() & F.col("_title").isNull()
    shape = (
        F.when(F.col("pos").isNull(), F.col("unreadable"))
        .when(F.col("paper").isNull() & ~_is_object(F.col("item")), F.lit("item is no object"))
        .when(F.is_variant_null("paper"), F.lit("null paper"))
        .when(in_doubt & ~_is_object(F.col("paper")), F.lit("paper is no object"))
    )
    absent = F.lit(None).cast("string")
    values = {
        "ss_id": text_or_missing(F.col("_ss_id"), absent if reject_missing else F.lit(UNKNOWN_ID)),
        "title": text_or_missing(F.col("_title"), absent if reject_missing else F.lit(UNTITLED)),
        "abstract": or_default(text_or_missing(F.col("_abstract"), F.lit(NO_ABSTRACT)), "abstract"),
        "url": F.col("url"),
    }
    fields = found.withColumn("shape", shape).select(
        *place, "shape", *[F.when(F.col("shape").isNull(), value).alias(name) for name, value in values.items()]
    )
    problem = (
        F.when(F.col("shape").isNotNull(), F.col("shape"))
        .when(~F.coalesce(F.col("ss_id") != "", F.lit(False)), F.lit("no id"))
        .when(~F.coalesce(F.col("title") != "", F.lit(False)), F.lit("no title"))
    )
    return fields.withColumn("problem", problem).drop("shape")


def valid_neighbours(neighbours: DataFrame) -> DataFrame:
    return neighbours.filter(F.col("problem").isNull()).drop("problem")


def rejected_neighbours(neighbours: DataFrame) -> DataFrame:
    return neighbours.filter(F.col("problem").isNotNull())
