"""Insert-or-ignore and the other ways rows get into the corpus."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeweave.operators.checks import flag_orphans, repeated_keys
from citeweave.operators.identity import assign_ids, highest_id
from citeweave.operators.subset import matching
from citeweave.schemas import LEGACY_EDGES, LEGACY_PAPERS, NO_ABSTRACT, PAPERS
from citeweave.staging import Staging


def first_discovery(candidates: DataFrame, key: str, order_by: Sequence[str]) -> DataFrame:
    """Per key the candidate that comes first in ``order_by``.

    An aggregate and no window: each task keeps one row per key before the shuffle, so a key
    found by a third of all candidates costs no more than any other.
    """
    rest = [name for name in candidates.columns if name != key and name not in order_by]
    if len(order_by) == 1 and not rest:
        # A plain minimum of a number is hashed instead of sorted.
        return candidates.groupBy(key).agg(F.min(order_by[0]).alias(order_by[0]))
    first = F.min(F.struct(*order_by, *rest)).alias("first")
    return candidates.groupBy(key).agg(first).select(key, "first.*")


def unseen(candidates: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Candidates whose key is not known yet."""
    return candidates.join(known.select(*keys), list(keys), "left_anti")


def insertable(candidates: DataFrame) -> DataFrame:
    """Drop candidates without id or title, and fill in a missing abstract."""
    return candidates.na.drop(subset=["ss_id", "title"]).withColumn(
        "abstract", F.coalesce("abstract", F.lit(NO_ABSTRACT))
    )


def discover(candidates: DataFrame, known: DataFrame, order_by: Sequence[str], staging: Staging, *, after: int | None = None, look_up=matching) -> DataFrame:
    """First discoveries of papers that are not known yet, with ids in discovery order.

    The known papers are first reduced to the keys of the batch by ``look_up``, so a batch much smaller than
    the corpus leaves the corpus in place. ``after`` is the highest id in use, looked for where it isn't given.
    """
    first = staging.write(first_discovery(candidates, "ss_id", order_by), "first-discovery")
    fresh = unseen(first, look_up(known.select("ss_id"), first, ["ss_id"]), ["ss_id"])
    return assign_ids(fresh, [*order_by, "ss_id"], staging, after=highest_id(known) if after is None else after)


def improved(candidates: DataFrame, versions: DataFrame, key: str, order_by: Sequence[str], look_up=matching) -> DataFrame:
    """The candidates that come before every version of their key so far.

    ``candidates`` is a written table with one row per key. The versions of a key are brought by batches in any order;
    the first of all of them is what one batch over everything would have found.
    """
    held = first_discovery(look_up(versions, candidates, [key]).select(key, *order_by), key, order_by)
    held = held.select(F.col(key).alias("_key"), F.struct(*order_by).alias("_held"))
    met = candidates.join(held, F.col(key) == F.col("_key"), "left")
    return met.where(F.col("_key").isNull() | (F.struct(*order_by) < F.col("_held"))).drop("_key", "_held")


def numbered_rows(rows: DataFrame) -> DataFrame:
    """Rows with a ``row_id`` that tells them apart once they are written."""
    return rows.withColumn("row_id", F.monotonically_increasing_id())


def pick_new_papers(staged: DataFrame, known: DataFrame, order_by: Sequence[str], staging: Staging) -> DataFrame:
    """The rows an insert-or-ignore adds, out of written candidates with a ``row_id``.

    Keys alone are grouped, compared with the known papers and numbered; titles and abstracts
    move once, when the chosen rows are fetched.
    """
    keys = staged.select("ss_id", *order_by, "row_id")
    chosen = discover(keys, known, order_by, staging).select("row_id", "id")
    return as_papers(staged.join(chosen, "row_id"))


def new_papers(candidates: DataFrame, known: DataFrame, order_by: Sequence[str], staging: Staging) -> DataFrame:
    """The rows an insert-or-ignore adds to the known papers; those keep every value they have."""
    # Filtered after writing: a filter before would work out its columns a second time.
    staged = staging.write(numbered_rows(candidates), "candidates")
    return pick_new_papers(insertable(staged), known, order_by, staging)


def as_papers(rows: DataFrame) -> DataFrame:
    """Rows in the columns of the papers table, not yet processed."""
    return rows.withColumn("is_processed", F.lit(False)).select(
        *[F.col(field.name).cast(field.dataType) for field in PAPERS.fields]
    )


def new_edges(candidates: DataFrame, known: DataFrame) -> DataFrame:
    """The edges an insert-or-ignore adds to the known ones."""
    pair = ["ss_id", "reference_id"]
    return unseen(candidates.select(*pair).distinct(), known, pair)


def split_by_ends(edges: DataFrame, papers: DataFrame, staging: Staging) -> tuple[DataFrame, DataFrame]:
    """``(sound, orphaned)``: edges whose both ends are papers, and the others, null ends among them."""
    flagged = flag_orphans(edges, papers, staging)
    return flagged.filter(~F.col("orphan")).drop("orphan"), flagged.filter("orphan").drop("orphan")


def mark_processed(papers: DataFrame, done: DataFrame) -> DataFrame:
    """Set the flag of the papers whose key is in ``done``."""
    marks = done.select("ss_id").distinct().withColumn("_done", F.lit(True))
    flag = F.when(F.col("_done"), F.lit(True)).otherwise(F.col("is_processed"))
    return papers.join(marks, "ss_id", "left").withColumn("is_processed", flag).select(*papers.columns)


def append_checked(rows: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows for a plain append; raises if one of their keys comes twice or is taken in the target."""
    if not repeated_keys(rows, keys).isEmpty():
        raise ValueError(f"rows repeat their {', '.join(keys)}")
    taken = rows.join(target.select(*keys), list(keys), "left_semi")
    if not taken.isEmpty():
        raise ValueError(f"rows with {', '.join(keys)} already in the target")
    return rows


def upgrade_papers(legacy: DataFrame) -> DataFrame:
    """Papers of the former layout in the present one, with the flag for cleaned texts."""
    dropped = set(LEGACY_PAPERS.fieldNames()) - {"paper_id", *PAPERS.fieldNames()}
    return as_papers(legacy.drop(*dropped).withColumnRenamed("paper_id", "ss_id")).withColumn(
        "is_cleaned", F.lit(False)
    )


def upgrade_edges(legacy: DataFrame) -> DataFrame:
    return legacy.select(*LEGACY_EDGES.fieldNames()).withColumnRenamed("paper_id", "ss_id")
