"""Look-ups ingested as they land.

Each micro-batch does what one batch hop does: insert-or-ignore papers, insert-or-ignore
edges, note the rejects and the parents now done. All of it counts with the batch's state file or not at all, and
a batch reads only earlier batches, so stopping anywhere and starting again ends in the same tables.

"First" means landing order between micro-batches. Where files may land in any order, ``by_order`` keeps for
each paper the discoveries that come before all earlier ones instead of inserting it, and ``settle`` inserts the papers
with the first discoveries of all batches, as one batch over everything that landed would have done.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from citeweave.operators.identity import assign_ids
from citeweave.operators.upsert import as_papers, first_discovery, improved, unseen
from citeweave.plans.expand import ResponseHop
from citeweave.schemas import EDGES, PAYLOAD_ORDER, RESPONSES
from citeweave.sources.corpus import BUCKETS, Corpus, Shape, touched
from citeweave.sources.tables import path_exists
from citeweave.staging import Staging

PAIR = EDGES.fieldNames()


def ingest_batch(
    corpus: Corpus,
    terms: DataFrame,
    hop: int,
    landed: DataFrame,
    batch: int,
    *,
    skip_done: bool = False,
    retry_failed: bool = False,
    by_order: bool = False,
) -> None:
    """Take one batch of landed look-ups into the corpus.

    ``skip_done`` leaves out parents that earlier batches noted as done. A stream must not do
    so, since further pages of such a parent may land later; taking a page twice is harmless.
    """
    spark = landed.sparkSession
    with Staging(spark, f"ingest-{batch}") as staging, corpus.batch(spark, batch) as out:
        read = lambda table: corpus.read(spark, table, before=batch)
        done = read("done")
        step = ResponseHop(
            read("papers"),
            landed,
            terms,
            hop,
            staging,
            done=done if skip_done else None,
            retry_failed=retry_failed,
            after=corpus.highest_id(spark, before=batch),
            look_up=touched,
        )
        if by_order:
            out.append("discoveries", step.discoveries(read("discoveries")))
        else:
            out.append("papers", step.papers)
        # Both ends of every edge are papers by now or when settled: the parent was known, the neighbour is found.
        found = staging.write(step.edges, "found-edges")
        out.append("edges", unseen(found, touched(read("edges"), found, PAIR), PAIR))
        out.append("rejects", step.rejects)
        processed = staging.write(step.processed, "processed")
        out.append("done", unseen(processed, touched(done, processed, ["ss_id"]), ["ss_id"]))


def settle(corpus: Corpus, spark: SparkSession, hop: int, batch: int) -> None:
    """Insert the papers that ``by_order`` batches found at ``hop``, with ids in the order of their first discoveries.

    Papers that have an id keep it, with the values they have.
    """
    with Staging(spark, f"settle-{batch}") as staging, corpus.batch(spark, batch) as out:
        versions = corpus.read(spark, "discoveries", before=batch).where(F.col("num_hops") == hop + 1)
        places = first_discovery(versions.select("ss_id", *PAYLOAD_ORDER), "ss_id", PAYLOAD_ORDER)
        fresh = unseen(places, corpus.read(spark, "papers", before=batch), ["ss_id"])
        numbered = assign_ids(fresh, [*PAYLOAD_ORDER, "ss_id"], staging, after=corpus.highest_id(spark, before=batch))
        # A place comes twice only where a batch was repeated with the same values.
        chosen = versions.dropDuplicates(["ss_id", *PAYLOAD_ORDER]).join(numbered, ["ss_id", *PAYLOAD_ORDER])
        out.append("papers", as_papers(chosen))


def ingest_responses(
    spark: SparkSession,
    landing: str,
    corpus: Corpus,
    terms: DataFrame,
    hop: int,
    checkpoint: str,
    *,
    first_batch: int = 0,
    files_per_batch: int | None = None,
    by_order: bool = False,
) -> StreamingQuery:
    """Start ingesting everything landed so far; a later start goes on where this one ended.

    Micro-batches are written as the batches from ``first_batch`` on, which must be free when
    a checkpoint is first used.
    """
    if not path_exists(spark, checkpoint) and corpus.has_batch(spark, first_batch):
        raise ValueError(f"{corpus.root} already has batches from {first_batch} on")
    reader = spark.readStream.schema(RESPONSES).format("parquet")
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return (
        reader.load(landing)
        .writeStream.foreachBatch(
            lambda landed, batch: ingest_batch(corpus, terms, hop, landed, first_batch + batch, by_order=by_order)
        )
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _versions(target: str, schema: StructType, key: str) -> Corpus:
    return Corpus(target.rstrip("/"), {"versions": Shape(schema, (key,))})


def first_seen(
    spark: SparkSession,
    landing: str,
    schema: StructType,
    target: str,
    key: str,
    order_by: Sequence[str],
    checkpoint: str,
    *,
    by_order: bool = False,
    buckets: int = BUCKETS,
) -> StreamingQuery:
    """Keep the first row of every key over everything that lands.

    The table written so far is the state, so it may outgrow memory, and it is clustered by ``key``, so a micro-batch
    meets it bucket by bucket. Within a micro-batch the first row is that of the smallest ``order_by``. Between micro-batches
    the first one to land stays, or with ``by_order`` the smallest, whenever it lands: then a key gets a further version, and
    ``read_first`` takes the smallest of all versions.
    """
    state = _versions(target, schema, key)

    def keep_first(landed: DataFrame, batch: int) -> None:
        spark = landed.sparkSession
        with Staging(spark, f"first-seen-{batch}") as staging, state.batch(spark, batch) as out:
            first = staging.write(first_discovery(landed, key, order_by), "first")
            known = state.read(spark, "versions", before=batch)
            if by_order:
                out.append("versions", improved(first, known, key, order_by, touched))
            else:
                out.append("versions", unseen(first, touched(known.select(key), first, [key]), [key]))

    state.create(spark, buckets)
    return (
        spark.readStream.schema(schema)
        .parquet(landing)
        .writeStream.foreachBatch(keep_first)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_first(spark: SparkSession, target: str, schema: StructType, key: str, order_by: Sequence[str]) -> DataFrame:
    """The first row of every key so far."""
    versions = _versions(target, schema, key).read(spark, "versions")
    return first_discovery(versions, key, order_by).select(*schema.fieldNames())
