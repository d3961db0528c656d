"""The jobs as commands: ``spark-submit citeweave/jobs.py <job> ...`` or ``python -m citeweave.jobs <job> ...``.

A corpus is a folder with the tables ``papers``, ``edges``, ``done``, ``discoveries``, ``rejects`` and ``page_rejects``. Jobs
that write take a batch number: running a job again under the same number replaces what it wrote. All tables of a batch
count from the job's end on, or none.
``follow`` takes the first number of its micro-batches and needs all later ones for itself.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from citeweave.operators.report import collated, collated_json, newly_fetched, processed_per_term
from citeweave.operators.upsert import new_edges, unseen, upgrade_edges, upgrade_papers
from citeweave.plans.collect import collect_pages
from citeweave.plans.curate import PER_TERM, copy_seed, curate, curated_edges
from citeweave.plans.expand import expand_hops
from citeweave.plans.validate import check_orphans, validate
from citeweave.schemas import LEGACY_EDGES, LEGACY_PAPERS
from citeweave.session import build_session
from citeweave.sources.corpus import BUCKETS, SEED_BATCH, Corpus
from citeweave.sources.landed import scan_responses, scan_result_pages
from citeweave.sources.links import SLICES, read_links, write_links
from citeweave.sources.terms import first_positions, read_terms, slice_exclusive, slice_inclusive
from citeweave.staging import Staging
from citeweave.streaming.ingest import ingest_batch, ingest_responses, settle


def listed_terms(spark: SparkSession, args: argparse.Namespace, staging: Staging) -> DataFrame:
    terms = read_terms(spark, args.terms, staging)
    cut = slice_inclusive if args.inclusive else slice_exclusive
    return staging.write(first_positions(cut(terms, args.start, args.end)), "terms")


def opened(spark: SparkSession, args: argparse.Namespace, root: str) -> Corpus:
    """The corpus below ``root``, made if there is none."""
    corpus = Corpus.below(root)
    corpus.create(spark, args.buckets)
    return corpus


def run_collect(spark, args, staging):
    """Stored result pages to seed papers."""
    corpus = opened(spark, args, args.corpus)
    known = corpus.read(spark, "papers", before=args.batch)
    resume = None
    if args.resume:
        term, page, item = args.resume
        resume = (term, int(page), int(item))
    pages = scan_result_pages(spark, args.pages)
    fresh, rejects = collect_pages(pages, listed_terms(spark, args, staging), known, args.base_url, staging, resume=resume)
    with corpus.batch(spark, args.batch) as out:
        out.append("papers", fresh)
        out.append("page_rejects", rejects)


def run_expand(spark, args, staging):
    """Landed look-ups of one hop to papers and edges of the next."""
    corpus = opened(spark, args, args.corpus)
    responses = scan_responses(spark, args.responses, args.format)
    terms = listed_terms(spark, args, staging)
    ingest_batch(corpus, terms, args.hop, responses, args.batch, skip_done=True, retry_failed=args.retry_failed)


def run_follow(spark, args, staging):
    """As ``expand``, micro-batch by micro-batch over what has landed since the last start."""
    corpus = opened(spark, args, args.corpus)
    terms = listed_terms(spark, args, staging)
    ingest_responses(
        spark,
        args.responses,
        corpus,
        terms,
        args.hop,
        args.checkpoint,
        first_batch=args.batch,
        files_per_batch=args.files_per_batch,
        by_order=args.by_order,
    ).awaitTermination()


def run_settle(spark, args, staging):
    """The papers found by ``follow --by-order``, with ids in the order of their first discoveries."""
    settle(Corpus.below(args.corpus), spark, args.hop, args.batch)


def run_curate(spark, args, staging):
    """The first papers of every term to the curated corpus."""
    curated = opened(spark, args, args.curated)
    papers = Corpus.below(args.corpus).read(spark, "papers")
    known = curated.read(spark, "papers", before=args.batch)
    fresh = curate(papers, listed_terms(spark, args, staging), known, staging, args.per_term)
    with curated.batch(spark, args.batch) as out:
        out.append("papers", fresh)


def run_copy(spark, args, staging):
    """Seed papers and the edges that leave them to another corpus."""
    source, target = Corpus.below(args.corpus), opened(spark, args, args.target)
    papers, edges = copy_seed(
        source.read_papers(spark),
        source.read(spark, "edges"),
        target.read(spark, "papers", before=args.batch),
        target.read(spark, "edges", before=args.batch),
        staging,
        both_ends=args.both_ends,
    )
    with target.batch(spark, args.batch) as out:
        out.append("papers", papers)
        out.append("edges", edges)


def run_progress(spark, args, staging):
    """Processed papers per term, as CSV in the order of the terms."""
    counts = processed_per_term(Corpus.below(args.corpus).read_papers(spark)).orderBy("search_term")
    counts.write.mode("overwrite").option("header", True).csv(args.target)


def run_fetched(spark, args, staging):
    """Ids of the papers that still have to be looked up."""
    newly_fetched(Corpus.below(args.corpus).read_papers(spark)).write.mode("overwrite").parquet(args.target)


def run_dump(spark, args, staging):
    """Every paper with its citations and references, one JSON line for each neighbour."""
    corpus = Corpus.below(args.corpus)
    rows = collated(corpus.read(spark, "papers"), corpus.read(spark, "edges"), staging)
    collated_json(rows).select("body").write.mode("overwrite").text(args.target)


def run_grow(spark, args, staging):
    """Hops over the edge table of another corpus, up to the given number, into this one."""
    corpus, source = opened(spark, args, args.corpus), Corpus.below(args.source)
    known = corpus.read_papers(spark, before=args.batch)
    attributes = source.read(spark, "papers")
    terms = listed_terms(spark, args, staging)
    links = read_links(spark, args.links) if args.links else staging.write(source.read(spark, "edges"), "links")
    grown, met = expand_hops(known, links, terms, args.hops, staging, attributes=attributes)
    flags = grown.filter("is_processed").select("ss_id")
    with corpus.batch(spark, args.batch) as out:
        out.append("papers", grown.join(known.select("ss_id"), "ss_id", "left_anti"))
        out.append("edges", new_edges(met, corpus.read(spark, "edges", before=args.batch)))
        out.append("done", unseen(flags, corpus.read(spark, "done", before=args.batch), ["ss_id"]))


def run_links(spark, args, staging):
    """The edges from either end, in slices by paper, for ``grow --links``."""
    write_links(Corpus.below(args.corpus).read(spark, "edges"), args.target, args.slices)


def run_compact(spark, args, staging):
    """All batches of a corpus as the first batch of another, with the flags merged into the papers."""
    source, target = Corpus.below(args.corpus), opened(spark, args, args.target)
    with target.batch(spark, SEED_BATCH) as out:
        out.append("papers", source.read_papers(spark))
        out.append("edges", source.read(spark, "edges"))
        out.append("done", source.read(spark, "done").distinct())


def run_merge(spark, args, staging):
    """The flags of looked-up papers into the batches that hold these papers; other batches keep their files."""
    Corpus.below(args.corpus).merge_flags(spark)


def run_curated_edges(spark, args, staging):
    """The edges whose both ends are curated papers."""
    curated = Corpus.below(args.curated).read(spark, "papers")
    edges = curated_edges(Corpus.below(args.corpus).read(spark, "edges"), curated)
    edges.write.mode("overwrite").parquet(args.target)


def run_upgrade(spark, args, staging):
    """Papers and edges of the former layout to tables of the present one."""
    upgrade_papers(spark.read.schema(LEGACY_PAPERS).parquet(f"{args.corpus}/papers")).write.mode("overwrite").parquet(f"{args.target}/papers")
    upgrade_edges(spark.read.schema(LEGACY_EDGES).parquet(f"{args.corpus}/edges")).write.mode("overwrite").parquet(f"{args.target}/edges")


def run_validate(spark, args, staging):
    """Violations of every constraint, as CSV."""
    corpus = Corpus.below(args.corpus)
    report = validate(corpus.read(spark, "papers"), corpus.read(spark, "edges"), staging)
    report.write.mode("overwrite").option("header", True).csv(args.target)


def run_orphans(spark, args, staging):
    """The edges without a paper at an end, brought up to date by what the batches since the last check have added."""
    check_orphans(Corpus.below(args.corpus), spark, args.batch)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="citeweave", description=__doc__)
    jobs = top.add_subparsers(dest="job", required=True)

    def job(name, run, *, terms=False, batch=False):
        sub = jobs.add_parser(name, help=run.__doc__)
        sub.set_defaults(run=run)
        sub.add_argument("--corpus", required=True)
        sub.add_argument("--shuffle-partitions", help="about one per 128 MB of the largest shuffle")
        sub.add_argument("--buckets", type=int, default=BUCKETS, help="buckets of a corpus that is made anew, about one per 1 GB of its largest table")
        if terms:
            sub.add_argument("--terms", required=True, help="headerless CSV of search terms")
            sub.add_argument("--start", type=int, default=0)
            sub.add_argument("--end", type=int, required=True)
            sub.add_argument("--inclusive", action="store_true", help="take the end position too")
        if batch:
            sub.add_argument("--batch", type=int, required=True)
        return sub

    collect = job("collect", run_collect, terms=True, batch=True)
    collect.add_argument("--pages", required=True)
    collect.add_argument("--base-url", required=True, help="start of a paper's address")
    collect.add_argument("--resume", nargs=3, metavar=("TERM", "PAGE", "ITEM"))

    expand = job("expand", run_expand, terms=True, batch=True)
    expand.add_argument("--responses", required=True)
    expand.add_argument("--format", default="parquet", choices=("parquet", "json"))
    expand.add_argument("--hop", type=int, default=0)
    expand.add_argument("--retry-failed", action="store_true")

    follow = job("follow", run_follow, terms=True, batch=True)
    follow.add_argument("--responses", required=True)
    follow.add_argument("--hop", type=int, default=0)
    follow.add_argument("--checkpoint", required=True)
    follow.add_argument("--files-per-batch", type=int)
    follow.add_argument("--by-order", action="store_true", help="keep first discoveries for a later settle, whatever lands first")

    settled = job("settle", run_settle, batch=True)
    settled.add_argument("--hop", type=int, default=0)

    pick = job("curate", run_curate, terms=True, batch=True)
    pick.add_argument("--curated", required=True)
    pick.add_argument("--per-term", type=int, default=PER_TERM)

    copy = job("copy", run_copy, batch=True)
    copy.add_argument("--target", required=True)
    copy.add_argument("--both-ends", action="store_true")

    grow = job("grow", run_grow, terms=True, batch=True)
    grow.add_argument("--source", required=True, help="corpus whose papers and edges are known")
    grow.add_argument("--hops", type=int, default=1)
    grow.add_argument("--links", help="what the job links wrote of that corpus; a hop then reads the slices of its frontier")

    job("merge", run_merge)
    job("orphans", run_orphans, batch=True)

    linked = job("links", run_links)
    linked.add_argument("--slices", type=int, default=SLICES)

    between = job("curated-edges", run_curated_edges)
    between.add_argument("--curated", required=True)
    written = [("compact", run_compact), ("progress", run_progress), ("fetched", run_fetched), ("dump", run_dump), ("validate", run_validate), ("upgrade", run_upgrade)]
    for sub in (between, linked, *[job(name, run) for name, run in written]):
        sub.add_argument("--target", required=True)
    return top


def main(arguments: list[str] | None = None) -> None:
    args = parser().parse_args(arguments)
    settings = {"spark.sql.shuffle.partitions": args.shuffle_partitions} if args.shuffle_partitions else {}
    spark = build_session(f"citeweave {args.job}", **settings)
    with Staging(spark, args.job) as staging:
        args.run(spark, args, staging)


if __name__ == "__main__":
    main()
