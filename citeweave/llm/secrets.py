"""Secret scans over a ledger of content-addressed texts.

Every version of every path is known by the SHA-256 of its text. The ledger holds one row per
(blob, kind, rule version) that has been scanned, with the spans found, also if none were. A scan
takes the distinct blobs, looks up which pairs the ledger lacks, scans only those, appends them as
a batch, and joins the findings back to all paths. A blob that a third of all paths share is
scanned once and moved at most once per task; the look-up by paths is a join that Spark can split.

Null texts count as empty. A path may repeat, with the same or another text, and may be null: each
row is a version of its own. Texts are scanned whole, by regular expressions inside Spark. An empty
table gives an empty table. Other columns of the input pass through untouched, those named ``spans`` or ``blob`` excepted.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citeweave.llm.common import in_chunks, let, unused
from citeweave.staging import Staging


@dataclass(frozen=True)
class Rule:
    """``pattern`` finds candidates, leftmost first; those whose ``group`` is shorter than ``least`` are dropped."""

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 1


# The patterns and lengths that the results must follow. For the last two the least
# length stands in the pattern: a shorter run can't hold a longer one, so the matches are the same.
RULES = (
    Rule(
        "assign",
        1,
        r"""(?i:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?)([A-Za-z0-9+/_.=-]+)""",
        group=2,
        least=8,
    ),
    Rule("access", 1, r"AKIA[A-Z0-9]{12,}"),
    Rule("hex", 1, r"[0-9a-f]{32,}"),
)

LEDGER = "blob binary, kind string, version int, spans array<struct<start:int,end:int>>"


def blob_of(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def spans_of(text: Column, rule: Rule) -> Column:
    """Start and end (exclusive) of each match in code points.

    Between two matches stands what ``split`` leaves, so positions are sums of lengths.
    """
    pattern = F.lit(rule.pattern)
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    pieces = F.zip_with(
        F.zip_with(F.split(text, rule.pattern, -1), matches, lambda gap, match: F.struct(gap.alias("gap"), match.alias("match"))),
        F.regexp_extract_all(text, pattern, F.lit(rule.group)),
        lambda pair, value: F.struct(
            F.char_length(pair["gap"]).alias("gap"),
            F.char_length(pair["match"]).alias("width"),
            (F.char_length(value) >= rule.least).alias("fits"),
        ),
    )
    empty = F.array().cast("array<struct<start:int,end:int>>")

    def step(state: Column, piece: Column) -> Column:
        begin = state["at"] + piece["gap"]
        end = begin + F.coalesce(piece["width"], F.lit(0))
        span = F.array(F.struct(begin.alias("start"), end.alias("end")))
        return F.struct(
            end.alias("at"), F.when(F.coalesce(piece["fits"], F.lit(False)), F.concat(state["spans"], span)).otherwise(state["spans"]).alias("spans")
        )

    def length(chunk: Column) -> Column:
        return F.aggregate(chunk, F.lit(0), lambda total, piece: total + piece["gap"] + F.coalesce(piece["width"], F.lit(0)))

    def spans(chunk: Column, at: Column) -> Column:
        return F.aggregate(chunk, F.struct(at.alias("at"), empty.alias("spans")), step, lambda state: state["spans"])

    # An array that grows is copied with each element, so spans grow chunk by chunk.
    found = let(pieces, lambda all_: let(in_chunks(all_), lambda chunks: let(_before(chunks, lambda at, chunk: at + length(chunk)), lambda begins: F.flatten(F.zip_with(chunks, begins, spans)))))
    return F.when(text.rlike(rule.pattern), found).otherwise(empty)


def _before(chunks: Column, add: Callable[[Column, Column], Column]) -> Column:
    """For each chunk the number, 0 at first, to which ``add`` has come by the chunks before it."""
    none = F.array().cast("array<int>")
    start = F.struct(F.lit(0).alias("at"), none.alias("begins"))
    step = lambda state, chunk: F.struct(add(state["at"], chunk).alias("at"), F.concat(state["begins"], F.array(state["at"])).alias("begins"))
    return F.aggregate(chunks, start, step, lambda state: state["begins"])


def read_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """All scanned pairs; a pair that two runs have scanned counts once."""
    files = spark._jvm.org.apache.hadoop.fs.Path(folder)
    there = files.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(files)
    if not there:
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(folder).dropDuplicates(["blob", "kind", "version"])


def scan_unseen(versions: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Ledger rows for the pairs of distinct blobs and rule versions that ``ledger`` lacks."""
    known = F.array(*[F.concat_ws(":", F.lit(rule.kind), F.lit(str(rule.version))) for rule in rules])
    seen = ledger.groupBy("blob").agg(F.collect_set(F.concat_ws(":", "kind", F.col("version").cast("string"))).alias("seen"))
    texts = versions.select(blob_of(F.col("text")).alias("blob"), F.coalesce("text", F.lit("")).alias("text"))
    blobs = (
        texts.groupBy("blob")
        .agg(F.first("text").alias("text"))
        .join(seen, "blob", "left")
        .withColumn("todo", F.array_except(known, F.coalesce("seen", F.array().cast("array<string>"))))
        .where(F.size("todo") > 0)
    )
    scans = [
        F.when(
            F.array_contains("todo", f"{rule.kind}:{rule.version}"),
            F.struct(
                F.lit(rule.kind).alias("kind"), F.lit(rule.version).alias("version"), spans_of(F.col("text"), rule).alias("spans")
            ),
        )
        for rule in rules
    ]
    return blobs.select("blob", F.explode(F.array_compact(F.array(*scans))).alias("scan")).select("blob", "scan.*")


def scan_versions(versions: DataFrame, ledger_folder: str, staging: Staging, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``versions`` with a column ``spans``: array of (start, rank, kind, end), ordered by start and kind.

    ``rank`` is the place of the kind in ``rules``, from 1. ``versions`` needs a column ``text``.
    """
    spark = versions.sparkSession
    scan_unseen(versions, read_ledger(spark, ledger_folder), rules).write.mode("append").parquet(ledger_folder)
    ledger = read_ledger(spark, ledger_folder)
    wanted = F.array(*[F.struct(F.lit(rule.kind).alias("kind"), F.lit(rule.version).alias("version")) for rule in rules])
    rank = F.array_position(wanted, F.struct("kind", "version"))
    one_kind = F.transform(
        "spans", lambda s: F.struct(s["start"].alias("start"), F.col("rank").alias("rank"), F.col("kind").alias("kind"), s["end"].alias("end"))
    )
    findings = (
        ledger.withColumn("rank", rank)
        .where((F.col("rank") > 0) & (F.size("spans") > 0))
        .select("blob", F.col("spans").alias("found"), "kind", "rank")
        .withColumnRenamed("found", "spans")
        .groupBy("blob")
        .agg(F.array_sort(F.flatten(F.collect_list(one_kind))).alias("spans"))
    )
    known = unused([*versions.columns, "blob", "spans"], "_blob")
    findings = staging.write(findings, "findings").withColumnRenamed("blob", known)
    rows = versions.drop("spans", "blob").withColumn("blob", blob_of(F.col("text")))
    nothing = F.array().cast(findings.schema["spans"].dataType)
    # The same join at every size: a text that is carried along always moves once.
    return rows.join(findings.hint("merge"), F.col("blob") == F.col(known), "left").withColumn("spans", F.coalesce("spans", nothing)).drop(known)


def redact(text: Column, spans: Column, mask: str = "[REDACTED]") -> Column:
    """``text`` with each run of overlapping spans replaced by one mask; null stays null."""
    last = lambda chunk: F.aggregate(chunk, F.lit(0), lambda at, span: F.greatest(at, span["end"]))

    def masked(chunk: Column, begin: Column) -> Column:
        """The text from ``begin`` to the chunk's last end."""

        def step(part: Column) -> Callable[[Column, Column], Column]:
            def one(state: Column, span: Column) -> Column:
                gap = F.substring(part, state["at"] - begin + 1, F.greatest(span["start"] - state["at"], F.lit(0)))
                new = (span["start"] >= state["at"]) & (span["end"] > state["at"])
                return F.struct(
                    F.greatest(state["at"], span["end"]).alias("at"),
                    F.when(new, F.concat(state["out"], F.array(F.concat(gap, F.lit(mask))))).otherwise(state["out"]).alias("out"),
                )

            return one

        nothing = F.struct(begin.alias("at"), F.array().cast("array<string>").alias("out"))
        part = F.substring(text, begin + 1, F.greatest(last(chunk) - begin, F.lit(0)))
        return let(part, lambda part: F.array_join(F.aggregate(chunk, nothing, step(part), lambda state: state["out"]), ""))

    def whole(all_: Column) -> Column:
        return let(
            in_chunks(all_),
            lambda chunks: let(
                _before(chunks, lambda at, chunk: F.greatest(at, last(chunk))), lambda begins: F.array_join(F.zip_with(chunks, begins, masked), "")
            ),
        )

    rest = F.substring(text, last(spans) + 1, F.char_length(text))
    return F.when(text.isNull() | (F.size(spans) == 0), text).otherwise(F.concat(let(spans, whole), rest))
