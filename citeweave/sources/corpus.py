"""A corpus that grows by whole batches, in tables clustered by their keys.

A batch writes each of its tables to a new folder and then one state file, which names the folders of every batch
that counts. Readers go by the newest state file, so they see all tables of a batch or none of them, whenever
its writer stops. A batch that is written again gets new folders, and its state file leaves out the former ones; a
batch reads only earlier batches. State files are numbered, and a number can be taken once: of two writers at
a time the second one fails.

Tables with keys are bucketed by them, as Spark's own tables are, in as many buckets as the corpus was created with:
joins of two such tables, and joins of a batch with one, leave the stored rows where they are. Where a batch has few
keys, they are named in a filter, and Spark opens their buckets alone. Tables are known to the session's
catalog by names made from the folder; whatever catalog that is, state files decide what is read.

The highest id of each batch stands in the state file, so numbering goes on without reading papers.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from citeweave.operators.upsert import mark_processed, matching
from citeweave.schemas import DISCOVERIES, DONE, EDGES, ORPHANS, PAGE_REJECTS, PAPERS, REJECTS

BUCKETS = 16
SEED_BATCH = -1  # batch number of rows that were there before the first micro-batch
#: So many keys of a batch are named in a filter; more of them would meet most buckets anyway.
NAMED_KEYS = 500


@dataclass(frozen=True)
class Shape:
    """Columns of a table, and the keys by which its rows are clustered."""

    schema: StructType
    keys: tuple[str, ...] = ()


TABLES = {
    "papers": Shape(PAPERS, ("ss_id",)),
    "edges": Shape(EDGES, tuple(EDGES.fieldNames())),
    "done": Shape(DONE, ("ss_id",)),
    "discoveries": Shape(DISCOVERIES, ("ss_id",)),
    "rejects": Shape(REJECTS),
    "page_rejects": Shape(PAGE_REJECTS),
    "orphans": Shape(ORPHANS),
}

# Folders that a session's catalog knows already, by application and table.
_registered: dict[tuple[str, str], set[str]] = {}


def _files(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _names(spark: SparkSession, folder: str) -> list[str]:
    target, files = _files(spark, folder)
    return [status.getPath().getName() for status in files.listStatus(target)] if files.exists(target) else []


def _read_text(spark: SparkSession, path: str) -> str:
    target, files = _files(spark, path)
    stream = files.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _put_once(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file under a name that must be free; readers see all of it or nothing."""
    folder, name = path.rsplit("/", 1)
    part, files = _files(spark, f"{folder}/.{name}.{uuid.uuid4().hex}")
    target, _ = _files(spark, path)
    stream = files.create(part, True)
    stream.write(bytearray(text, "utf-8"))
    stream.close()
    if files.exists(target) or not files.rename(part, target):
        files.delete(part, False)
        raise RuntimeError(f"{path} is there already: another writer has changed the corpus")


@dataclass(frozen=True)
class Corpus:
    """A corpus below one folder. Flags live in ``done`` until they are merged."""

    root: str
    shapes: dict[str, Shape] = field(default_factory=lambda: TABLES, compare=False, repr=False)

    @classmethod
    def below(cls, root: str) -> "Corpus":
        return cls(root.rstrip("/"))

    # --- state -------------------------------------------------------------------------------

    def _states(self, spark: SparkSession) -> list[int]:
        return sorted(int(name[6:-5]) for name in _names(spark, f"{self.root}/_states") if name.startswith("state-"))

    def _state(self, spark: SparkSession) -> dict:
        versions = self._states(spark)
        if not versions:
            raise FileNotFoundError(f"there is no corpus in {self.root}")
        return json.loads(_read_text(spark, f"{self.root}/_states/state-{versions[-1]:08d}.json")) | {"version": versions[-1]}

    def _put(self, spark: SparkSession, state: dict) -> None:
        _put_once(spark, f"{self.root}/_states/state-{state['version']:08d}.json", json.dumps(state, sort_keys=True))

    def create(self, spark: SparkSession, buckets: int = BUCKETS) -> None:
        """An empty corpus, unless there is one; its number of buckets stays as it is."""
        if not self._states(spark):
            self._put(spark, {"version": 0, "buckets": buckets, "batches": []})

    def batches(self, spark: SparkSession, before: int | None = None) -> list[dict]:
        """What the state file says of every batch, or of those below ``before``."""
        return [entry for entry in self._state(spark)["batches"] if before is None or entry["batch"] < before]

    def has_batch(self, spark: SparkSession, first: int) -> bool:
        """Whether there is a batch ``first`` or a later one."""
        return bool(self._states(spark)) and any(entry["batch"] >= first for entry in self.batches(spark))

    def highest_id(self, spark: SparkSession, before: int | None = None) -> int:
        return max([entry["highest_id"] for entry in self.batches(spark, before)], default=0)

    # --- rows --------------------------------------------------------------------------------

    def _table(self, spark: SparkSession, table: str, buckets: int, folders: Sequence[str]) -> str:
        """Name of the table in the session's catalog, which knows at least ``folders``."""
        shape = self.shapes[table]
        name = f"citeweave_{hashlib.sha256(self.root.encode()).hexdigest()[:16]}_{buckets}_{table}"
        known = _registered.setdefault((spark.sparkContext.applicationId, name), set())
        if not known:
            columns = ", ".join(f"`{column.name}` {column.dataType.simpleString()}" for column in shape.schema)
            keys = ", ".join(shape.keys)
            clustered = f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {buckets} BUCKETS" if keys else ""
            spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}, folder STRING) USING parquet PARTITIONED BY (folder) {clustered} LOCATION '{self.root}/{table}'")
        new = [folder for folder in folders if folder not in known]
        for at in range(0, len(new), 200):
            parts = " ".join(f"PARTITION (folder='{folder}') LOCATION '{self.root}/{table}/{folder}'" for folder in new[at : at + 200])
            spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {parts}")
        known.update(new)
        return name

    def read(self, spark: SparkSession, table: str, before: int | None = None) -> DataFrame:
        """The rows of all batches of a table, or of those below ``before``."""
        state = self._state(spark)
        counts = [entry for entry in state["batches"] if before is None or entry["batch"] < before]
        return self._rows(spark, table, state, counts).select(*self.shapes[table].schema.fieldNames())

    def _rows(self, spark: SparkSession, table: str, state: dict, counts: Sequence[dict]) -> DataFrame:
        """Rows of some batches, with their ``folder``."""
        folders = [entry["tables"][table] for entry in counts if table in entry["tables"]]
        rows = spark.table(self._table(spark, table, state["buckets"], folders))
        return rows.where(F.col("folder").isin(folders) if folders else F.lit(False))

    def read_folders(self, spark: SparkSession, table: str, folders: Sequence[str]) -> DataFrame:
        """The rows of some of the folders that the state names."""
        state = self._state(spark)
        counts = [entry for entry in state["batches"] if entry["tables"].get(table) in folders]
        return self._rows(spark, table, state, counts).select(*self.shapes[table].schema.fieldNames())

    def read_papers(self, spark: SparkSession, before: int | None = None) -> DataFrame:
        """Papers with the flags of all parents noted as done; bucket meets bucket."""
        return mark_processed(self.read(spark, "papers", before), self.read(spark, "done", before))

    def batch(self, spark: SparkSession, number: int) -> "Batch":
        """A batch to write; it counts from the end of its ``with`` block on."""
        return Batch(self, spark, number)

    def seed(self, papers: DataFrame) -> None:
        with self.batch(papers.sparkSession, SEED_BATCH) as out:
            out.append("papers", papers)

    def merge_flags(self, spark: SparkSession) -> list[int]:
        """Write the batches anew whose papers have flags noted in ``done`` only; the numbers of those batches.

        Files of other batches stay as they are, and so does ``done``. All merged batches count at once.
        """
        state = self._state(spark)
        done = self.read(spark, "done")
        waiting = self._rows(spark, "papers", state, state["batches"]).where("NOT coalesce(is_processed, false)")
        marked = matching(waiting.select("ss_id", "folder"), done, ["ss_id"]).select("folder").distinct().collect()
        found = {row["folder"] for row in marked}
        merged = []
        for entry in state["batches"]:
            if entry["tables"].get("papers") in found:
                rows = self._rows(spark, "papers", state, [entry]).select(*self.shapes["papers"].schema.fieldNames())
                folder = _new_folder(entry["batch"])
                _write(spark, self, "papers", mark_processed(rows, done), folder, state["buckets"])
                merged.append(entry | {"tables": entry["tables"] | {"papers": folder}})
        if merged:
            others = [entry for entry in state["batches"] if entry["tables"].get("papers") not in found]
            batches = sorted([*others, *merged], key=lambda entry: entry["batch"])
            self._put(spark, {"version": state["version"] + 1, "buckets": state["buckets"], "batches": batches})
        return [entry["batch"] for entry in merged]

    def clean(self, spark: SparkSession) -> list[str]:
        """Delete the folders of batches that were stopped or written again; no other job may be writing or reading."""
        batches = self.batches(spark)
        gone = []
        for table in self.shapes:
            counts = {entry["tables"].get(table) for entry in batches}
            for name in _names(spark, f"{self.root}/{table}"):
                if name.startswith("batch-") and name not in counts:
                    target, files = _files(spark, f"{self.root}/{table}/{name}")
                    files.delete(target, True)
                    gone.append(f"{table}/{name}")
        return gone


def _new_folder(batch: int) -> str:
    return f"batch-{batch}-{uuid.uuid4().hex}"


def _write(spark: SparkSession, corpus: Corpus, table: str, rows: DataFrame, folder: str, buckets: int) -> int:
    """Write rows of a table to a new folder; the highest id among them, 0 where there is none."""
    shape = corpus.shapes[table]
    rows = rows.select(*[F.col(column.name).cast(column.dataType) for column in shape.schema])
    path = f"{corpus.root}/{table}/{folder}"
    if shape.keys:
        # Spark buckets rows for tables only: one is made for the write and forgotten, its files stay.
        name = f"citeweave_{folder.replace('-', '_')}_{table}"
        dealt = rows.repartition(buckets, *shape.keys)
        dealt.write.format("parquet").bucketBy(buckets, *shape.keys).sortBy(*shape.keys).option("path", path).saveAsTable(name)
        spark.sql(f"DROP TABLE {name}")
    else:
        rows.write.parquet(path)
    if "id" not in shape.schema.names:
        return 0
    # One column of this batch, as its files hold it.
    return spark.read.schema(shape.schema).parquet(path).agg(F.max("id")).first()[0] or 0


@dataclass
class Batch:
    """The tables of one batch; all of them count at once, or none if the block ends with an error."""

    corpus: Corpus
    spark: SparkSession
    number: int
    tables: dict[str, str] = field(default_factory=dict)
    highest_id: int = 0
    #: What else the state file says of the batch.
    notes: dict = field(default_factory=dict)

    def __enter__(self) -> "Batch":
        self._folder = _new_folder(self.number)
        self._buckets = self.corpus._state(self.spark)["buckets"]
        return self

    def append(self, table: str, rows: DataFrame) -> None:
        """Write the rows of one table; once for each table."""
        highest = _write(self.spark, self.corpus, table, rows, self._folder, self._buckets)
        self.highest_id = max(self.highest_id, highest)
        self.tables[table] = self._folder

    def __exit__(self, kind, *_rest) -> None:
        if kind is None:
            state = self.corpus._state(self.spark)
            entry = self.notes | {"batch": self.number, "tables": self.tables, "highest_id": self.highest_id}
            others = [other for other in state["batches"] if other["batch"] != self.number]
            batches = sorted([*others, entry], key=lambda entry: entry["batch"])
            self.corpus._put(self.spark, state | {"version": state["version"] + 1, "batches": batches})


def named_keys(staged: DataFrame, key: str, most: int = NAMED_KEYS) -> Column | None:
    """A filter on ``key`` that names the keys of a written batch, if they are few; Spark prunes buckets by it."""
    keys = [row[0] for row in staged.select(key).where(F.col(key).isNotNull()).distinct().limit(most + 1).collect()]
    return F.col(key).isin(keys) if len(keys) <= most else None


def touched(table: DataFrame, staged: DataFrame, keys: Sequence[str]) -> DataFrame:
    """As ``matching``, for a clustered table: its rows whose keys are in a written batch."""
    few = named_keys(staged, keys[0])
    return matching(table if few is None else table.where(few), staged, keys)
