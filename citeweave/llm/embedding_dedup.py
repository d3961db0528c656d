"""Near-duplicate vectors by an inverted multi-index.

Vectors are scaled to length 1 and cut into two halves; each half has a codebook of its own, fitted on
a bounded sample of ``SAMPLE`` vectors, and the grid of the two codebooks has one posting list per cell. The grid
grows with the table, to about ``_CELL`` vectors a cell. Every vector is in the list of the cell of its nearest centres.

A query visits cells in the order of the sum of their centres' distances from its halves: both codebooks are
sorted, and as sums rise along both sequences, the first ``n`` cells are found among those whose two places multiply to
``n`` at most. How many cells a query visits is measured: ``ASKED`` queries at most (of the vectors whose id is divisible by 20) are
compared with all vectors, and the number is the smallest step at which the share ``recall`` of their partners lies
in visited cells. Where they have few partners, made-up ones of the sample's vectors count too, pushed along
directions of the data and along any. Visited lists are compared in full, in double precision.

A pair is found if either vector visits the other's cell, and counts for both: where only one does, its task
counts for the other one too, so a pair seen from both sides counts once for each. ``recall=1`` visits all cells.

The cells of one centre of the first half, or a part of them, make an area of some ``LIST_BLOCK`` vectors; a query is sent once to each area in
which it visits a cell, and compared there with the members of the cells it visits.

Equal vectors are one unit with a weight before any comparison. Areas and queries are dealt in
blocks of bounded size, so a cell that a third of all vectors share makes many tasks. A task gives
back a count for each vector and a spanning forest of the links it saw, never the links themselves;
components come from the forests by star contraction.

A vector that is null, zero, or holds null or non-finite components links with nothing, and so does a
row without ``vec_id``. A shorter vector counts as padded with zeros. Rows that repeat a ``vec_id``
are one node of the graph, with a count each. Columns other than ``vec_id`` and ``embedding`` are not
looked at. An empty table gives an empty table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeweave.llm.components import component_labels
from citeweave.staging import Staging

#: Vectors on which the codebooks are fitted, and queries that tell how far to walk; all vectors are indexed and asked.
SAMPLE, ASKED = 32_768, 2048
#: Members of an area's block, and queries, in one comparison.
LIST_BLOCK, QUERY_BLOCK = 2048, 4096
#: Vectors in a cell, and sample vectors for a centre, at least.
_CELL, _FIT = 8, 8
#: So many partners at least tell by themselves how far to walk.
_ENOUGH = 1000
#: Steps of the number of cells that a query may visit: each is half as many again.
_STEP = 1.5
#: Numbers in one array.
_ROOM = 1 << 22


@dataclass
class MultiIndex:
    """Codebooks of the halves, and how many cells a query visits."""

    books: list[np.ndarray]
    visits: int
    parts: int = 1  # areas for each centre of the first book

    @property
    def cells(self) -> int:
        return len(self.books[0]) * len(self.books[1])

    def distances(self, x: np.ndarray) -> list[np.ndarray]:
        """For each half, squared distances of the rows from the centres."""
        cut = self.books[0].shape[1]
        halves = [x[:, :cut], x[:, cut:]]
        return [((h**2).sum(1)[:, None] - 2 * h @ b.T + (b**2).sum(1)).clip(0) for h, b in zip(halves, self.books, strict=True)]

    def reach(self, first: np.ndarray, second: np.ndarray, visits: int) -> np.ndarray:
        """For each row a distance that ``visits`` cells are within: midway between the last of them and the next."""
        if visits >= self.cells:
            return np.full(len(first), math.inf)
        a, b = np.sort(first, axis=1), np.sort(second, axis=1)
        # Of the cells before (i, j) in both sequences all (i + 1) * (j + 1) are at least as near.
        i = np.repeat(np.arange(a.shape[1]), np.minimum((visits + 1) // np.arange(1, a.shape[1] + 1), b.shape[1]))
        j = np.arange(len(i)) - np.searchsorted(i, i)
        found = np.empty(len(a))
        rows = max(1, _ROOM // len(i))
        for at in range(0, len(a), rows):
            sums = a[at : at + rows, i] + b[at : at + rows, j]
            sums.partition((visits - 1, visits), axis=1)
            found[at : at + rows] = (sums[:, visits - 1] + sums[:, visits]) / 2
        return found

    def steps(self) -> list[int]:
        """Numbers of cells from one to all."""
        found = [1]
        while found[-1] < self.cells:
            found.append(min(self.cells, max(found[-1] + 1, int(found[-1] * _STEP))))
        return found

    def part_of(self, second: np.ndarray) -> np.ndarray:
        return second * self.parts // len(self.books[1])

    def areas(self, first: np.ndarray, second: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, area) of the areas in which a row visits a cell."""
        edges = np.flatnonzero(np.diff(np.append(-1, self.part_of(np.arange(len(self.books[1]))))))
        nearest = np.minimum.reduceat(second, edges, axis=1)
        rows, found = max(1, _ROOM // (first.shape[1] * len(edges))), []
        for at in range(0, len(first), rows):
            some = first[at : at + rows, :, None] + nearest[at : at + rows, None, :] <= reach[at : at + rows, None, None]
            row, i, part = np.nonzero(some)
            found.append((row + at, i * self.parts + part))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, int), np.zeros(0, int))


def _centres(x: np.ndarray, k: int, draw: np.random.Generator) -> np.ndarray:
    book = x[draw.choice(len(x), k, replace=False)]
    for _ in range(8):
        own = ((book**2).sum(1) - 2 * x @ book.T).argmin(1)
        size = np.bincount(own, minlength=k)
        total = np.zeros_like(book)
        np.add.at(total, own, x)
        book = np.where(size[:, None] > 0, total / np.maximum(size, 1)[:, None], book)
    return book


def fit(sample: np.ndarray, rows: int) -> MultiIndex:
    """An index for ``rows`` unit vectors, from a sample of them, which visits all cells."""
    draw = np.random.default_rng(7)
    k = max(1, min(round(math.sqrt(rows / _CELL)), len(sample) // _FIT))
    cut = (sample.shape[1] + 1) // 2
    # Equal centres would make equal distances.
    books = [np.unique(_centres(half, k, draw), axis=0) for half in (sample[:, :cut], sample[:, cut:])]
    if books[1].size:
        # Along the direction in which they differ most, so that a part of an area is a neighbourhood.
        along = np.linalg.svd(books[1] - books[1].mean(0), full_matrices=False)[2][0]
        books[1] = books[1][np.argsort(books[1] @ along, kind="stable")]
    index = MultiIndex(books, 0)
    index.visits = index.cells
    index.parts = max(1, min(round(rows / (len(books[0]) * LIST_BLOCK)), len(books[1])))
    return index


def levels_of(index: MultiIndex, asked: np.ndarray, row: np.ndarray, cells: np.ndarray, reaches: np.ndarray) -> np.ndarray:
    """For pairs of a query (``row`` of ``asked``) and a partner's cell: the first of the index's steps that visits it."""
    first, second = index.distances(asked)
    far = first[row, cells // len(index.books[1])] + second[row, cells % len(index.books[1])]
    found = np.zeros(len(row), np.int64)
    for reach in reaches.T:
        found += far > reach[row]
    return found


def made_up(sample: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Queries out of the sample, and partners for them between the cosine and 1, pushed along differences in the sample and along any direction."""
    draw = np.random.default_rng(11)
    x = sample[draw.choice(len(sample), min(len(sample), ASKED), replace=False)]
    ways = [draw.normal(size=x.shape), sample[draw.integers(0, len(sample), len(x))] - sample[draw.integers(0, len(sample), len(x))]]
    found = []
    for way in ways:
        way = way - (way * x).sum(1, keepdims=True) * x
        size = np.linalg.norm(way, axis=1, keepdims=True)
        near = draw.uniform(cosine, 1, (len(x), 1))
        found.append(np.where(size > 1e-9, near * x + np.sqrt(1 - near**2) * way / np.maximum(size, 1e-9), x))
    return np.concatenate([x, x]), np.concatenate(found)


def steps_needed(units: DataFrame, index: MultiIndex, queries: pd.DataFrame, cosine: float) -> np.ndarray:
    """How many partners of the queries each step of the index adds, over all units."""
    asked, names, marks = _matrix(list(queries["vector"])), queries["node"].to_numpy(), queries["tag"].to_numpy()
    first, second = index.distances(asked)
    reaches = np.stack([index.reach(first, second, n) for n in index.steps()], axis=1)
    shared = units.sparkSession.sparkContext.broadcast((index, asked, names, marks, reaches))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, asked, names, marks, reaches = shared.value
        seen = np.zeros(reaches.shape[1] + 1, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                x = _matrix(part.column(0).to_pylist())
                itself = (names[:, None] == part.column(1).to_numpy()) & (marks[:, None] == part.column(2).to_numpy())
                row, other = np.nonzero((asked @ x.T >= cosine) & ~itself)
                if len(row):
                    a, b = index.distances(x)
                    cells = a.argmin(1) * len(index.books[1]) + b.argmin(1)
                    seen += np.bincount(levels_of(index, asked, row, cells[other], reaches), minlength=len(seen))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(seen))), pa.array(seen)], ["step", "n"])

    counts = units.select("vector", "node", "tag").mapInArrow(run, "step long, n long").groupBy("step").agg(F.sum("n").alias("n"))
    found = np.zeros(len(index.steps()) + 1, np.int64)
    for row in counts.collect():
        found[row["step"]] = row["n"]
    return found


def with_visits(units: DataFrame, index: MultiIndex, sample: np.ndarray, cosine: float, recall: float) -> MultiIndex:
    """The index with the number of cells that the recall needs."""
    if recall >= 1:
        return index
    queries = units.where("node % 20 = 0").orderBy(F.xxhash64("vector")).limit(ASKED).select("vector", "node", "tag").toPandas()
    steps = index.steps()
    needed = np.zeros(len(steps) + 1, np.int64)
    if len(queries):
        needed = needed + steps_needed(units, index, queries, cosine)
    share = lambda counts: steps[min(int(np.searchsorted(np.cumsum(counts), recall * counts.sum())), len(steps) - 1)]
    visits = share(needed) if needed.sum() else 1
    if needed.sum() < _ENOUGH:
        asked, partners = made_up(sample, cosine)
        first, second = index.distances(asked)
        reaches = np.stack([index.reach(first, second, n) for n in steps], axis=1)
        a, b = index.distances(partners)
        cells = a.argmin(1) * len(index.books[1]) + b.argmin(1)
        levels = levels_of(index, asked, np.arange(len(asked)), cells, reaches)
        # The two ways of pushing are as good as two tables: both have to be met.
        for half in np.split(levels, 2):
            visits = max(visits, share(np.bincount(half, minlength=len(steps) + 1)))
    return MultiIndex(index.books, visits, index.parts)


def _matrix(units: list[bytes]) -> np.ndarray:
    """Unit vectors in double precision from packed 64-bit floats of one length."""
    x = np.frombuffer(b"".join(units), "<f8").reshape(len(units), -1)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def packed(vectors: DataFrame, width: int) -> DataFrame:
    """(vec_id, vector): components as packed doubles, scaled by the largest; null where the row can't link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for vec_id, values in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                usable = vec_id is not None and values and None not in values
                x = np.array(values if usable else [0.0], float)
                top = np.abs(x).max()
                out.append(np.pad(x / top, (0, width - len(x))).astype("<f8").tobytes() if np.isfinite(top) and top > 0 else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["vec_id", "vector"])

    return vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")).mapInArrow(run, "vec_id long, vector binary")


def local_forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges from each node to the smallest node of its component, for the nodes of edges (a, b)."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    off = label != np.arange(len(nodes))
    return nodes[off], nodes[label[off]]


def compare_blocks(queries: pd.DataFrame, members: pd.DataFrame, index: MultiIndex, cosine: float) -> pd.DataFrame:
    """Rows (a, tag, b, n): a vector's weighted number of partners (b null), and forest edges (tag and n null)."""
    columns = {"a": "int64", "tag": "Int64", "b": "Int64", "n": "Int64"}
    if queries.empty or members.empty:
        return pd.DataFrame({name: pd.Series(dtype=kind) for name, kind in columns.items()})
    members = members.sort_values(["cell", "node", "tag"], kind="stable")
    m, weight, cells = _matrix(list(members["vector"])), members["weight"].to_numpy(), members["cell"].to_numpy()
    ids, tags, far = members["node"].to_numpy(), members["tag"].to_numpy(), members["reach"].to_numpy()
    from_member = index.distances(m)
    width = len(index.books[1])
    cut = np.append(np.flatnonzero(np.diff(np.append(-1, cells))), len(cells))
    for_members = np.zeros(len(m), np.int64)
    parts: list[np.ndarray] = []
    ends: list[tuple[np.ndarray, np.ndarray]] = []
    asked, asked_tags = queries["node"].to_numpy(), queries["tag"].to_numpy()
    for at in range(0, len(queries), 512):
        some = queries.iloc[at : at + 512]
        q, q_ids, q_tags, q_weight = _matrix(list(some["vector"])), some["node"].to_numpy(), some["tag"].to_numpy(), some["weight"].to_numpy()
        first, second = index.distances(q)
        counts, own = np.zeros(len(q), np.int64), some["cell"].to_numpy()
        for begin, end in zip(cut[:-1], cut[1:], strict=True):
            i, j = divmod(int(cells[begin]), width)
            row = np.flatnonzero(first[:, i] + second[:, j] <= some["reach"].to_numpy())
            if not len(row):
                continue
            near = q[row] @ m[begin:end].T >= cosine
            near &= (q_ids[row, None] != ids[begin:end]) | (q_tags[row, None] != tags[begin:end])
            counts[row] += near @ weight[begin:end]
            x, y = np.nonzero(near)
            if len(x):
                x, y = row[x], y + begin
                # Does the member visit the query's cell? If not, only this task sees the pair.
                back = from_member[0][y, own[x] // width] + from_member[1][y, own[x] % width] <= far[y]
                np.add.at(for_members, y[~back], q_weight[x[~back]])
                ends.append(local_forest(q_ids[x], ids[y]))
        parts.append(counts)
    counts = np.concatenate(parts)
    found = []
    for names, marks, n in ((asked, asked_tags, counts), (ids, tags, for_members)):
        found.append(pd.DataFrame({"a": names[n > 0], "tag": marks[n > 0], "b": pd.NA, "n": n[n > 0]}))
    if ends:
        a, b = local_forest(*(np.concatenate(x) for x in zip(*ends, strict=True)))
        found.append(pd.DataFrame({"a": a, "tag": pd.NA, "b": b, "n": pd.NA}))
    return pd.concat([x.astype(columns) for x in found])


def near_duplicates(vectors: DataFrame, staging: Staging, cosine: float = 0.9, recall: float = 0.99) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors``."""
    width = vectors.agg(F.max(F.size("embedding"))).first()[0] or 0
    rows = staging.write(packed(vectors, max(width, 1)), "vectors")
    units = rows.where("vector IS NOT NULL").groupBy("vector").agg(F.min("vec_id").alias("node"), F.count("*").alias("weight"))
    # Units are told apart by id and tag, as rows with one id may hold several vectors.
    units = staging.write(units.withColumn("tag", F.xxhash64("vector")), "units")
    count = units.count()
    sample = units.orderBy(F.xxhash64("vector")).limit(SAMPLE).select("vector").toPandas()["vector"]
    if not count:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    sample = _matrix(list(sample))
    fitted = with_visits(units, fit(sample, count), sample, cosine, recall)
    index = vectors.sparkSession.sparkContext.broadcast(fitted)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index_ = index.value
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                first, second = index_.distances(_matrix(part.column(0).to_pylist()))
                i, j = first.argmin(1), second.argmin(1)
                area = i * index_.parts + index_.part_of(j)
                added = [pa.array(i * len(index_.books[1]) + j), pa.array(area), pa.array(index_.reach(first, second, index_.visits))]
                yield pa.RecordBatch.from_arrays([*part.columns, *added], [*part.schema.names, "cell", "area", "reach"])

    def visited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                row, area = index.value.areas(*index.value.distances(_matrix(part.column(0).to_pylist())), part.column(3).to_numpy())
                row = pa.array(row, pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(1).take(row), part.column(2).take(row), pa.array(area, pa.int64())], ["node", "tag", "area"])

    lists = staging.write(units.mapInArrow(placed, "vector binary, node long, weight long, tag long, cell long, area long, reach double"), "lists")
    visits = staging.write(lists.select("vector", "node", "tag", "reach").mapInArrow(visited, "node long, tag long, area long"), "visits")
    sizes = lists.groupBy("area").agg(F.ceil(F.count("*") / LIST_BLOCK).alias("blocks"))
    asked = visits.groupBy("area").agg(F.ceil(F.count("*") / QUERY_BLOCK).alias("shares"))
    dealt = staging.write(sizes.join(asked, "area"), "areas")
    deal = lambda n: F.pmod(F.xxhash64("node", "tag", "area"), F.col(n))
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    key = ["area", "block", "share"]
    columns = [*key, "node", "tag", "weight", "cell", "reach", "vector"]
    members = lists.join(dealt, "area").withColumn("block", deal("blocks")).withColumn("share", each("shares")).select(*columns)
    queries = (
        visits.join(dealt, "area")
        .withColumn("share", deal("shares"))
        .withColumn("block", each("blocks"))
        .join(lists.select(*[F.col(name).alias(name) for name in ("node", "tag", "weight", "cell", "reach", "vector")]), ["node", "tag"])
        .select(*columns)
    )
    compared = queries.groupBy(*key).cogroup(members.groupBy(*key)).applyInPandas(
        lambda q, m: compare_blocks(q, m, index.value, cosine), "a long, tag long, b long, n long"
    )
    compared = staging.write(compared, "compared")
    labels = staging.write(component_labels(compared.where("b IS NOT NULL").select("a", "b"), staging), "labels")
    counts = compared.where("n IS NOT NULL").groupBy(F.col("a").alias("node"), "tag").agg(F.sum("n").alias("near"))
    named = units.join(counts, ["node", "tag"], "left").join(labels, "node", "left")
    named = staging.write(named.select("vector", "node", "weight", "near", "component"), "named")
    linked = F.col("vector").isNotNull()
    component = F.when(linked, F.coalesce("component", "node")).otherwise(F.col("vec_id"))
    return rows.join(named, "vector", "left").select(
        "vec_id",
        F.when(linked, F.coalesce("near", F.lit(0)) + F.col("weight") - 1).otherwise(0).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
