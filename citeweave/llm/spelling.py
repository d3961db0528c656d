"""Spelling variants by a trie over letter-group counts.

Words are counted over all texts. The letters form ``GROUPS`` groups, and a word's vector says how many of
its letters are in each group. Words are arranged in a trie by successive counts, the group that tells
words apart best first. Two words that differ by one inserted, deleted or replaced letter have vectors
that differ by at most one surplus and one deficit, so a search descends with a budget of one each, and
compares the words of the leaves it reaches letter by letter. A pair is searched from one side only: the
first difference along the trie has to be a surplus.

The trie is opened level by level as tables, until every subtree has at most ``SUBTREE`` words; searches
descend through the open part by joins, and each closed subtree is searched depth first inside a task,
with shares of its searches dealt to several tasks. A leaf with more words than that (all have
the same vector) is dealt in blocks. Every word is searched, and no pair becomes a row: a task gives back, for
each word, how many near words it saw and the best of them.

Null and empty texts have no words. A null ``doc_id`` is written as an empty text before the colon. Rows that
repeat a ``doc_id`` or a text count each. Words are texts of code points up to U+00FF and may be of any
length; counts above 93 are one count in the trie, which costs comparisons and no result. Ties go to the
word that sorts first. An empty table gives an empty table. Columns other than ``doc_id`` and ``text`` are
not looked at.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeweave.staging import Staging

# What a run is, and how runs are edited.
RUN = re.compile("[A-Za-zÀ-ÿ]+")
EDITED = 199

GROUPS = 16
#: Words in a closed subtree, and searches in one share of it.
SUBTREE, SHARE = 16_384, 65_536
#: Distinct words that a task holds before it passes their counts on.
HELD = 400_000
#: States of a search, and pairs of words, that are looked at together.
_STATES, _PAIRS = 1 << 16, 1 << 16
#: Counts are written as characters from this one on, so that paths sort as vectors do.
_ZERO, _MOST = 33, 93
_SHORT = 64

WORDS = "word string, n long"


def _ascii_lower(text: str) -> str:
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def runs_of(doc_id: int | None, text: str | None) -> Counter:
    """Counts of the runs of one document after its edits; the empty word may be among them."""
    found: Counter = Counter()
    head = "" if doc_id is None else str(doc_id)
    for word, n in Counter(RUN.findall(_ascii_lower(text or ""))).items():
        h = zlib.crc32(f"{head}:{word}".encode())
        if h % EDITED == 0:
            at = h % len(word)
            word = word[:at] + word[at + 1 :]
        found[word] += n
    return found


def _count_batches(least_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])
            counts.clear()
            return out

        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                for word, n in runs_of(doc_id.as_py(), text.as_py()).items():
                    if len(word) >= least_chars:
                        counts[word] += n
                if len(counts) >= HELD:
                    yield flush()
        yield flush()

    return run


def count_words(docs: DataFrame, least_chars: int, least_n: int) -> DataFrame:
    """(word, n): the words of enough code points and occurrences."""
    partial = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_count_batches(least_chars), WORDS)
    return partial.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_n)


def group_counts(words: list[str]) -> np.ndarray:
    """One row per word: how many letters of each group it has."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    letters = np.frombuffer("".join(words).encode("latin-1"), np.uint8)
    row = np.repeat(np.arange(len(words)), sizes)
    return np.bincount(row * GROUPS + letters % GROUPS, minlength=len(words) * GROUPS).reshape(-1, GROUPS)


def level_order(words: DataFrame) -> list[int]:
    """The groups, the one whose counts vary most first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, square = 0, np.zeros(GROUPS), np.zeros(GROUPS)
        for batch in batches:
            counts = np.minimum(group_counts(batch.column(0).to_pylist()), _MOST).astype(float)
            n, total, square = n + len(counts), total + counts.sum(0), square + (counts**2).sum(0)
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([total.tolist()]), pa.array([square.tolist()])], ["n", "total", "square"])

    parts = words.select("word").mapInArrow(run, "n long, total array<double>, square array<double>")
    each = [F.sum(F.col(c)[g]).alias(f"{c}{g}") for c in ("total", "square") for g in range(GROUPS)]
    row = parts.agg(F.sum("n").alias("n"), *each).first()
    n = row["n"] or 1
    spread = [(row[f"square{g}"] or 0) / n - ((row[f"total{g}"] or 0) / n) ** 2 for g in range(GROUPS)]
    return sorted(range(GROUPS), key=lambda g: (-round(spread[g], 6), g))


def with_vectors(words: DataFrame, order: list[int]) -> DataFrame:
    """(word, n, vector): the counts as characters, in the order of the trie's levels."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            some = batch.column(0).to_pylist()
            codes = (np.minimum(group_counts(some)[:, order], _MOST) + _ZERO).astype(np.uint8)
            vectors = [row.tobytes().decode("ascii") for row in codes]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(vectors, pa.string())], ["word", "n", "vector"])

    return words.select("word", "n").mapInArrow(run, f"{WORDS}, vector string")


def open_trie(words: DataFrame, staging: Staging, subtree: int) -> list[DataFrame]:
    """For each level from the root on (path, members, closed), until every subtree is closed."""
    levels, inside = [], words.select("vector")
    for depth in range(GROUPS + 1):
        path = F.substring("vector", 1, depth).alias("path")
        sizes = inside.groupBy(path).agg(F.count("*").alias("members"))
        closed = F.lit(True) if depth == GROUPS else F.col("members") <= subtree
        level = staging.write(sizes.withColumn("closed", closed), f"level-{depth}")
        levels.append(level)
        still = level.where("NOT closed").select(F.col("path").alias("_path"))
        if still.isEmpty():
            return levels
        inside = inside.join(still, F.substring("vector", 1, depth) == F.col("_path"), "left_semi")
    return levels


def descend(words: DataFrame, levels: list[DataFrame], staging: Staging) -> DataFrame:
    """(path, depth, word, n, vector, spent): every closed subtree that each word's search reaches.

    ``spent`` is 0 before any difference, 1 after the surplus, 2 after the deficit as well. The subtree
    that a word reaches with nothing spent is its own.
    """
    root = levels[0].first()
    whole = root is None or root["closed"]
    at = words.select(F.substring("vector", 1, 0).alias("path"), "word", "n", "vector", F.lit(0).alias("spent"))
    reached = at.withColumn("depth", F.lit(0)).where(F.lit(whole))
    for depth, level in enumerate(levels[1:], 1):
        own = F.ascii(F.substring("vector", depth, 1))
        child = lambda step, spent: F.struct(F.concat("path", F.char(own + step)).alias("path"), F.lit(spent).alias("spent"))
        steps = (
            F.when(F.col("spent") == 0, F.array(child(0, 0), child(1, 1)))
            .when(F.col("spent") == 1, F.array(child(0, 1), child(-1, 2)))
            .otherwise(F.array(child(0, 2)))
        )
        at = at.select("word", "n", "vector", F.explode(steps).alias("to")).select("to.path", "word", "n", "vector", "to.spent")
        met = staging.write(at.join(level, "path").withColumn("depth", F.lit(depth)), f"searches-{depth}")
        reached = reached.unionByName(met.where("closed").drop("closed", "members"))
        at = met.where("NOT closed").select("path", "word", "n", "vector", "spent")
    return reached


class Trie:
    """Words below one path, sorted by vector; each level has its nodes' keys in ascending order."""

    def __init__(self, words: list[str], codes: np.ndarray, depth: int):
        order = np.lexsort(codes.T[::-1]) if len(words) else np.zeros(0, int)
        self.words = [words[i] for i in order]
        self.order, codes = order, codes[order]
        self.depth, self.keys = depth, []
        node = np.zeros(len(words), np.int64)
        for level in range(depth, GROUPS):
            keys, node = np.unique(node * 256 + codes[:, level], return_inverse=True)
            self.keys.append(keys)
        self.first = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]])) if len(words) else np.zeros(0, int)
        self.size = np.diff(np.append(self.first, len(words)))

    def children(self, level: int, node: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which nodes have a child with this count, and the child."""
        keys, want = self.keys[level - self.depth], node * 256 + code
        at = np.searchsorted(keys, want)
        found = np.flatnonzero(keys[np.minimum(at, len(keys) - 1)] == want)
        return found, at[found]

    def leaves(self, codes: np.ndarray, spent: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(search, leaf, spent) depth first: states of the deepest level reached go on before others."""
        if not len(self.words):
            return
        stack = [(self.depth, np.arange(len(codes))[i : i + _STATES]) for i in range(0, len(codes), _STATES)]
        stack = [(level, rows, np.zeros(len(rows), np.int64), spent[rows]) for level, rows in stack]
        while stack:
            level, row, node, used = stack.pop()
            if level == GROUPS:
                yield row, node, used
                continue
            code, parts = codes[row, level].astype(np.int64), []
            for step, may, then in ((0, used >= 0, used), (1, used == 0, used + 1), (-1, used == 1, used + 1)):
                some = np.flatnonzero(may)
                found, child = self.children(level, node[some], code[some] + step)
                parts.append((row[some[found]], child, then[some[found]]))
            row, node, used = (np.concatenate(x) for x in zip(*parts, strict=True))
            stack += [(level + 1, row[i : i + _STATES], node[i : i + _STATES], used[i : i + _STATES]) for i in range(0, len(row), _STATES)]


def _letters(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Letters of the words that are short enough, in rows of one width, and all lengths."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    short = [word.encode("latin-1") if len(word) <= _SHORT else b"" for word in words]
    return np.array(short, f"S{_SHORT + 1}").view(np.uint8).reshape(len(words), _SHORT + 1), sizes


def one_apart(a: str, b: str) -> bool:
    """Whether exactly one inserted, deleted or replaced code point turns ``a`` into ``b``."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    at = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[at + (len(a) == len(b)) :] == b[at + 1 :]


def near(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """``one_apart`` for rows of letters with at most ``_SHORT`` of them each."""
    swap = (size_a > size_b)[:, None]
    a, b = np.where(swap, b, a), np.where(swap, a, b)
    gap = np.abs(size_a - size_b)
    differs = a != b
    first = differs.argmax(1)
    shifted = a[:, :-1] != b[:, 1:]
    beyond = np.arange(shifted.shape[1]) >= first[:, None]
    inserted = (gap == 1) & ~(shifted & beyond).any(1)
    return inserted | ((gap == 0) & (differs.sum(1) == 1))


def search_subtree(group: pa.Table) -> pa.Table:
    """(word, n_near, form_n, form) from the pairs that one subtree's searches find, for both words of each."""
    columns = {name: group.column(name) for name in group.column_names}
    member = columns["member"].to_numpy(zero_copy_only=False).astype(bool)
    depth = columns["depth"][0].as_py()
    words, n = np.array(columns["word"].to_pylist(), object), columns["n"].to_numpy()
    codes = np.frombuffer("".join(columns["vector"].to_pylist()).encode("ascii"), np.uint8).reshape(-1, GROUPS)
    asked, spent = np.flatnonzero(~member), columns["spent"].to_numpy().astype(np.int64)
    held = np.flatnonzero(member)
    trie = Trie(list(words[held]), codes[held], depth)
    held = held[trie.order]
    letters, sizes = _letters(list(words))
    # One word may stand in the group as a search and as a member: told apart by its place in order.
    names = sorted(set(words))
    place = {word: k for k, word in enumerate(names)}
    of = np.fromiter((place[word] for word in words), np.int64, len(words))
    ends: list[tuple[np.ndarray, np.ndarray]] = []
    for row, leaf, used in trie.leaves(codes[asked], spent[asked]):
        many = trie.size[leaf]
        for part in np.split(np.arange(len(row)), np.flatnonzero(np.diff(np.cumsum(many) // _PAIRS)) + 1):
            wide = many[part]
            inner = np.arange(int(wide.sum())) - np.repeat(np.cumsum(wide) - wide, wide)
            i = np.repeat(asked[row[part]], wide)
            j = held[np.repeat(trie.first[leaf[part]], wide) + inner]
            plain = np.repeat(used[part] == 0, wide)
            # Equal vectors meet from both sides.
            keep = np.abs(sizes[i] - sizes[j]) <= 1
            keep[plain] &= of[i[plain]] < of[j[plain]]
            i, j = i[keep], j[keep]
            if not len(i):
                continue
            short = (sizes[i] <= _SHORT) & (sizes[j] <= _SHORT)
            width = min(_SHORT, int(max(sizes[i].max(), sizes[j].max()))) + 1
            fits = np.zeros(len(i), bool)
            fits[short] = near(letters[i[short], :width], letters[j[short], :width], sizes[i[short]], sizes[j[short]])
            for k in np.flatnonzero(~short):
                fits[k] = one_apart(words[i[k]], words[j[k]])
            ends.append((i[fits], j[fits]))
    i = np.concatenate([x for x, _ in ends]) if ends else np.zeros(0, int)
    j = np.concatenate([x for _, x in ends]) if ends else np.zeros(0, int)
    own, other = np.concatenate([i, j]), np.concatenate([j, i])
    own, by = of[own], np.lexsort([of[other], -n[other], of[own]])
    own, other = own[by], other[by]
    first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]])) if len(own) else np.zeros(0, int)
    return pa.table(
        {
            "word": pa.array([names[k] for k in own[first]], pa.string()),
            "n_near": pa.array(np.diff(np.append(first, len(own))), pa.int64()),
            "form_n": pa.array(n[other[first]], pa.int64()),
            "form": pa.array(words[other[first]].tolist(), pa.string()),
        }
    )


def near_words(words: DataFrame, staging: Staging, subtree: int = SUBTREE, share: int = SHARE) -> DataFrame:
    """(word, n_near, form, form_n): near words of each word that has any, and the most frequent of them.

    ``words`` is a written table of distinct words with their counts.
    """
    vectors = staging.write(with_vectors(words, level_order(words)), "vectors")
    reached = descend(vectors, open_trie(vectors, staging, subtree), staging)
    own = F.col("spent") == 0
    sizes = reached.groupBy("path").agg(
        F.ceil(F.sum(own.cast("long")) / subtree).alias("blocks"), F.ceil(F.count("*") / share).alias("shares")
    )
    sizes = staging.write(sizes, "subtrees")
    deal = lambda n: F.pmod(F.xxhash64("word"), F.col(n))
    each = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n) - 1)
    columns = ["path", "depth", "word", "n", "vector", "spent"]
    placed = reached.join(sizes, "path")
    searches = placed.select(*columns, F.lit(False).alias("member"), deal("shares").alias("share"), F.explode(each("blocks")).alias("block"))
    members = placed.where(own).select(*columns, F.lit(True).alias("member"), F.explode(each("shares")).alias("share"), deal("blocks").alias("block"))
    found = searches.unionByName(members).groupBy("path", "share", "block").applyInArrow(search_subtree, "word string, n_near long, form_n long, form string")
    best: Column = F.min(F.struct((-F.col("form_n")).alias("less"), "form"))
    merged = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
    return merged.select("word", "n_near", F.col("best.form").alias("form"), (-F.col("best.less")).alias("form_n"))


def roots(forms: DataFrame, staging: Staging) -> DataFrame:
    """(word, root) for the words of ``forms`` (word, form): where a walk from form to form ends.

    Pointers are doubled: counts rise along a walk, so walks are short and never close.
    """
    at = staging.write(forms.select("word", F.col("form").alias("root")), "roots-0")
    turn = 0
    while True:
        turn += 1
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("_ahead"))
        step = staging.write(at.join(ahead, "root", "left"), f"roots-{turn}")
        at = step.select("word", F.coalesce("_ahead", "root").alias("root"))
        if step.where("_ahead IS NOT NULL").isEmpty():
            return at


def spelling_variants(
    docs: DataFrame, staging: Staging, *, least_chars: int = 6, least_n: int = 5, factor: int = 5, subtree: int = SUBTREE, share: int = SHARE
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of ``docs``."""
    words = staging.write(count_words(docs, least_chars, least_n), "words")
    best = near_words(words, staging, subtree, share)
    named = staging.write(words.join(best, "word", "left"), "named")
    takes = F.col("form_n") >= factor * F.col("n")
    ends = roots(named.where(takes).select("word", "form"), staging)
    return named.join(ends, "word", "left").select(
        "word",
        F.when(takes, F.col("form")).alias("form"),
        F.coalesce("root", "word").alias("root"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(takes, F.col("form_n")).alias("form_n"),
    )
