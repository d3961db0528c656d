"""Collocations by multikey quicksort of suffix pointers, routed by their leading words.

Every word is the beginning of a suffix: itself and the words after it in its piece, up to ``DEPTH`` words. A
first pass counts all words of each language, and how many suffixes fall to each of ``BUCKETS`` buckets by
their two leading words. A second pass ends pieces at words that are not frequent, as no frequent phrase holds one (a table of
``BITS`` bits rules them out), and sends the suffixes to tasks by their two leading words; those of a
bucket that is too large are sent by all their words instead, so that a pair of words that a third of the
corpus holds is dealt over many tasks, and what such a task sees of a pair or a triple is added up afterwards. Equal suffixes
of one portion travel as one, with a count, and a portion's suffixes for one task travel as one packed block of word
numbers beside the words they mean.

A task sorts pointers to its suffixes by three-way partitioning, one word at a time: those below the
pivot's word, equal to it, above it. The size of an equal partition is the count of the phrase that its
suffixes share, which is then sorted by the next word, down to the greatest depth. A partition smaller than the
least count is abandoned, as nothing in it can be frequent.

Scores and the choice of phrases are joins and aggregates over the frequent phrases alone; ranks are found
in shares of a language first. Arithmetic is exact: counts are longs, products are decimals.

Null and empty texts have no words; a null language is ``und``, which it shares with documents labelled so.
Rows that repeat an id or a text count each. Texts are read whole, in portions that never cut a word; a phrase may
lie across portions. Ties go as the order (score and count descending, phrase ascending in bytes) says. An empty
table gives an empty table. Only ``text`` and ``lang`` are looked at.
"""

from __future__ import annotations

import struct
from collections import Counter
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from citeweave.staging import Staging

UNKNOWN = "und"
DEPTH = 4
BUCKETS = 1 << 16
#: Suffixes of a bucket beyond which it is dealt by all words, and suffixes that one task should get.
HOT, TASK = 1 << 19, 1 << 20
#: Words sorted out together before they travel, and bytes of a text read at a time.
PORTION, READ = 1 << 20, 1 << 22
#: Bits that tell which words can be frequent.
BITS = 1 << 24
#: Distinct words that a task holds before it passes their counts on.
HELD = 100_000

# What ends a piece and what stands between words; capitals become small letters.
_ENDS, _GAPS = b".,;:!?\n\x0b\x0c\r", b"\t"
# A byte that no UTF-8 text holds stands for the end of a piece.
_END = b"\xff"
_TABLE = bytes(255 if i in _ENDS else 32 if i in _GAPS else i + 32 if 65 <= i <= 90 else i for i in range(256))

COUNTS = "lang string, word string, n long"
_HEAD = struct.Struct("<IIBB")


class Numbers(dict):
    """Numbers words as they come; 0 ends a piece."""

    def __init__(self):
        super().__init__({_END: 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def portions(text: str | None, most: int = READ) -> Iterator[list[bytes]]:
    """Words and ends of pieces of a text, in portions that cut no word."""
    data = (text or "").encode().translate(_TABLE)
    at = 0
    while at < len(data):
        end = at + most
        if end < len(data):
            cuts = [cut for cut in (data.find(b" ", end), data.find(_END, end)) if cut >= 0]
            end = min(cuts, default=len(data))
        yield data[at:end].replace(_END, b" " + _END + b" ").split()
        at = end


def _mix(h: np.ndarray, more: np.ndarray) -> np.ndarray:
    h = (h ^ more) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


class Portion:
    """Words of one language as numbers, text after text; 0 ends a piece."""

    def __init__(self, lang: str, begin: list[bytes] | None = None):
        self.lang, self.numbers, self.size = lang, Numbers(), 0
        self.parts: list[np.ndarray] = []
        self.add(begin or [])

    def add(self, words: list[bytes]) -> None:
        self.parts.append(np.fromiter(map(self.numbers.__getitem__, words), np.int32, len(words)))
        self.size += len(words)

    def close(self, within: bool) -> list[bytes]:
        """No more words. Within a text the last ones begin no suffix here, as they lack those that follow; they are returned."""
        ahead = min(DEPTH - 1, self.size) if within else DEPTH - 1
        self.codes = np.concatenate(self.parts if within else [*self.parts, np.zeros(ahead, np.int32)])
        self.starts = len(self.codes) - ahead
        self.words = list(self.numbers)
        return [self.words[k] for k in self.codes[self.starts :]] if within else []

    def hashes(self) -> np.ndarray:
        salt = self.lang.encode() + b"\n"
        found = np.fromiter((xxhash.xxh3_64_intdigest(salt + word) for word in self.words), np.uint64, len(self.words))
        found[0] = 0
        return found

    def suffixes(self, frequent: np.ndarray) -> np.ndarray:
        """Rows of ``DEPTH`` numbers for the suffixes of two words and more, 0 beyond the end; a word that is not ``frequent`` ends a piece."""
        codes = np.where(frequent[self.codes], self.codes, 0)
        first = np.flatnonzero((codes[: self.starts] != 0) & (codes[1 : self.starts + 1] != 0))
        rows = np.empty((len(first), DEPTH), np.int32)
        for k in range(DEPTH):
            rows[:, k] = codes[first + k]
            if k > 1:
                rows[rows[:, k - 1] == 0, k] = 0
        return rows


def bucket_of(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return ((_mix(first, second) >> np.uint64(40)) % np.uint64(BUCKETS)).astype(np.int64)


def _gathered(batches: Iterator[pa.RecordBatch], portion: int) -> Iterator[Portion]:
    """A task's words in portions of bounded size, of one language each."""
    held: dict[str, Portion] = {}
    total = 0
    for batch in batches:
        for text, lang in zip(batch.column(0), batch.column(1), strict=True):
            name = lang.as_py()
            for words in portions(text.as_py(), min(READ, 8 * portion)):
                if total >= portion:
                    begin = held[name].close(within=True) if name in held else []
                    for other, some in held.items():
                        if other != name:
                            some.close(within=False)
                        yield some
                    held, total = {name: Portion(name, begin)}, 0
                held.setdefault(name, Portion(name)).add(words)
                total += len(words)
            if name in held:
                held[name].add([_END])
    for some in held.values():
        some.close(within=False)
        yield some


def count_words(docs: DataFrame, staging: Staging, portion: int = PORTION) -> tuple[DataFrame, np.ndarray]:
    """(lang, word, n) of all words, and how many suffixes of two words and more each bucket has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = {}
        load = np.zeros(BUCKETS, np.int64)

        def rows(lang, words, n):
            columns = [pa.array([lang] * len(words), pa.string()), pa.array(words, pa.string()), pa.array(n, pa.int64())]
            return pa.RecordBatch.from_arrays(columns, ["lang", "word", "n"])

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, found in counts.items():
                pairs = iter(found.items())
                while some := list(islice(pairs, 20_000)):
                    yield rows(lang, [word.decode() for word, _ in some], [n for _, n in some])
            counts.clear()

        for some in _gathered(batches, portion):
            n = np.bincount(some.codes[: some.starts], minlength=len(some.words))
            n[0] = 0
            at = np.flatnonzero(n)
            known = counts.setdefault(some.lang, Counter())
            for k, times in zip(at.tolist(), n[at].tolist(), strict=True):
                known[some.words[k]] += times
            hashed = some.hashes()
            first, second = some.codes[: some.starts], some.codes[1 : some.starts + 1]
            pairs = np.flatnonzero((first != 0) & (second != 0))
            load += np.bincount(bucket_of(hashed[first[pairs]], hashed[second[pairs]]), minlength=BUCKETS)
            if sum(map(len, counts.values())) >= HELD:
                yield from flush()
        yield from flush()
        at = np.flatnonzero(load)
        yield rows(None, [str(k) for k in at], load[at])

    counted = docs.select("text", "lang").mapInArrow(run, COUNTS).groupBy("lang", "word").agg(F.sum("n").alias("n"))
    counted = staging.write(counted, "words")
    # As many rows as buckets at most.
    load = np.zeros(BUCKETS, np.int64)
    for row in counted.where("lang IS NULL").collect():
        load[int(row["word"])] = row["n"]
    return counted.where("lang IS NOT NULL"), load


def frequent_bits(words: DataFrame, least: int) -> np.ndarray:
    """``BITS`` bits: those of words that are frequent in their language are set. A bit that is not set rules words out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(BITS, bool)
        for batch in batches:
            for lang, word in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                bits[xxhash.xxh3_64_intdigest(f"{lang}\n{word}".encode()) % BITS] = True
        packed = np.packbits(bits).view("<i8")
        at = np.flatnonzero(packed)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(packed[at], pa.int64())], ["at", "bits"])

    found = np.zeros(BITS // 64, "<i8")
    parts = words.where(F.col("n") >= least).select("lang", "word").mapInArrow(run, "at long, bits long")
    for row in parts.groupBy("at").agg(F.bit_or("bits").alias("bits")).collect():
        found[row["at"]] = row["bits"]
    return np.unpackbits(found.view(np.uint8)).astype(bool)


def pack(lang: str, words: list[bytes], rows: np.ndarray, weight: np.ndarray, split: np.ndarray, number: np.ndarray) -> bytes:
    """A block of suffixes with just the words that they hold; ``number`` is room for as many numbers as there are words."""
    number[rows] = 1
    number[0] = 0
    used = np.flatnonzero(number)
    number[used] = np.arange(1, len(used) + 1)
    codes = number[rows]
    number[used] = 0
    texts = [lang.encode(), *[words[k] for k in used]]
    sizes = np.fromiter(map(len, texts), "<u4", len(texts))
    width = 2 if len(used) < (1 << 16) - 1 else 4
    heavy = 4 if len(weight) and weight.max() > 255 else 1
    # Column by column, as rows are sorted and columns then compress.
    columns = [codes.T.astype(f"<u{width}").tobytes(), weight.astype(f"<u{heavy}").tobytes(), split.astype(np.uint8).tobytes()]
    block = b"".join([_HEAD.pack(len(texts), len(rows), width, heavy), sizes.tobytes(), *texts, *columns])
    return zstandard.ZstdCompressor(level=1).compress(block)


def unpack(block: bytes) -> tuple[bytes, list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """(lang, words, rows, weight, split) of a block; word 0 is the end of a piece."""
    block = zstandard.ZstdDecompressor().decompress(block)
    many, n, width, heavy = _HEAD.unpack_from(block)
    at = _HEAD.size
    sizes = np.frombuffer(block, "<u4", many, at)
    ends = (at + 4 * many + np.cumsum(sizes, dtype=np.int64)).tolist()
    texts = [block[begin:end] for begin, end in zip([at + 4 * many, *ends], ends, strict=False)]
    at = ends[-1]
    rows = np.frombuffer(block, f"<u{width}", n * DEPTH, at).reshape(DEPTH, n).T
    at += n * DEPTH * width
    weight = np.frombuffer(block, f"<u{heavy}", n, at)
    split = np.frombuffer(block, np.uint8, n, at + heavy * n)
    return texts[0], [_END, *texts[1:]], rows, weight, split


def routed(docs: DataFrame, hot: np.ndarray, bits: np.ndarray, routes: int, portion: int) -> DataFrame:
    """(route, block): the suffixes of two frequent words and more, equal ones of a portion as one."""
    shared = docs.sparkSession.sparkContext.broadcast((np.packbits(hot), np.packbits(bits)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        is_hot, is_frequent = (np.unpackbits(x).astype(bool) for x in shared.value)
        for some in _gathered(batches, portion):
            hashed = some.hashes()
            frequent = is_frequent[(hashed % np.uint64(BITS)).astype(np.int64)]
            frequent[0] = False
            rows = some.suffixes(frequent)
            if not len(rows):
                continue
            pair = _mix(hashed[rows[:, 0]], hashed[rows[:, 1]])
            whole = _mix(_mix(pair, hashed[rows[:, 2]]), hashed[rows[:, 3]])
            split = is_hot[bucket_of(hashed[rows[:, 0]], hashed[rows[:, 1]])]
            route = ((np.where(split, whole, pair) >> np.uint64(8)) % np.uint64(routes)).astype(np.int64)
            order = np.lexsort((whole, rows[:, 1].astype(np.int64) + (rows[:, 0].astype(np.int64) << 32), route))
            rows, route, split = rows[order], route[order], split[order]
            first = np.flatnonzero(np.concatenate([[True], (rows[1:] != rows[:-1]).any(1) | (route[1:] != route[:-1])]))
            weight = np.diff(np.append(first, len(rows)))
            rows, route, split = rows[first], route[first], split[first]
            edges = np.append(np.flatnonzero(np.concatenate([[True], route[1:] != route[:-1]])), len(rows))
            number = np.zeros(len(some.words), np.int64)
            blocks = [pack(some.lang, some.words, rows[a:b], weight[a:b], split[a:b], number) for a, b in zip(edges[:-1], edges[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(route[edges[:-1]], pa.int32()), pa.array(blocks, pa.binary())], ["route", "block"])

    return docs.select("text", "lang").mapInArrow(run, "route int, block binary")


def multikey_quicksort(rows: np.ndarray, weight: np.ndarray, least: int) -> Iterator[tuple[int, int, int]]:
    """(row, depth, count) of every phrase of two words and more, with its first ``depth`` words in ``row``, that has ``least`` suffixes.

    ``rows`` are suffixes as numbers, the language's before the words'; 0 ends a suffix.
    """
    depth_end = rows.shape[1]
    columns = [np.ascontiguousarray(rows[:, k]) for k in range(depth_end)]
    stack = [(np.arange(len(rows), dtype=np.int32 if len(rows) < 1 << 31 else np.int64), 0)]
    while stack:
        pointers, depth = stack.pop()
        if depth == depth_end:
            continue
        keys = columns[depth][pointers]
        while len(keys):
            pivot = keys[len(keys) // 2]
            equal = pointers[keys == pivot]
            count = int(weight[equal].sum())
            if pivot and count >= least:
                if depth >= 2:
                    yield int(equal[0]), depth, count
                stack.append((equal, depth + 1))
            below, above = keys < pivot, keys > pivot
            sides = [(pointers[side], keys[side]) for side in (below, above)]
            # What is too small is abandoned; the smaller side is done at once and the larger one next.
            sides = [side for side in sides if int(weight[side[0]].sum()) >= least]
            if len(sides) == 2:
                sides.sort(key=lambda side: len(side[0]))
                stack.append((sides[1][0], depth))
            pointers, keys = sides[0] if sides else (pointers[:0], keys[:0])


def _partial(rows: np.ndarray, weight: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(row, depth, count) of the pairs and triples of suffixes that were dealt by all their words."""
    for depth in (2, 3):
        some = np.flatnonzero(rows[:, depth])
        if len(some):
            order = some[np.lexsort(rows[some, : depth + 1].T)]
            keys = rows[order, : depth + 1]
            first = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]).any(1)]))
            sums = np.add.reduceat(weight[order], first)
            yield from zip(order[first].tolist(), [depth] * len(first), sums.tolist(), strict=True)


def count_routed(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, numbers = Numbers(), Numbers()
        rows, weights, splits = [], [], []
        for batch in batches:
            for block in batch.column(0):
                lang, words, some, weight, split = unpack(block.as_py())
                of = np.fromiter(map(numbers.__getitem__, words), np.int32, len(words))
                # A byte before the name keeps it from being an end.
                rows.append(np.column_stack([np.full(len(some), langs[b"=" + lang], np.int32), of[some]]))
                weights.append(weight.astype(np.int64))
                splits.append(split.astype(bool))
        if not rows:
            return
        matrix, weight, split = np.concatenate(rows), np.concatenate(weights), np.concatenate(splits)
        rows.clear()
        lang_texts, texts = ["", *[x[1:].decode() for x in list(langs)[1:]]], list(numbers)

        def batch_of(found: list[tuple[int, int, int]]) -> pa.RecordBatch:
            phrases = [b" ".join(texts[c] for c in matrix[row, 1 : depth + 1]).decode() for row, depth, _ in found]
            columns = [
                pa.array([lang_texts[matrix[row, 0]] for row, _, _ in found], pa.string()),
                pa.array(phrases, pa.string()),
                pa.array([depth for _, depth, _ in found], pa.int32()),
                pa.array([count for _, _, count in found], pa.int64()),
            ]
            return pa.RecordBatch.from_arrays(columns, ["lang", "phrase", "words", "n"])

        def results() -> Iterator[tuple[int, int, int]]:
            whole = np.flatnonzero(~split)
            for row, depth, count in multikey_quicksort(matrix[whole], weight[whole], least):
                yield int(whole[row]), depth, count
            dealt = np.flatnonzero(split)
            for row, depth, count in _partial(matrix[dealt], weight[dealt]):
                yield int(dealt[row]), depth, count
            for row, depth, count in multikey_quicksort(matrix[dealt], weight[dealt], least):
                if depth == DEPTH:
                    yield int(dealt[row]), depth, count

        found = []
        for one in results():
            found.append(one)
            if len(found) >= 20_000:
                yield batch_of(found)
                found = []
        yield batch_of(found)

    return run


def frequent_phrases(
    docs: DataFrame, staging: Staging, least: int, *, hot: int = HOT, task: int = TASK, portion: int = PORTION
) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, words, n) of the phrases of 1 to ``DEPTH`` words found ``least`` times, and (lang, n) of all words."""
    docs = docs.select("text", F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"))
    words, load = count_words(docs, staging, portion)
    routes = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-int(load.sum()) // task))
    # Bits and hot buckets are of fixed size, whatever the corpus is.
    blocks = routed(docs, load > hot, frequent_bits(words, least), routes, portion).repartitionById(routes, "route")
    parts = staging.write(blocks.select("block").mapInArrow(count_routed(least), "lang string, phrase string, words int, n long"), "counted")
    longer = parts.groupBy("lang", "phrase", "words").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    single = words.where(F.col("n") >= least).select("lang", F.col("word").alias("phrase"), F.lit(1).alias("words"), "n")
    return staging.write(longer.unionByName(single), "phrases"), words.groupBy("lang").agg(F.sum("n").alias("n"))


def scored(phrases: DataFrame) -> DataFrame:
    """(lang, phrase, words, a, l, r, score): every phrase of two words and more with its lowest-scoring cut."""
    part = lambda begin, many: F.array_join(F.slice("_words", begin, many), " ")
    longer = phrases.where("words > 1").withColumn("_words", F.split("phrase", " "))
    cut = longer.select("lang", "phrase", "words", F.col("n").alias("a"), "_words", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    sides = cut.select("lang", "phrase", "words", "a", "k", part(F.lit(1), F.col("k")).alias("left"), part(F.col("k") + 1, F.col("words") - F.col("k")).alias("right"))
    known = lambda side, n: phrases.select("lang", F.col("phrase").alias(side), F.col("n").alias(n))
    both = sides.join(known("left", "l"), ["lang", "left"]).join(known("right", "r"), ["lang", "right"])
    score = F.expr("CAST((CAST(a AS DECIMAL(20,0)) * CAST(2000000 AS DECIMAL(7,0))) div (CAST(l AS DECIMAL(19,0)) + CAST(r AS DECIMAL(19,0))) AS LONG)")
    lowest = both.withColumn("score", score).groupBy("lang", "phrase", "words", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    return lowest.select("lang", "phrase", "words", "a", "cut.l", "cut.r", "cut.score")


def without_contained(found: DataFrame, percent: int) -> DataFrame:
    """Drop phrases that a longer one holds in most of their places."""
    words = F.split("phrase", " ")
    longer = found.where("words > 2").select("lang", "a", "words", words.alias("_w"))
    spans = F.flatten(
        F.transform(
            F.sequence(F.lit(2), F.col("words") - 1),
            lambda many: F.transform(F.sequence(F.lit(1), F.col("words") - many + 1), lambda at: F.array_join(F.slice("_w", at, many), " ")),
        )
    )
    inner = longer.select("lang", "a", F.explode(spans).alias("phrase")).groupBy("lang", "phrase").agg(F.max("a").alias("_most"))
    much = 100 * F.col("_most").cast("decimal(20,0)") >= percent * F.col("a").cast("decimal(20,0)")
    return found.join(inner, ["lang", "phrase"], "left").where(~F.coalesce(much, F.lit(False))).drop("_most")


def collocations(
    docs: DataFrame, staging: Staging, *, least: int = 30, percent: int = 80, top: int = 2000, hot: int = HOT, task: int = TASK, portion: int = PORTION
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first ``top`` phrases of each language."""
    phrases, totals = frequent_phrases(docs, staging, least, hot=hot, task=task, portion=portion)
    found = staging.write(scored(phrases), "scored")
    kept = without_contained(found, percent)
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    shares = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = kept.withColumn("_share", F.pmod(F.xxhash64("phrase"), F.lit(shares))).repartition("lang", "_share")
    ranked = dealt.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "_share").orderBy(*order))).where(F.col("rank") <= top)
    ranked = ranked.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
