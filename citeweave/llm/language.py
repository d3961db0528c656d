"""Language identification by multilingual mixtures.

Training counts hashed character n-grams per labelled language over all training documents.
For each document, expectation-maximisation estimates the share of every language from the n-gram
likelihoods; the set of languages is the one with the best likelihood less a penalty for each
language, and the prediction is the largest share in it.

Null texts and texts without a letter are ``und`` with score 0, and so is everything where no
language could be learned. Rows without a label teach nothing. Texts are read whole. Ties go to the
language that sorts first. An empty table gives an empty table. Only ``doc_id``, ``text`` and the
named label columns are looked at. What the driver gathers is ``BUCKETS`` numbers per language,
whatever the size of the corpus.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 1 << 16
ORDERS = (2, 3)
UNKNOWN = "und"
_ROUNDS = 20
_LANGS_AT_ONCE = 64


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def ngrams(text: str | None) -> np.ndarray:
    """Bucket of each n-gram of the lower-cased letters, words set off by single spaces; empty without a letter."""
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[points]
    if not letter.any():
        return np.zeros(0, np.int64)
    before = np.concatenate(([False], letter[:-1]))
    kept = np.where(letter, points, 32)[letter | before].astype(np.uint64)
    kept = np.concatenate(([32], kept, [32])).astype(np.uint64)
    found = []
    for order in ORDERS:
        h = np.full(len(kept) - order + 1, order, np.uint64)
        for k in range(order):
            h = (h ^ kept[k : len(kept) - order + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        found.append((h >> np.uint64(13)) % np.uint64(BUCKETS))
    return np.concatenate(found).astype(np.int64)


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, np.ndarray] = {}

    def flush() -> Iterator[pa.RecordBatch]:
        for lang, n in counts.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(n[at], pa.int64())], ["lang", "bucket", "n"]
            )
        counts.clear()

    for batch in batches:
        for text, lang in zip(batch.column(0), batch.column(1), strict=True):
            grams, lang = ngrams(text.as_py()), lang.as_py()
            if lang not in counts:
                if len(counts) >= _LANGS_AT_ONCE:
                    yield from flush()
                counts[lang] = np.zeros(BUCKETS, np.int64)
            counts[lang] += np.bincount(grams, minlength=BUCKETS)
    yield from flush()


class Mixture:
    """Probabilities of the n-gram buckets per language, and the inference over them."""

    def __init__(self, langs: list[str], counts: np.ndarray):
        self.langs = langs
        smoothed = counts + 0.5
        self.probs = smoothed / smoothed.sum(axis=0, keepdims=True) if langs else smoothed
        self.logs = np.log(self.probs)

    def shares(self, probs: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, float]:
        """Language shares and log likelihood by expectation-maximisation."""
        share, total, last = np.full(probs.shape[1], 1 / probs.shape[1]), n.sum(), -math.inf
        for _ in range(_ROUNDS):
            joint = probs * share
            mass = joint.sum(axis=1)
            fit = float(n @ np.log(mass))
            if fit - last < 1e-3:
                break
            last = fit
            share = (n / mass) @ joint / total
        return share, fit

    def infer(self, text: str | None) -> tuple[str, float, list[str]]:
        """Predicted language, its share, and the selected languages, largest share first."""
        grams = ngrams(text)
        if not len(grams) or not self.langs:
            return UNKNOWN, 0.0, []
        n = np.bincount(grams, minlength=BUCKETS)
        at = np.flatnonzero(n)
        n = n[at].astype(float)
        probs = self.probs[at]
        single = n @ self.logs[at]
        best = int(single.argmax())
        share, fit = self.shares(probs, n)
        # Each n-gram order counts every position once, hence the factor.
        penalty = len(ORDERS) * math.log(n.sum() + 1)
        if len(self.langs) == 1 or fit - single[best] <= penalty:
            return self.langs[best], float(share[best]), [self.langs[best]]
        order = np.argsort(-share, kind="stable")
        chosen, value, its = [best], float(single[best]), np.ones(1)
        for size in range(2, len(order) + 1):
            some, some_fit = self.shares(probs[:, order[:size]], n)
            if some_fit - penalty * (size - 1) <= value:
                break
            chosen, value, its = list(order[:size]), some_fit - penalty * (size - 1), some
        ranked = sorted(zip(its, chosen, strict=True), key=lambda pair: (-pair[0], pair[1]))
        top = int(ranked[0][1])
        return self.langs[top], float(share[top]), [self.langs[k] for _, k in ranked]


def train(labelled: DataFrame) -> Mixture:
    """A mixture model from rows of (text, lang); null languages and null texts teach nothing."""
    rows = labelled.select("text", "lang").where("text IS NOT NULL AND lang IS NOT NULL")
    counts = rows.mapInArrow(_count_batches, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    table = counts.toPandas()
    langs = sorted(table["lang"].unique())
    matrix = np.zeros((BUCKETS, len(langs)))
    matrix[table["bucket"].to_numpy(), table["lang"].map({lang: i for i, lang in enumerate(langs)}).to_numpy(dtype=int)] = table["n"].to_numpy()
    return Mixture(langs, matrix)


def predict(docs: DataFrame, model: Mixture) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``languages``; a column of one of these names is replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = [name for name in docs.columns if name not in ("lang_pred", "score", "languages")]
    text_at = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mixture = shared.value
        for batch in batches:
            found = [mixture.infer(text.as_py()) for text in batch.column(text_at)]
            added = [
                pa.array([x[0] for x in found], pa.string()),
                pa.array([x[1] for x in found], pa.float64()),
                pa.array([x[2] for x in found], pa.list_(pa.string())),
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], [*names, "lang_pred", "score", "languages"])

    kept = docs.select(*names)
    added = T.StructType.fromDDL("lang_pred string, score double, languages array<string>")
    return kept.mapInArrow(run, T.StructType(kept.schema.fields + added.fields))


def with_letters(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text has a letter."""
    text_at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([len(ngrams(text.as_py())) > 0 for text in batch.column(text_at)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def held_out(doc_id: str) -> Column:
    """The test fold: crc32 of the id as text leaves 2 modulo 4. A null id is not in it."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))
