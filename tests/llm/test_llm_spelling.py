"""Spelling variants against comparing all words, and the count of words against a plain loop."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from citeweave.llm import registered, spelling

SF = "/root/testdata/sf0.001"


def plain_words(docs):
    found = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 6 and n >= 5}


def distance_one(a, b):
    """All edits of ``a`` by one code point, told by deleting one of the longer word or replacing one."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if abs(len(a) - len(b)) != 1:
        return False
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(words):
    by_part = {}
    for w in words:  # near words share one of these parts: the word, or the word without one code point
        for i in range(len(w)):
            by_part.setdefault(w[:i] + w[i + 1 :], set()).add(w)
        by_part.setdefault(w, set()).add(w)
    near = {w: set() for w in words}
    for some in by_part.values():
        for a in some:
            near[a] |= {b for b in some if distance_one(a, b)}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 5 * words[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted((w, form[w], root(w), n, len(near[w]), words.get(form[w])) for w, n in words.items())


def rows(df):
    return sorted(tuple(row) for row in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


def test_query(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = plain_variants(plain_words(docs))
    assert len(want) > 100 and any(row[1] for row in want)
    assert rows(registered.queries()["op11_spelling_variants"](spark, SF)) == want


def test_one_apart():
    draw = random.Random(1)
    words = ["".join(draw.choices("abé", k=draw.randint(1, 6))) for _ in range(250)] + ["x" * 63, "x" * 64, "x" * 65, "x" * 64 + "y"]
    pairs = [(a, b) for a in words for b in words]
    assert [spelling.one_apart(a, b) for a, b in pairs] == [distance_one(a, b) for a, b in pairs]
    short = [(a, b) for a, b in pairs if max(len(a), len(b)) <= 64]
    (x, m), (y, n) = spelling._letters([a for a, _ in short]), spelling._letters([b for _, b in short])
    assert list(spelling.near(x, y, m, n)) == [distance_one(a, b) for a, b in short]


@pytest.mark.parametrize(("subtree", "share"), [(12, 40)])
def test_small_subtrees(frame, staging, subtree, share):
    """Anagrams, very long words, letters beyond ASCII and counts beyond the trie's, with subtrees of a few words."""
    draw = random.Random(subtree)
    words = {"".join(draw.choices("aeqrstàÿ", k=draw.randint(6, 8))) for _ in range(500)}
    base = "a" * 100 + "b" * 30
    words |= {base, base + "a", base[:-1], "c" + base[1:], base[::-1], "d" * 5000, "d" * 5001, "d" * 4999 + "e"}
    words |= {"".join(p) for p in (draw.sample("abcdef", 6) for _ in range(200))}
    words = {w: draw.choice([5, 6, 30, 31, 200, 1000]) for w in sorted(words)}
    texts = [(i, " ".join([w] * n)) for i, (w, n) in enumerate(words.items())]
    want = plain_variants(plain_words(texts))
    found = spelling.spelling_variants(frame(texts, "doc_id long, text string"), staging, subtree=subtree, share=share)
    assert rows(found) == want


def test_odd_rows(frame, staging):
    """Null ids and texts, repeated rows, clashing columns, capitals outside ASCII, no rows at all."""
    docs = [(None, "Garden GARDEN Étages×÷abc"), (1, None), (1, ""), (2, "garden " * 4), (2, "garden " * 4), (3, "étagesŁ gardens " * 5), (3, "gar-den1x")]
    schema = "doc_id long, text string, word string, path string"
    table = frame([(*row, "x", None) for row in docs], schema)
    found = rows(spelling.spelling_variants(table, staging))
    assert found == plain_variants(plain_words(docs)) and len(found) >= 3
    assert rows(spelling.spelling_variants(table.limit(0), staging)) == []


def test_long_text(frame, staging):
    """A text of megabytes and one run of a million letters."""
    text = "garden gardens gaerden " * 60_000 + "z" * 1_000_000
    docs = [(i, text) for i in range(2)]
    assert rows(spelling.spelling_variants(frame(docs, "doc_id long, text string"), staging)) == plain_variants(plain_words(docs))


def test_chain_of_forms(frame, staging):
    chain = [(f"w{i}", f"w{i + 1}") for i in range(20)]
    found = {r["word"]: r["root"] for r in spelling.roots(frame(chain, "word string, form string"), staging).collect()}
    assert found == {f"w{i}": "w20" for i in range(20)}


def test_hot_leaf_is_dealt(spark, staging):
    """Words of one vector beyond a subtree's size are dealt in blocks, and no pair is lost."""
    letters = "abcdefgh"
    draw = random.Random(3)
    half = {"".join(draw.sample(letters, 8)) for _ in range(500)}
    words = sorted(half | {word.replace("a", "q") for word in half})
    table = spark.createDataFrame([(w, 5 + i) for i, w in enumerate(words)], "word string, n long")
    found = {r["word"]: (r["n_near"], r["form"]) for r in spelling.near_words(table, staging, subtree=50, share=100).collect()}
    want = {}
    for w, form, _, _, k, _ in plain_variants({w: 5 + i for i, w in enumerate(words)}):
        if k:
            want[w] = k
    assert {w: k for w, (k, _) in found.items()} == want and len(want) > 50
    assert np.all([distance_one(w, f) for w, (_, f) in found.items()])
    blocks = spark.read.parquet(f"{staging.root}/*-subtrees").agg(F.max("blocks")).first()[0]
    assert blocks > 5
