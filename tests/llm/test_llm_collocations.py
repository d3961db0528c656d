"""Collocations against counting every phrase, and their parts against plain versions."""

import random
import re
from collections import Counter

import duckdb
import numpy as np

from check import rows_of
from citeweave.llm import collocations as col
from citeweave.llm import registered

SF = "/root/testdata/sf0.001"


def plain(docs, least=30, top=2000):
    f, total = Counter(), Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n-\r]", text):
            words = re.findall("[^ \t]+", piece)
            total[lang] += len(words)
            for size in (1, 2, 3, 4):
                f.update((lang, *words[i : i + size]) for i in range(len(words) - size + 1))
    found = {}
    for (lang, *words), a in f.items():
        if len(words) > 1 and a >= least:
            cuts = []
            for k in range(1, len(words)):
                l, r = f[(lang, *words[:k])], f[(lang, *words[k:])]
                cuts.append((2_000_000 * a // (l + r), k, l, r))
            found[(lang, *words)] = (a, *min(cuts))
    most = Counter()
    for (lang, *words), (a, *_) in found.items():
        for size in range(2, len(words)):
            for i in range(len(words) - size + 1):
                key = (lang, *words[i : i + size])
                most[key] = max(most[key], a)
    kept = {}
    for key, (a, score, _, l, r) in found.items():
        if 100 * most[key] < 80 * a:
            kept.setdefault(key[0], []).append((-score, -a, " ".join(key[1:]).encode(), l, r))
    return sorted(
        (lang, rank, phrase.decode(), -a, l, r, total[lang], -score)
        for lang, some in kept.items()
        for rank, (score, a, phrase, l, r) in enumerate(sorted(some)[:top], 1)
    )


def rows(df):
    return sorted(tuple(row) for row in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def test_query_and_sql(spark):
    docs = [(r["text"], r["lang"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = plain(docs)
    assert len(want) > 20
    df = registered.queries()["op13_collocations"](spark, SF)
    assert rows(df) == want
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    result = duck.execute(registered.oracle_sql()["op13_collocations"])
    names = [column[0] for column in result.description]
    assert sorted(names) == sorted(df.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(names, result.fetchall())


def test_small_parts(frame, staging):
    """Hot buckets, many tasks and small portions give what one portion gives; ties, copies and odd rows."""
    draw = random.Random(8)
    words = ["a", "b", "C", "dé", "e\xa0f", "g'h", "\x85", "k", "ß", "Éa"]
    gaps = [" ", "  ", "\t", ", ", ".", "\n", "\r\n", "; "]
    texts = ["".join(draw.choice(words) + draw.choices(gaps, [9, 1, 1, 1, 1, 1, 1, 1])[0] for _ in range(draw.randint(0, 120))) for _ in range(200)]
    docs = [(text, draw.choice(["en", "fr", None, "", "und"])) for text in texts] + [(None, "en"), ("", None), (" .;", "x"), (texts[0], "en"), (texts[0], "en")]
    docs += [("Hot pair " + draw.choice(words) + " " + draw.choice(words), "en") for _ in range(300)]
    table = frame([(i, *row, 7, "x") for i, row in enumerate(docs)], "doc_id long, text string, lang string, n long, phrase string")
    want = plain(docs, least=4, top=25)
    assert len({row[0] for row in want}) >= 4
    for hot, task, portion in ((1 << 19, 1 << 20, 1 << 20), (40, 500, 300), (0, 100, 50)):
        assert rows(col.collocations(table, staging, least=4, top=25, hot=hot, task=task, portion=portion)) == want
    assert rows(col.collocations(table.limit(0), staging)) == []


def test_long_text(frame, staging):
    """A text of megabytes without an end of a piece, and one word of a million letters."""
    text = "alpha beta gamma delta " * 100_000 + "x" * 1_000_000 + " alpha beta"
    docs = [(text, "en"), ("alpha beta, beta " * 10, "en")]
    assert rows(col.collocations(frame(docs, "text string, lang string"), staging)) == plain(docs)


def test_portions_cut_no_word():
    text = "one two. Three\tfour;five  six\n" * 50
    whole = [word for part in col.portions(text) for word in part]
    for most in (1, 2, 7, 100):
        assert [word for part in col.portions(text, most) for word in part] == whole
    assert list(col.portions(None)) == [] and whole[:4] == [b"one", b"two", b"\xff", b"three"]


def test_quicksort_counts():
    draw = np.random.default_rng(5)
    rows_ = np.column_stack([draw.integers(1, 3, 3000), draw.zipf(1.5, (3000, 4)).clip(0, 20)]).astype(np.int32)
    for k in (3, 4):
        rows_[draw.random(3000) < 0.2, k] = 0
    rows_[rows_[:, 3] == 0, 4] = 0
    weight = draw.integers(1, 4, 3000)
    want = Counter()
    for row, w in zip(rows_.tolist(), weight.tolist(), strict=True):
        for depth in (2, 3, 4):
            if row[depth]:
                want[tuple(row[: depth + 1])] += w
    found = {tuple(rows_[row, : depth + 1].tolist()): n for row, depth, n in col.multikey_quicksort(rows_, weight, 12)}
    assert found == {key: n for key, n in want.items() if n >= 12}


def test_blocks_come_back():
    numbers = np.array([[1, 2, 0, 0], [5, 1, 2, 3]], np.int32)
    words = [b"\xff", b"a", b"b", b"c", b"d", "é".encode()]
    for rows_, weight in ((numbers, np.array([1, 2])), (numbers[1:], np.array([70_000]))):
        lang, texts, codes, heavy, split = col.unpack(col.pack("fr", words, rows_, weight, np.ones(len(rows_), bool), np.zeros(6, np.int64)))
        assert lang == b"fr" and [[texts[c] for c in row] for row in codes] == [[words[c] for c in row] for row in rows_]
        assert list(heavy) == list(weight) and split.all()


def test_products_beyond_64_bits(frame):
    """Counts of some 10^13 give exact scores."""
    n = 9_000_000_000_001
    phrases = frame([("en", "a b", 2, n), ("en", "a", 1, n + 2), ("en", "b", 1, 2 * n)], "lang string, phrase string, words int, n long")
    assert [r["score"] for r in col.scored(phrases).collect()] == [2_000_000 * n // (3 * n + 2)]
