"""Near-duplicates, vectors, shards, components and the pipeline against brute force."""

import random
import zlib
from pathlib import Path

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from check import rows_of
from citeweave.llm import components, embedding_dedup, kd_shards, minhash, registered
from citeweave.llm.common import number_within
from citeweave.llm.word_tokens import word_tokens

SF = "/root/testdata/sf0.001"


def roots(nodes, links):
    parent = {node: node for node in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {node: find(node) for node in nodes}


def test_components(frame, staging):
    draw = random.Random(4)
    links = [(draw.randrange(300), draw.randrange(300)) for _ in range(160)] + [(400 + i, 401 + i) for i in range(40)] + [(7, 7), (500, 3), (3, 500)]
    rows = components.component_labels(frame(links + [(None, 4)], "a long, b long"), staging).collect()
    want = roots({x for link in links for x in link}, links)
    assert {r["node"]: r["component"] for r in rows} == {n: c for n, c in want.items() if n != c}
    assert components.component_labels(frame([], "a long, b long"), staging).count() == 0


def shingle_set(text, words):
    found = (text or "").encode().lower().split()
    if len(found) < words:
        return frozenset([tuple(found)]) if found else frozenset()
    return frozenset(tuple(found[i : i + words]) for i in range(len(found) - words + 1))


def near_groups(docs, words, percent):
    """Sizes and smallest ids of components by comparing all pairs."""
    sets = [(d, shingle_set(t, words)) for d, t in docs]
    links = [
        (i, j)
        for i, (_, a) in enumerate(sets)
        for j, (_, b) in enumerate(sets[:i])
        if a and b and 100 * len(a & b) >= percent * len(a | b)
    ]
    of = roots(range(len(docs)), links)
    least = {}
    for i, (d, _) in enumerate(sets):
        known = least.setdefault(of[i], d)
        least[of[i]] = d if known is None else known if d is None else min(known, d)
    return [(d, len(s), least[of[i]]) for i, (d, s) in enumerate(sets)]


def copies(seed=1):
    draw = random.Random(seed)
    word = lambda: "".join(draw.choices("abcdefgh", k=4))
    passage = [word() for _ in range(60)]
    docs = []
    for _ in range(6):
        base = [word() for _ in range(draw.choice([30, 90, 200]))]
        for _ in range(14):
            text = list(base)
            for _ in range(draw.randrange(0, 9)):
                text[draw.randrange(len(text))] = word()
            docs.append(draw.choice(["{}", " {}\n", "{}\t"]).format(" ".join(text)))
    docs += [" ".join([word() for _ in range(50)] + passage) for _ in range(25)]
    docs += [docs[0]] * 20 + [docs[3].upper()] + [None, "", " \n", "one", "ONE", "two words", "a b c d", "A b\tc  d"]
    docs += ["x y z w " * 4000, "x y z w " * 4000 + "end"]
    draw.shuffle(docs)
    return list(enumerate(docs))


@pytest.mark.parametrize("words", [4, 5])
def test_near_duplicates(frame, staging, words):
    docs = copies() + [(5, "an id that comes twice"), (None, "one"), (None, "no id here at all now"), (None, "no id here at all now")]
    df = frame([(d, t, "x", 1) for d, t in docs], "doc_id long, text string, digest string, node int")
    rows = minhash.near_duplicates(df, staging, words=words, percent=80).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows), key=repr) == sorted(near_groups(docs, words, 80), key=repr)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows)


def test_near_duplicates_in_long_lists(frame, staging, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 8)
    docs = copies(seed=3)
    rows = minhash.near_duplicates(frame(docs, "doc_id long, text string"), staging, words=4).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows) == sorted(near_groups(docs, 4, 80))


def test_a_hot_group_makes_few_rows(spark, staging):
    """A third of the rows are copies of one text, another third near copies: pairs stay in proportion to the rows."""
    words = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(99)), lambda i: F.concat(F.lit("w"), i.cast("string"))), " ")
    near = F.concat(words, F.lit(" "), F.col("id").cast("string"))
    other = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(20)), lambda i: F.concat_ws("x", "id", i.cast("string"))), " ")
    text = F.when(F.col("id") % 3 == 0, words).when(F.col("id") % 3 == 1, near).otherwise(other)
    docs = spark.range(1500).select(F.col("id").alias("doc_id"), text.alias("text"))
    rows = minhash.near_duplicates(docs, staging).groupBy("component_id").count().where("count > 1").collect()
    assert [(r["component_id"], r["count"]) for r in rows] == [(0, 1000)]
    sizes = {path.split("-", 1)[1]: spark.read.parquet(f"{staging.root}/{path}").count() for path in staged(staging, ("pivot-pairs", "cross-pairs"))}
    assert sizes["pivot-pairs"] < 5 * 1500 and sizes["cross-pairs"] == 0


def staged(staging, ends):
    files = staging._files.listStatus(staging._folder)
    return [name for f in files if (name := f.getPath().getName()).endswith(ends)]


VECTORS = [(1, [1.0, 0.0, 0.0]), (2, [2.0, 0.0, 0.0]), (3, [0.95, 0.2, 0.0]), (4, None), (5, []), (6, [0.0, 0.0, 0.0]), (7, [1.0, None, 0.0])]
VECTORS += [(8, [float("nan"), 1.0, 0.0]), (9, [float("inf"), 1.0, 0.0]), (10, [1.0]), (11, [0.0, 0.0, 1e-30]), (12, [0.0, 0.0, 1e30]), (12, [0.0, 0.0, 1e30]), (None, [1.0, 0.0, 0.0])]


def test_an_id_with_two_vectors(frame, staging):
    rows = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [0.99, 0.1]), (3, [0.1, 0.99]), (4, [1.0, 0.01]), (5, [-1.0, 0.0])]
    found = embedding_dedup.near_duplicates(frame(rows, "vec_id long, embedding array<double>"), staging).collect()
    got = sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in found)
    assert got == [(1, 1, 1), (1, 2, 1), (2, 2, 1), (3, 1, 1), (4, 2, 1), (5, 0, 5)]


def test_odd_vectors(frame, staging):
    df = frame([(v, e, "x", 3) for v, e in VECTORS], "vec_id long, embedding array<double>, vector string, node int")
    rows = sorted(((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in embedding_dedup.near_duplicates(df, staging).collect()), key=repr)
    linked = [(1, 3, 1, True), (2, 3, 1, False), (3, 3, 1, False), (10, 3, 1, False)]
    alone = [(v, 0, v, True) for v in (4, 5, 6, 7, 8, 9, None)]
    upright = [(11, 2, 11, True), (12, 2, 11, False), (12, 2, 11, False)]
    assert rows == sorted(linked + alone + upright, key=repr)
    assert embedding_dedup.near_duplicates(frame([], "vec_id long, embedding array<float>"), staging).count() == 0


def vectors_of(spark, x):
    return spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")


def all_pairs(x):
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = (unit @ unit.T >= 0.9) & ~np.eye(len(x), dtype=bool)
    return near, roots(range(len(x)), np.argwhere(near).tolist())


@pytest.mark.parametrize("recall", [0.99, 1.0])
def test_vectors_against_all_pairs(spark, staging, monkeypatch, recall):
    """Clusters, copies and single vectors; blocks small enough for areas to be dealt."""
    monkeypatch.setattr(embedding_dedup, "LIST_BLOCK", 32)
    monkeypatch.setattr(embedding_dedup, "QUERY_BLOCK", 64)
    draw = np.random.default_rng(1)
    x = draw.normal(size=(900, 16))
    x[300:600] = x[draw.integers(0, 40, 300)] + 0.16 * draw.normal(size=(300, 16))
    x[600:650] = x[7]
    found = embedding_dedup.near_duplicates(vectors_of(spark, x), staging, recall=recall).collect()
    near, want = all_pairs(x)
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in found}
    exact = sum(got[i] == (near[i].sum(), want[i]) for i in range(len(x)))
    assert exact == len(x) if recall == 1.0 else exact >= 0.98 * len(x)
    # Every pair that was found counts for both its ends, and none that isn't near.
    total = sum(n for n, _ in got.values())
    assert total % 2 == 0 and 0.99 * near.sum() <= total <= near.sum() and all(n <= near[i].sum() for i, (n, _) in got.items())


def spread(kind, n, width=64):
    """Unit vectors: half of them at cosines of 0.9 to 1 to others, or varying in few directions, or in each less than in the one before."""
    draw = np.random.default_rng(5)
    if kind == "isotropic":
        x = draw.normal(size=(n // 2, width))
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        way = draw.normal(size=x.shape)
        way -= (way * x).sum(1, keepdims=True) * x
        cosine = draw.uniform(0.9, 1, (n // 2, 1))
        return np.concatenate([x, cosine * x + np.sqrt(1 - cosine**2) * way / np.linalg.norm(way, axis=1, keepdims=True)])
    x = draw.normal(size=(n, 6)) @ draw.normal(size=(6, width)) if kind == "low-rank" else draw.normal(size=(n, width)) * np.arange(1, width + 1) ** -1.0
    x = x @ np.linalg.qr(draw.normal(size=(width, width)))[0]
    return x / np.linalg.norm(x, axis=1, keepdims=True)


@pytest.mark.parametrize("kind", ["isotropic", "low-rank", "decaying"])
def test_links_found_of_vectors_of_some_kinds(spark, staging, kind):
    x = spread(kind, 1500)
    found = {r["vec_id"]: r["n_links"] for r in embedding_dedup.near_duplicates(vectors_of(spark, x), staging).collect()}
    near, _ = all_pairs(x)
    assert near.sum() > 1000 and all(found[i] <= near[i].sum() for i in found)
    assert sum(found.values()) >= 0.99 * near.sum()


def walk(index, x, asked):
    """Which members each query visits: those of its nearest cells."""
    first, second = index.distances(x)
    i, j = first.argmin(1), second.argmin(1)
    reach = index.reach(first[asked], second[asked], index.visits)
    return first[asked][:, i] + second[asked][:, j] <= reach[:, None]


@pytest.mark.parametrize("kind", ["isotropic", "low-rank", "decaying"])
def test_the_walk_meets_its_recall_and_shortens(spark, kind):
    """Recall of the ids divisible by 20 against all rows, and a share of the rows that falls as these grow."""
    shares = []
    for n in (2_000, 24_000):
        x = spread(kind, n)
        data = [(i, bytes(v.astype("<f8").tobytes())) for i, v in enumerate(x)] if n == 2_000 else None
        sample = x[np.random.default_rng(3).permutation(n)[: embedding_dedup.SAMPLE]]
        index = embedding_dedup.fit(sample, n)
        if data:
            units = spark.createDataFrame(data, "node long, vector binary").select("vector", "node", F.lit(1).alias("weight"), F.lit(0).cast("long").alias("tag"))
            index = embedding_dedup.with_visits(units, index, sample, 0.9, 0.99)
        else:
            index.visits = round(index.cells * 0.03)
        asked = np.arange(0, n, 20)
        visited, near = walk(index, x, asked), x[asked] @ x.T >= 0.9
        near[np.arange(len(asked)), asked] = False
        assert (near & visited).sum() >= 0.95 * near.sum()
        shares.append(visited.mean())
    # Where vectors crowd in few cells, these hold more rows.
    assert shares[1] < shares[0] and shares[1] < (0.05 if kind == "isotropic" else 0.2)


def test_the_nearest_cells(monkeypatch):
    draw = np.random.default_rng(2)
    index = embedding_dedup.fit(draw.normal(size=(400, 9)), 4000)
    first, second = index.distances(draw.normal(size=(50, 9)))
    sums = np.sort((first[:, :, None] + second[:, None, :]).reshape(50, -1), axis=1)
    for n in (1, 2, 7, 60, index.cells - 1):
        reach = index.reach(first, second, n)
        assert ((sums <= reach[:, None]).sum(1) == n).all()
    assert np.isinf(index.reach(first, second, index.cells)).all()
    index.parts = 3
    row, area = index.areas(first, second, index.reach(first, second, 9))
    visits = first[:, :, None] + second[:, None, :] <= index.reach(first, second, 9)[:, None, None]
    i, j = np.divmod(np.arange(index.cells), second.shape[1])
    want = {(r, i[c] * 3 + index.part_of(j[c])) for r, c in np.argwhere(visits.reshape(50, -1))}
    assert set(zip(row.tolist(), area.tolist(), strict=True)) == want and len(row) == len(want)


def test_shards(frame, staging):
    draw = random.Random(6)
    docs = [(i, draw.choice("äbc") * draw.randrange(400), draw.choice(["en", "de", None]), f"s{draw.randrange(5)}") for i in range(600)]
    docs += [(1000 + i, "copy" * 50, "en", f"s{i % 7}") for i in range(300)] + [(5, None, None, None), (None, "x", "fr", ""), (5, None, None, None)]
    df = frame([(*row, 1, "y") for row in docs], "doc_id long, text string, lang string, source string, shard int, size string")
    rows = kd_shards.kd_shards(df, staging, shards=7).toPandas()
    assert len(rows) == len(docs) and set(rows["shard"]) == set(range(7))
    sums = rows.groupby("shard")["size"].sum()
    assert sums.max() < 1.03 * sums.mean() and sums.min() > 0.97 * sums.mean()
    for _, shard in rows.groupby("shard"):
        assert sorted(shard["slot"]) == list(range(len(shard)))
    again = kd_shards.kd_shards(df, staging, shards=7).toPandas()
    order = ["doc_id", "size", "text_crc32", "shard", "slot"]
    assert rows.sort_values(order)[order].reset_index(drop=True).equals(again.sort_values(order)[order].reset_index(drop=True))
    assert kd_shards.kd_shards(frame([], "doc_id long, text string, lang string, source string"), staging).count() == 0
    assert kd_shards.kd_shards(frame([(1, "a", "b", "c")], "doc_id long, text string, lang string, source string"), staging).count() == 1


def test_small_groups_stay_whole(frame, staging):
    docs = [(i, f"text {i // 2} " * 9, "en", f"s{i % 3}") for i in range(2000)]
    rows = kd_shards.kd_shards(frame(docs, "doc_id long, text string, lang string, source string"), staging, shards=5)
    assert rows.groupBy("text_crc32").agg(F.countDistinct("shard").alias("n")).where("n > 1").count() == 0


def test_number_within(spark, staging):
    df = spark.range(1000).select((F.col("id") % 3 == 0).alias("g"), (F.col("id") % 50).alias("v"))
    rows = number_within(df, ["g"], ["v"], "n", staging).toPandas()
    for _, group in rows.groupby("g"):
        assert sorted(group["n"]) == list(range(len(group)))


@pytest.mark.parametrize("name", sorted(registered.oracle_sql()))
def test_query_equals_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "embeddings"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    df = registered.queries()[name](spark, SF)
    result = duck.execute(registered.oracle_sql()[name])
    names = [column[0] for column in result.description]
    assert sorted(df.columns) == sorted(names)
    assert rows_of(df.columns, [tuple(row) for row in df.collect()]) == rows_of(names, result.fetchall())


CONTRACT = {
    "op1_": "vec_id n_links component_id kept",
    "op2_": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
    "op3_": "doc_id size text_crc32 law shard slot grown_shard",
    "op4_": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op5_": "doc_id n_lines n_dropped kept_sha256",
    "op6_": "doc_id held_out lang_pred score",
    "op7_": "doc_id n_shingles component_id kept",
    "op8_": "doc_id n_assign n_access n_hex base_sha256 spans",
    "op9_": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    "op10_": "doc_id n_bytes n_tokens over_limit",
    "op11_": "word form root n n_near form_n",
    "op12_": "doc_id start n_tokens ids_crc32",
    "op13_": "lang rank phrase a l r n score",
}


@pytest.mark.parametrize("name", [name for name in registered.queries() if name not in registered.oracle_sql() and name != "pipeline"])
def test_query_columns(spark, name):
    df = registered.queries()[name](spark, SF)
    assert set(next(v for k, v in CONTRACT.items() if name.startswith(k)).split()) <= set(df.columns)
    # Operator 11 has a row for each word.
    assert "doc_id" not in df.columns or df.count() >= spark.read.parquet(f"{SF}/documents.parquet").count()


def test_pipeline_stage_by_stage(spark, staging):
    """Every stage on what its predecessor kept, against plain versions of its decisions."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = [(9001, None, "en", "s", 0), (9002, "12 34 !", None, "s", 7), (9003, "", "en", None, 0), (9004, "password = hunter2hunter2 and the rest of it", "en", "s", None)]
    docs = staging.write(docs.union(spark.createDataFrame(odd, docs.schema)), "documents")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language_id", "line_dedup", "near_dedup", "secret_scan", "packing"] and corpus_pipeline.ORACLE_SQL is None
    texts = lambda df: sorted((r["doc_id"], r["text"]) for r in df.collect())

    first = staging.write(stages["language_id"](spark, docs, SF), "one")
    assert first.columns == columns
    assert {r["doc_id"] for r in docs.collect()} - {r["doc_id"] for r in first.collect()} == {9001, 9002, 9003}
    assert first.where("lang IS NULL").count() == 0

    from tests.llm.test_llm_text import kept_lines, plain_spans

    second = staging.write(stages["line_dedup"](spark, first, SF), "two")
    want = [(d, t) for d, t in kept_lines(texts(first), 40, 5) if t.strip()]
    assert second.columns == columns and texts(second) == sorted(want)
    assert second.where("n_chars <> char_length(text)").count() == 0

    third = staging.write(stages["near_dedup"](spark, second, SF), "three")
    heads = {d for d, _, c in near_groups(texts(second), 5, 80) if d == c}
    assert third.columns == columns and {r["doc_id"] for r in third.collect()} == heads

    fourth = staging.write(stages["secret_scan"](spark, third, SF), "four")
    assert fourth.columns == columns and fourth.count() == third.count()
    before = dict(texts(third))
    for d, text in texts(fourth):
        assert (text == before[d]) == (not plain_spans(before[d])) and (not plain_spans(before[d]) or "[REDACTED]" in text)
    assert "hunter2hunter2" not in dict(texts(fourth))[9004]

    last = stages["packing"](spark, fourth, SF).collect()
    model = word_tokens("word_bpe_49k.json")
    tokens = {d: len(ids) + 1 for (d, _), ids in zip(texts(fourth), model.encode([t for _, t in texts(fourth)]), strict=True)}
    sums = {}
    for row in last:
        sums[row["doc_id"]] = sums.get(row["doc_id"], 0) + row["length"]
    assert sums == tokens


def test_pipeline_keeps_texts_without_a_learned_language(frame):
    stage = dict(corpus_pipeline.STAGES)["language_id"]
    texts = [(1, "some words"), (2, "12 34 !"), (3, None), (4, ""), (5, "wörter")]
    run = lambda lang: sorted(tuple(r) for r in stage(None, frame([(*row, lang) for row in texts], "doc_id long, text string, lang string"), SF).collect())
    assert run(None) == [(1, "some words", None), (5, "wörter", None)]
    assert run("und") == [(1, "some words", "und"), (5, "wörter", "und")]


def test_pipeline_learns_from_all_labelled_rows(frame):
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 4 == 2)
    rows = [(held, "only this one has a label", "en"), (1000, "another text", None)]
    found = dict(corpus_pipeline.STAGES)["language_id"](None, frame(rows, "doc_id long, text string, lang string"), SF).collect()
    assert sorted((r["doc_id"], r["lang"]) for r in found) == [(held, "en"), (1000, "en")]


def test_pipeline_keeps_one_row_per_group(frame, spark):
    """Repeated and null ids: the decision is the row's."""
    text = [" ".join(f"{name}{i}" for i in range(60)) for name in "abcde"]
    near = text[2] + " more"
    rows = [(1, text[0]), (1, text[0]), (2, text[0])]
    rows += [(None, text[1]), (None, text[1]), (None, text[1] + " more")]
    rows += [(3, text[2]), (4, near), (4, text[3]), (5, text[4]), (5, text[4] + " more"), (5, text[4].upper())]
    rows += [(6, None), (6, None), (None, ""), (None, ""), (7, " ")]
    kept = dict(corpus_pipeline.STAGES)["near_dedup"](spark, frame(rows, "doc_id long, text string"), SF)
    got = sorted(((r["doc_id"], (r["text"] or "").strip()[:1].lower()) for r in kept.collect()), key=repr)
    assert got == sorted([(1, "a"), (None, "b"), (3, "c"), (4, "d"), (5, "e"), (6, ""), (6, ""), (None, ""), (None, ""), (7, "")], key=repr)
    assert kept.columns == ["doc_id", "text"]


def test_pipeline_runs(spark):
    rows = registered.queries()["pipeline"](spark, SF).collect()
    assert sorted(r["sequence_id"] for r in rows) == list(range(len(rows)))


def test_nothing_else_imports_the_subpackage():
    root = Path(corpus_pipeline.__file__).parent
    for path in root.rglob("*.py"):
        inside = path.is_relative_to(root / "citeweave/llm") or path.is_relative_to(root / "tests/llm")
        if not inside and path.name not in ("__spark_entry__.py", "corpus_pipeline.py"):
            assert "citeweave.llm" not in path.read_text() and "corpus_pipeline" not in path.read_text(), path
