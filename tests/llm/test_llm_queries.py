"""The registered queries that SQL cannot express, on a whole small table, against the libraries and plain versions."""

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from citeweave.llm import registered
from tests.llm.test_llm_groups import near_groups

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    return {row["doc_id"]: row["text"] or "" for row in spark.read.parquet(f"{SF}/documents.parquet").collect()}


@pytest.fixture(scope="module")
def words():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def rows(spark, name):
    return registered.queries()[name](spark, SF).collect()


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_simhash(spark, texts):
    found = {row["doc_id"]: row for row in rows(spark, "op2_simhash")}
    order = sorted(texts, reverse=True)
    bits = lambda a, b: 1 - (int(a, 16) ^ int(b, 16)).bit_count() / 64
    for d, following in zip(order, order[1:] + order[:1], strict=True):
        row, text = found[d], texts[d]
        k = len(text) // 3
        assert (row["n_chars"], row["edited_sha256"]) == (len(text), sha(text[: len(text) - k] + texts[following][:k]))
        assert row["near_edited"] == bits(row["fingerprint"], row["edited_fingerprint"])
        assert row["near_next"] == bits(row["fingerprint"], found[following]["fingerprint"])
        near = [e for e in found if e != d and bits(row["fingerprint"], found[e]["fingerprint"]) >= 1 - 3 / 64]
        assert row["n_links"] == len(near)
        assert row["class_id"] == min(e for e in found if found[e]["fingerprint"] == row["fingerprint"])
    assert np.mean([r["near_edited"] for r in found.values()]) > np.mean([r["near_next"] for r in found.values()]) + 0.15


def test_shards(spark, texts):
    found = rows(spark, "op3_kd_shards")
    assert sorted(row["doc_id"] for row in found) == sorted(texts) and {row["law"] for row in found} == {"bytes"}
    slots = {}
    for row in found:
        data = texts[row["doc_id"]].encode()
        assert (row["size"], row["text_crc32"], row["grown_shard"]) == (len(data) + 16, zlib.crc32(data), None)
        slots.setdefault(row["shard"], []).append(row["slot"])
    assert set(slots) <= set(range(40)) and all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_sentence_pieces(spark, texts):
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    found = {row["doc_id"]: tuple(row) for row in rows(spark, "op4_sentence_pieces")}
    for d, text in texts.items():
        ids = library.encode(text, add_eos=True)
        assert found[d] == (d, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids)))


def test_near_duplicates(spark, texts):
    found = sorted((row["doc_id"], row["n_shingles"], row["component_id"]) for row in rows(spark, "op7_minhash_dedup"))
    assert found == sorted(near_groups(sorted(texts.items()), 4, 80))


def test_packing(spark, texts, words):
    parts = {}
    for row in rows(spark, "op9_packing"):
        parts.setdefault(row["doc_id"], []).append(row)
    assert set(parts) == set(texts)
    for d, text in texts.items():
        ids = np.array([*words.encode(text, add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for row in sorted(parts[d], key=lambda row: row["start"]):
            assert (row["start"], row["doc_tokens"], row["offset"]) == (at, len(ids), 0)
            assert row["ids_crc32"] == zlib.crc32(ids[at : at + row["length"]].tobytes())
            at += row["length"]
        assert at == len(ids)


def test_token_counts(spark, texts, words):
    found = {row["doc_id"]: tuple(row) for row in rows(spark, "op10_token_counts")}
    for d, text in texts.items():
        n = len(words.encode(text, add_special_tokens=False).ids)
        assert found[d] == (d, len(text.encode()), n, n > 2048)


def test_languages(spark):
    langs = {row["doc_id"]: row["lang"] for row in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    found = rows(spark, "op6_language_id")
    assert sum(row["lang_pred"] == langs[row["doc_id"]] for row in found if row["held_out"]) >= 0.95 * sum(row["held_out"] for row in found)
