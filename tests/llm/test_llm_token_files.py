"""Entropy-coded token files: the codec, exact round trips, and the library's ids."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from citeweave.llm import ans_codec, byte_tokens, registered, token_files

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_50k.json")

TEXTS = [
    None,
    "",
    " ",
    "\n\n",
    "It's a <|endoftext|> don't 'S we'LL  they'd",
    "  two  spaces \t\n tabs\t\tend  ",
    "ΣΑΣ café é x\x85y \xa0z",
    "naïve\tœuvre\n\nŒ ſs Åß ½² 12 345x6 7",
    "日本語 テスト 😀 ⁇",
    "&&& ... !!! 'quoted' (a) [b]\r\nc",
    "word " * 3000,
    "&" * 700 + " " * 50 + "ab" * 900,
    "Eś \x00 \x1c end",
]


def table_of(ids):
    counts = np.bincount(ids)
    at = np.flatnonzero(counts)
    return ans_codec.Table(at, ans_codec.scaled(counts[at]))


@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 32_768, 32_769, ans_codec.BLOCK, ans_codec.BLOCK + 1, 2 * ans_codec.BLOCK + 40_000])
def test_codec_round_trip(n):
    draw = np.random.default_rng(n)
    ids = np.minimum(draw.zipf(1.3, n), 50_000).astype(np.int64)
    table = table_of(ids) if n else ans_codec.Table(np.zeros(0, int), np.zeros(0, int))
    payload = ans_codec.encode(ids, table)
    assert (ans_codec.decode(payload, table) == ids).all() and len(ans_codec.decode(payload, table)) == n
    for begin, end in [(0, 1), (n // 2, n // 2 + 10), (max(n - 3, 0), n), (n // 3, n), (n, n + 5)]:
        assert list(ans_codec.decode(payload, table, begin, end)) == list(ids[begin:end])


def test_codec_size():
    """Close to the entropy of the ids, checkpoints included."""
    draw = np.random.default_rng(2)
    ids = np.minimum(draw.zipf(1.2, 4 * ans_codec.BLOCK), 40_000)
    p = np.bincount(ids)[np.unique(ids)] / len(ids)
    bits = -(p * np.log2(p)).sum() * len(ids)
    assert bits / 8 < len(ans_codec.encode(ids, table_of(ids))) < 1.03 * bits / 8


def test_codec_with_one_id_and_with_very_many():
    for ids in (np.full(200_000, 7), np.random.default_rng(3).permutation(300_000)):
        table = table_of(ids)
        assert (ans_codec.decode(ans_codec.encode(ids, table), table) == ids).all()
    with pytest.raises(ValueError):
        ans_codec.encode(np.array([8]), table_of(np.full(5, 7)))


def test_codec_finds_damage():
    ids = np.random.default_rng(4).integers(0, 500, 100_000)
    table = table_of(ids)
    payload = bytearray(ans_codec.encode(ids, table))
    for at in (2, 40, 500, len(payload) // 2, len(payload) - 1):
        broken = bytes(payload[:at]) + bytes([payload[at] ^ 4]) + bytes(payload[at + 1 :])
        with pytest.raises(ans_codec.Corrupt):
            ans_codec.decode(broken, table)
    with pytest.raises(ans_codec.Corrupt):
        ans_codec.decode(bytes(payload[:10]), table)
    other = table_of(np.concatenate([ids, np.full(5000, 3)]))
    with pytest.raises(ans_codec.Corrupt):
        ans_codec.decode(bytes(payload), other)


def test_frequencies_add_up():
    for counts in ([1], [10**13] + [1] * 60_000, [5, 0, 7], list(range(1, 3000)), [1] * (1 << 20)):
        counts = np.array(counts)
        freq = ans_codec.scaled(counts)
        assert freq.sum() == 1 << ans_codec.SCALE and ((freq > 0) == (counts > 0)).all()
    assert ans_codec.scaled(np.zeros(3, int)).sum() == 0


def test_ids_equal_the_library():
    model = byte_tokens.ByteTokens(PATH)
    draw = random.Random(6)
    parts = ["a", "the", " ", "  ", "\n", "\t", "'s", "'", "é", "½", "12", "3", ".", "!?", "\xa0", "日", "\r\n", "'ll", "A"]
    texts = [text or "" for text in TEXTS] + ["".join(draw.choices(parts, k=draw.choice([1, 3, 20, 90]))) for _ in range(600)]
    want = [model.library.encode(text, add_special_tokens=False).ids for text in texts]
    assert [list(ids) for ids in model.encode(texts)] == want
    small = byte_tokens.ByteTokens(PATH, room=60)
    assert [list(ids) for at in range(0, len(texts), 50) for ids in small.encode(texts[at : at + 50])] == want
    assert len(small.known) == 60 < len(model.known)
    assert small.encode([]) == []


def plain(docs):
    """(doc_id, start, n_tokens, crc) of documents in their order."""
    library, start, found = Tokenizer.from_file(PATH), 0, []
    for doc_id, text in docs:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        found.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return found


def test_query(spark):
    docs = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    found = registered.queries()["op12_token_files"](spark, SF)
    assert sorted(tuple(r) for r in found.select("doc_id", "start", "n_tokens", "ids_crc32").collect()) == plain(docs)


def test_odd_documents(frame, staging):
    """Null ids and texts, rows that repeat an id, many small runs, clashing columns; ids come back as they were."""
    rows = [(i, text, "x", 1) for i, text in enumerate(TEXTS)] + [(4, TEXTS[9], None, None), (4, TEXTS[4], None, None), (None, "no id", None, 2), (-5, "below", "", 3)]
    docs = frame(rows, "doc_id long, text string, payload string, start long")
    folder = staging.path("files")
    token_files.write_ids(docs, folder, staging, run_ids=10)
    found = token_files.read_ids(docs.sparkSession, folder, with_ids=True).collect()
    library = Tokenizer.from_file(PATH)
    want = sorted((-1e9 if d is None else d, [*library.encode(t or "", add_special_tokens=False).ids, 2]) for d, t, _, _ in rows)
    got = sorted((-1e9 if r["doc_id"] is None else r["doc_id"], list(np.frombuffer(r["ids"], "<u4"))) for r in found)
    assert got == want
    start = 0
    for r in sorted(found, key=lambda r: r["start"]):
        assert r["start"] == start and r["ids_crc32"] == zlib.crc32(r["ids"]) and 4 * r["n_tokens"] == len(r["ids"])
        start += r["n_tokens"]
    order = [r["doc_id"] for r in sorted(found, key=lambda r: r["start"])]
    assert order == sorted(order, key=lambda d: (d is not None, d))
    assert docs.sparkSession.read.parquet(f"{folder}/runs").count() > 10


def test_empty_table_and_long_text(frame, staging):
    docs = frame([(1, "many words of a long text, 12 times over. " * 60_000), (2, "z" * 300_000)], "doc_id long, text string")
    for table in (docs, docs.limit(0)):
        folder = staging.path("files")
        token_files.write_ids(table, folder, staging)
        found = token_files.read_ids(docs.sparkSession, folder)
        assert sorted(tuple(r) for r in found.collect()) == plain([tuple(r) for r in table.collect()])


def test_new_pieces_skip_the_splitter_and_get_the_librarys_ids(monkeypatch):
    """Pieces are split already: the model alone encodes them, whatever plain characters they hold."""
    model = byte_tokens.ByteTokens(PATH)
    plain = "".join(chr(code) for code in range(0x180) if byte_tokens._PLAIN.fullmatch(chr(code)))
    texts = [plain, " ".join(plain), "it's \n\n\t 12  naïve\r\n ÿ¡²x", "", "end.\n", " "]
    expected = [x.ids for x in model.library.encode_batch(texts, add_special_tokens=False)]
    monkeypatch.setattr(model, "library", None)
    assert [x.tolist() for x in model.encode(texts)] == expected
