"""Encoding and decoding by a sentencepiece BPE model, in vectorised merge rounds.

The symbols of all new words of a batch lie in one flat array. Each round finds the best pair of every
word by a segmented minimum of pair ranks, merges it in all words at once, closes the gaps, and takes out
the words that have no pair left. Within a word the leftmost best pair is merged; all its occurrences
are, from the left, where the model shows that no pair which a merge makes could come before the next
occurrence. Words are cut where no piece of the vocabulary has the two characters side by side, so no
merge could cross. Merged words are kept per Python worker, as texts repeat them.

The results are those of the library with ``add_eos`` and no sampling, as the tests show. Models must be
BPE with byte fallback and the identity normaliser. A null text counts as empty and has the end id only.
Texts are encoded whole. Rows that repeat pass one by one, an empty table gives an empty table, and
other columns of the input pass through, those named ``ids`` or ``decoded`` excepted.
"""

from __future__ import annotations

import codecs
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from citeweave.llm.piece_cache import PieceCache, in_portions
from citeweave.llm.word_tokens import vocabulary_path

VOCABULARY = "piece_bpe_32k.model"
SPACE = "▁"
_NONE = np.iinfo(np.int32).max
_SHIFT = 21  # more than the symbols of a model and the code points need

# Each byte that isn't part of a character becomes one replacement character.
codecs.register_error("each-byte", lambda error: ("�" * (error.end - error.start), error.end))


def _fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Numbers and byte fields of a protobuf message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(message):
        field, kind = divmod(number(), 8)
        if kind == 0:
            yield field, number()
        else:
            size = {1: 8, 5: 4}.get(kind) or number()
            yield field, message[at : at + size]
            at += size


def check_model(proto: bytes) -> None:
    """Raise unless the model is of the kind that the merge rounds reproduce."""
    parts = dict(_fields(proto))
    trainer, normalizer = dict(_fields(parts.get(2, b""))), dict(_fields(parts.get(3, b"")))
    # Fixed values of the model format: model_type 2 is BPE; 35 byte fallback, 24 white space as suffix.
    bpe = trainer.get(3) == 2 and trainer.get(35) == 1 and not trainer.get(24)
    plain = not normalizer.get(2) and normalizer.get(3, 1) == 1 and normalizer.get(4, 1) == 0 and normalizer.get(5, 1) == 1
    if not (bpe and plain):
        raise ValueError("needs a BPE model with byte fallback, the identity normaliser and a dummy prefix")


class SentencePieces:
    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        check_model(model.serialized_model_proto())
        self.end, count = model.eos_id(), model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(count)]
        special = [model.is_control(i) or model.is_unknown(i) or model.is_byte(i) for i in range(count)]
        self.byte_ids = np.array([names.index(f"<0x{byte:02X}>") for byte in range(256)])
        known = {name: i for i, name in enumerate(names) if not special[i]}
        # Characters that only occur inside pieces get symbols after the vocabulary, to be spelled as bytes.
        inner = sorted({c for name in known for c in name} - known.keys())
        self.symbols = known | {c: count + i for i, c in enumerate(inner)}
        self.count = count
        self.chars = np.full(0x110000, -1, np.int64)
        for name, i in self.symbols.items():
            if len(name) == 1:
                self.chars[ord(name)] = i
        scores = sorted({model.get_score(i) for i in known.values()}, reverse=True)
        order = {score: i for i, score in enumerate(scores)}
        rank = {i: order[model.get_score(i)] for i in known.values()}
        self._tables(known, rank)
        self.bigrams = np.unique(np.array([ord(a) << _SHIFT | ord(b) for name in known for a, b in zip(name, name[1:], strict=False)], np.int64))
        apart = not any(SPACE in name.lstrip(SPACE) for name in known)
        alone = "\n" if not any("\n" in name for name in known) else ""
        self.words = re.compile(f"{SPACE}+[^{SPACE}{alone}]*|[^{SPACE}{alone}]+" + (f"|{alone}" if alone else "") if apart else "(?s:.+)")
        self.surface = [b"" if model.is_control(i) else name.replace(SPACE, " ").encode() for i, name in enumerate(names)]
        self.surface[model.unk_id()] = model.decode([model.unk_id()]).encode()
        for byte, i in enumerate(self.byte_ids):
            self.surface[i] = bytes([byte])
        self.control = np.array([model.is_control(i) for i in range(count)])
        self.spaced = np.array([not special[i] and name.startswith(SPACE) for i, name in enumerate(names)])
        self.cache = PieceCache(self.merge)

    def _tables(self, known: dict[str, int], rank: dict[int, int]) -> None:
        """Ranks and results of all pairs, and whether a rank's pairs may be merged all at once."""
        pairs, shared = [], np.bincount(list(rank.values()))
        self.at_once = shared == 1
        for name, i in known.items():
            for cut in range(1, len(name)):
                left, right = self.symbols.get(name[:cut]), self.symbols.get(name[cut:])
                if left is not None and right is not None:
                    pairs.append((left << _SHIFT | right, rank[i], i))
                    for part in (left, right):
                        if part in rank and rank[i] <= rank[part]:
                            self.at_once[rank[part]] = False
        table = np.array(sorted(pairs), np.int64).reshape(-1, 3)
        self.pair, self.pair_rank, self.pair_to = table[:, 0].copy(), table[:, 1].astype(np.int32), table[:, 2].copy()

    def _look_up(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Place of each pair in the table, -1 for none."""
        key = left << _SHIFT | right
        at = np.minimum(np.searchsorted(self.pair, key), max(len(self.pair) - 1, 0))
        return np.where((left >= 0) & (right >= 0) & (self.pair[at] == key), at, -1) if len(self.pair) else np.full(len(key), -1)

    def _ranks(self, symbol: np.ndarray, word: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Ranks of the pairs that begin at ``at``."""
        after = np.minimum(at + 1, len(symbol) - 1)
        place = self._look_up(symbol[at], symbol[after])
        fits = (place >= 0) & (at + 1 < len(symbol)) & (word[at] == word[after])
        return np.where(fits, self.pair_rank[place] if len(self.pair) else 0, _NONE).astype(np.int32)

    def merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words one after another, and how many each has."""
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        owner = np.repeat(np.arange(len(words)), [len(word) for word in words])
        joins = np.isin(points[:-1] << _SHIFT | points[1:], self.bigrams) & (owner[:-1] == owner[1:])
        word = np.concatenate(([0], np.cumsum(~joins)))
        symbol = self.chars[points]
        # A character without a symbol is remembered as a negative code point.
        symbol = np.where(symbol < 0, -1 - points, symbol)
        place = np.arange(len(points))
        rank = self._ranks(symbol, word, place)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(symbol):
            starts = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            sizes = np.diff(np.append(starts, len(word)))
            best = np.repeat(np.minimum.reduceat(rank, starts), sizes)
            over = best == _NONE
            if over.any():
                done.append((place[over], symbol[over]))
                left = ~over
                symbol, word, place, rank, best = symbol[left], word[left], place[left], rank[left], best[left]
                if not len(symbol):
                    break
            at = np.flatnonzero(rank == best)
            new_word = np.concatenate(([True], word[at[1:]] != word[at[:-1]]))
            new_run = new_word | np.concatenate(([True], at[1:] != at[:-1] + 1))
            run_start = np.maximum.accumulate(np.where(new_run, np.arange(len(at)), 0))
            every_other = (np.arange(len(at)) - run_start) % 2 == 0
            at = at[np.where(self.at_once[best[at]], every_other, new_word)]
            symbol[at] = self.pair_to[self._look_up(symbol[at], symbol[at + 1])]
            kept = np.ones(len(symbol), bool)
            kept[at + 1] = False
            merged = np.zeros(len(symbol), bool)
            merged[at] = True
            symbol, word, place, rank, merged = symbol[kept], word[kept], place[kept], rank[kept], np.flatnonzero(merged[kept])
            changed = np.unique(np.concatenate((merged, merged[merged > 0] - 1)))
            rank[changed] = self._ranks(symbol, word, changed)
        where = np.concatenate([x[0] for x in done]) if done else np.zeros(0, np.int64)
        symbol = np.concatenate([x[1] for x in done]) if done else np.zeros(0, np.int64)
        order = np.argsort(where, kind="stable")
        return self._spell(symbol[order], points[where[order]], owner[where[order]], len(words))

    def _spell(self, symbol: np.ndarray, point: np.ndarray, owner: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
        """Symbols that aren't in the vocabulary as ids of their bytes."""
        odd = np.flatnonzero((symbol < 0) | (symbol >= self.count))
        width = np.ones(len(symbol), np.int64)
        spelled = [self.byte_ids[list(chr(p).encode("utf-8", "replace"))] for p in point[odd].tolist()]
        width[odd] = [len(x) for x in spelled]
        ids = np.repeat(symbol, width)
        begin = np.cumsum(width) - width
        for at, x in zip(begin[odd].tolist(), spelled, strict=True):
            ids[at : at + len(x)] = x
        return ids, np.bincount(np.repeat(owner, width), minlength=words)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text with the end id."""
        found = [self.words.findall(SPACE + text.replace(" ", SPACE)) if text else [] for text in texts]
        self.cache.prepare(found)
        end = np.array([self.end], np.uint32)
        return [np.concatenate((self.cache.ids(words), end)) for words in found]

    def decode(self, ids: np.ndarray) -> str:
        seen = ids[~self.control[ids]]
        text = b"".join(map(self.surface.__getitem__, seen.tolist()))
        if len(seen) and self.spaced[seen[0]]:
            text = text[1:]
        return text.decode("utf-8", "each-byte")


@cache
def sentence_pieces(name_or_path: str) -> SentencePieces:
    """One model per file and Python worker."""
    return SentencePieces(vocabulary_path(name_or_path))


def encode_and_decode(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """``docs`` with ``ids`` (array of int, with the end id) and ``decoded`` (the text of the ids)."""
    docs = docs.drop("ids", "decoded")
    names, text_at = docs.columns, docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sentence_pieces(vocabulary)
        for batch in batches:
            at = 0
            for portion in in_portions([text or "" for text in batch.column(text_at).to_pylist()]):
                found = model.encode(portion)
                offsets = np.concatenate(([0], np.cumsum([len(ids) for ids in found])))
                ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(found), pa.int32()))
                decoded = pa.array([model.decode(ids) for ids in found], pa.string())
                rows = batch.slice(at, len(portion))
                at += len(portion)
                yield pa.RecordBatch.from_arrays([*rows.columns, ids, decoded], [*names, "ids", "decoded"])

    added = T.StructType.fromDDL("ids array<int>, decoded string")
    return docs.mapInArrow(run, T.StructType(docs.schema.fields + added.fields))
