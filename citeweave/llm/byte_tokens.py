"""Ids of whole texts by a byte-level vocabulary file, with the pieces that each Python worker has met.

The tokenizers library splits a text by one pattern and encodes every piece by itself. For texts of plain
Latin characters the pieces are found by the same pattern here, and the library's model encodes each piece that
the worker doesn't know; the first ``room`` pieces stay known, and they are most of what texts are made
of. All other texts, and those that hold a special token's string, go through the library as they are. The result is
the library's either way; the tests compare it on both kinds.
"""

from __future__ import annotations

import json
import os
import re
from functools import cache
from itertools import chain

import numpy as np

from citeweave.llm.word_tokens import _LETTER, _NUMBER, _PLAIN, vocabulary_path

# Fixed value: the pattern by which byte-level vocabularies split, for the characters of _PLAIN.
_PIECE = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[{_NUMBER}]+| ?[^\t\n\r {_LETTER}{_NUMBER}]+|[\t\n\r ]+(?![^\t\n\r ])|[\t\n\r ]+")


class Known(dict):
    """Numbers texts as they come, and holds the ids of each one after another."""

    def __init__(self, room: int):
        super().__init__()
        self.room, self.new = room, []
        self.flat, self.starts = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def __missing__(self, text: str) -> int:
        self[text] = number = len(self)
        self.new.append(text)
        return number

    def learn(self, flat: np.ndarray, sizes: np.ndarray) -> None:
        """The ids of the new texts."""
        self.flat = np.concatenate([self.flat, flat])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])
        self.new = []

    def ids(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the numbered texts one after another, and how many each has."""
        begin, size = self.starts[at], self.starts[at + 1] - self.starts[at]
        out = np.cumsum(size) - size
        return self.flat[np.repeat(begin - out, size) + np.arange(int(size.sum()))], size

    def forget(self) -> None:
        """Texts beyond the room go again, the latest first."""
        if len(self) > self.room:
            for _ in range(len(self) - self.room):
                self.popitem()
            self.starts = self.starts[: self.room + 1].copy()
            self.flat = self.flat[: self.starts[-1]].copy()


class ByteTokens:
    """``encode`` gives the ids of texts as the tokenizers library does, without added special tokens."""

    def __init__(self, path: str, room: int = 800_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        before = spec.get("pre_tokenizer") or {}
        usual = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        self.short_way = spec.get("normalizer") is None and all(before.get(key) == value for key, value in usual.items())
        self.special = [token["content"] for token in spec.get("added_tokens", [])]
        self.size = self.library.get_vocab_size(with_added_tokens=True)
        self.known = Known(room)
        as_letters = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        # The characters of _PLAIN lie below; the first one parts pieces.
        self.letters = {code: as_letters.pre_tokenize_str(chr(code))[0][0] for code in range(1, 0x180)}

    def _encode_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        # Split already, so each piece goes to the library's model alone, its bytes in the letters of the vocabulary.
        spelled = "\0".join(pieces).translate(self.letters).split("\0")
        found = [[token.id for token in self.model.tokenize(piece)] for piece in spelled]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.uint32, int(sizes.sum())), sizes

    def pieces(self, text: str) -> list[str] | None:
        """The pieces of a text that can take the short way, else None."""
        if not self.short_way or not _PLAIN.fullmatch(text) or any(special in text for special in self.special):
            return None
        return _PIECE.findall(text)

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        found = [self.pieces(text) for text in texts]
        split = [x for x in found if x is not None]
        many = np.fromiter(map(len, split), np.int64, len(split))
        at = np.fromiter(map(self.known.__getitem__, chain.from_iterable(split)), np.int64, int(many.sum()))
        if self.known.new:
            self.known.learn(*self._encode_pieces(self.known.new))
        flat, size = self.known.ids(at)
        self.known.forget()
        ends = np.append(0, np.cumsum(size))[np.cumsum(many)]
        of_split = iter(np.split(flat, ends[:-1]))
        return [next(of_split) if x is not None else self._whole(text) for text, x in zip(texts, found, strict=True)]


@cache
def byte_tokens(name_or_path: str) -> ByteTokens:
    """One encoder per vocabulary file and Python worker."""
    return ByteTokens(vocabulary_path(name_or_path))
