"""Token ids of whole texts by a vocabulary file, with a cache of pieces in each Python worker.

The tokenizers library encodes every pre-split piece of a text by itself, and texts repeat their
pieces. For texts of plain Latin characters, where the library's normalisation and splitting are
easily stated, pieces are found by one regular expression and looked up; the library encodes each
piece that the worker hasn't met. All other texts go through the library as they are. The result is
the library's either way; the tests compare it on both kinds.
"""

from __future__ import annotations

import json
import os
import re
from functools import cache

import numpy as np

from citeweave.llm.piece_cache import PieceCache

# Normalisation and splitting of the vocabulary files for which the short way is right.
_NORMALIZER = {
    "type": "Sequence",
    "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}],
}
_SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"

# Characters that NFC keeps, whose lower case is one character, and whose classes are listed here.
_PLAIN = re.compile("[\t\n\r\x20-\x7e\xa1-įı-ſ]*")
_LETTER = "a-zA-Z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ſ"
_NUMBER = "0-9\xb2\xb3\xb9\xbc-\xbe"
_PIECE = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^\t\n\r {_LETTER}{_NUMBER}]+")


def vocabulary_path(name_or_path: str) -> str:
    """A path as it is; a bare file name is one of the public vocabulary files on this machine."""
    if os.path.dirname(name_or_path):
        return name_or_path
    import public_tokenizers

    return public_tokenizers.path(name_or_path)


class WordTokens:
    """``encode`` gives the ids of texts as the tokenizers library does, without added special tokens."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        splits = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        self.short_way = spec.get("normalizer") == _NORMALIZER and splits[0].get("pattern") == {"Regex": _SPLIT}
        self.special = [token["content"] for token in spec.get("added_tokens", [])]
        self.cache = PieceCache(self._learn, room=800_000)

    def _learn(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        # Pieces hold no white space, so a line of them splits into just them again.
        ids, sizes = [], []
        for at in range(0, len(pieces), 1000):
            some = pieces[at : at + 1000]
            found = self.library.encode(" ".join(some), add_special_tokens=False)
            ids.append(np.array(found.ids, np.uint32))
            sizes.append(np.bincount(np.array(found.word_ids, np.int64), minlength=len(some)))
        return np.concatenate(ids), np.concatenate(sizes)

    def pieces(self, text: str) -> list[str] | None:
        """The pieces of a text that can take the short way, else None."""
        if not self.short_way or not _PLAIN.fullmatch(text) or any(special in text for special in self.special):
            return None
        return _PIECE.findall(text.lower())

    def _split(self, texts: list[str]) -> list[list[str] | None]:
        found = [self.pieces(text) for text in texts]
        self.cache.prepare(x for x in found if x is not None)
        return found

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        found = self._split(texts)
        return [self.cache.ids(x) if x is not None else self._whole(text) for text, x in zip(texts, found, strict=True)]

    def count(self, texts: list[str]) -> list[int]:
        found = self._split(texts)
        return [self.cache.size(x) if x is not None else len(self._whole(text)) for text, x in zip(texts, found, strict=True)]

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)


@cache
def word_tokens(name_or_path: str) -> WordTokens:
    """One encoder per vocabulary file and Python worker."""
    return WordTokens(vocabulary_path(name_or_path))

