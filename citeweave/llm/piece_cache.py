"""Ids of text pieces, kept in one flat array per Python worker."""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np


class PieceCache:
    """Maps pieces to runs of ids; ``learn`` encodes the pieces that are new, each by itself.

    Beyond ``room`` pieces the cache starts anew, which bounds memory and changes no result. A call
    of ``prepare`` makes all its pieces known until the next call.
    """

    def __init__(self, learn: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], room: int = 400_000):
        self._learn, self.room = learn, room
        self.numbers: dict[str, int] = {}
        self._forget()

    def _forget(self) -> None:
        self.numbers.clear()
        self.flat = np.zeros(0, np.uint32)
        self.starts = np.zeros(1, np.int64)

    def prepare(self, texts: Iterable[list[str]]) -> None:
        texts = list(texts)
        unknown = set().union(*texts).difference(self.numbers)
        if unknown and len(self.numbers) + len(unknown) > self.room:
            self._forget()
            unknown = set().union(*texts)
        if unknown:
            pieces = sorted(unknown)
            ids, sizes = self._learn(pieces)
            self.numbers.update(zip(pieces, range(len(self.numbers), len(self.numbers) + len(pieces)), strict=True))
            self.flat = np.concatenate([self.flat, ids.astype(np.uint32)])
            self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])

    def _at(self, pieces: list[str]) -> np.ndarray:
        return np.fromiter(map(self.numbers.__getitem__, pieces), np.int64, len(pieces))

    def size(self, pieces: list[str]) -> int:
        at = self._at(pieces)
        return int((self.starts[at + 1] - self.starts[at]).sum())

    def ids(self, pieces: list[str]) -> np.ndarray:
        """The ids of the pieces one after another."""
        at = self._at(pieces)
        begin, size = self.starts[at], self.starts[at + 1] - self.starts[at]
        out = np.cumsum(size) - size
        return self.flat[np.repeat(begin - out, size) + np.arange(int(size.sum()))]


def in_portions(texts: list[str], most_chars: int = 2_000_000) -> list[list[str]]:
    """Texts in runs of bounded size; a text that is longer by itself makes its own run."""
    runs: list[list[str]] = []
    size = 0
    for text in texts:
        if not runs or size + len(text) > most_chars:
            runs.append([])
            size = 0
        runs[-1].append(text)
        size += len(text)
    return runs
