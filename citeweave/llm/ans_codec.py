"""A static range asymmetric numeral system over token ids, in arrays.

A block's ids are dealt over ``LANES`` interleaved coders: id ``i`` goes to lane ``i % LANES``. All blocks
share one frequency table, whose frequencies add up to ``1 << SCALE``. A coder's state has 63 bits and
passes on 32 at a time; the words of all lanes of a block are one stream, in the order in which a decoder
asks for them. Every ``STRIDE`` steps a checkpoint keeps the states and the place in the stream, so each
segment between checkpoints can be decoded alone; many blocks are encoded, and many segments decoded, side by
side. Each segment has a CRC of its ids, and the whole payload one of its bytes.

Layout, little-endian: the header (magic, version, lanes, scale, ids, ids in a block, steps in a segment, segments,
words, CRC of all that follows), then for each segment its first word (64 bits), its CRC (32) and its lanes' states
(64 each), then the words (32 each). The last step of the last block is filled up with the most frequent id.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

SCALE = 20
LANES = 64
STEPS = 2048  # in a block
STRIDE = 512  # in a segment
BLOCK = LANES * STEPS
_LOW = np.uint64(1 << 31)
_WORD = np.uint64(32)
_SHIFT = np.uint64(SCALE)
_SLOTS = np.uint64((1 << SCALE) - 1)
_LIMIT = np.uint64(31 - SCALE + 32)
_HEADER = struct.Struct("<4sHHHQIIIQI")
_MAGIC, _VERSION = b"rANS", 1


class Corrupt(ValueError):
    """A payload whose checksum, layout or decoded ids are wrong."""


def scaled(counts: np.ndarray) -> np.ndarray:
    """Frequencies that add up to ``1 << SCALE``, at least 1 for every id that occurs."""
    room = 1 << SCALE
    seen = counts > 0
    if seen.sum() > room:
        raise ValueError(f"more than {room} different ids")
    if not seen.any():
        return np.zeros(len(counts), np.int64)
    freq = np.where(seen, np.maximum(1, np.floor(counts / counts.sum() * room)), 0).astype(np.int64)
    excess = int(freq.sum()) - room
    for at in np.argsort(-freq, kind="stable"):
        change = min(excess, int(freq[at]) - 1)
        freq[at] -= change
        excess -= change
        if excess <= 0:
            break
    return freq


class Table:
    """Frequencies, where each id's slots begin, and the id of each slot."""

    def __init__(self, ids: np.ndarray, freq: np.ndarray):
        order = np.argsort(ids, kind="stable")
        ids, freq = np.asarray(ids, np.int64)[order], np.asarray(freq, np.int64)[order]
        if len(ids) and (freq.sum() != 1 << SCALE or (freq < 1).any()):
            raise Corrupt("frequencies do not add up")
        size = int(ids.max()) + 1 if len(ids) else 1
        self.freq, self.start = np.zeros(size, np.uint64), np.zeros(size, np.uint64)
        self.freq[ids] = freq
        self.start[ids] = np.cumsum(freq) - freq
        self.id_of = np.repeat(ids.astype(np.uint32), freq)
        self.filler = int(ids[freq.argmax()]) if len(ids) else 0


def _encode_blocks(grid: np.ndarray, table: Table) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """Words of all blocks one after another, and for each block its segments' first words and states.

    ``grid`` has the shape (blocks, steps, lanes).
    """
    blocks, steps, lanes = grid.shape
    x = np.full((blocks, lanes), _LOW)
    words, asked = np.zeros((steps, blocks, lanes), np.uint32), np.zeros((steps, blocks, lanes), bool)
    states = np.zeros((-(-steps // STRIDE), blocks, lanes), np.uint64)
    for t in range(steps - 1, -1, -1):
        ids = grid[:, t]
        freq = table.freq[ids]
        full = x >= freq << _LIMIT
        words[t], asked[t] = x.astype(np.uint32), full
        x = np.where(full, x >> _WORD, x)
        times = x // freq
        x = (times << _SHIFT) + (x - times * freq) + table.start[ids]
        if t % STRIDE == 0:
            states[t // STRIDE] = x
    many = asked.sum(2)
    first = np.cumsum(many, axis=0) - many
    stream = words.transpose(1, 0, 2)[asked.transpose(1, 0, 2)]
    return stream, list(first[::STRIDE].T), list(states.transpose(1, 0, 2)), many.sum(0)


def encode(ids: np.ndarray, table: Table) -> bytes:
    """The payload of one run of ids."""
    ids = np.asarray(ids, np.int64)
    n, whole = len(ids), len(ids) // BLOCK * BLOCK
    steps = -(-(n - whole) // LANES)
    rest = np.concatenate([ids[whole:], np.full(steps * LANES - (n - whole), table.filler, np.int64)])
    if n and (ids.min() < 0 or ids.max() >= len(table.freq) or not table.freq[ids].all()):
        raise ValueError("an id is not in the frequency table")
    streams, firsts, states, base = [], [], [], 0
    for part, height in ((ids[:whole], STEPS), (rest, steps)):
        if len(part):
            stream, first, state, sizes = _encode_blocks(part.reshape(-1, height, LANES), table)
            for f, s, size in zip(first, state, sizes, strict=True):
                firsts.append(f + base)
                states.append(s)
                base += int(size)
            streams.append(stream)
    padded = np.concatenate([ids[:whole], rest]).astype("<u4")
    # Blocks are whole numbers of segments, so segments are equal runs of the padded ids.
    crcs = [zlib.crc32(padded[i : i + STRIDE * LANES].tobytes()) for i in range(0, len(padded), STRIDE * LANES)]
    join = lambda parts, kind: np.concatenate(parts).astype(kind).tobytes() if parts else b""
    body = join(firsts, "<u8") + np.array(crcs, "<u4").tobytes() + join([s.reshape(-1) for s in states], "<u8") + join(streams, "<u4")
    return _HEADER.pack(_MAGIC, _VERSION, LANES, SCALE, n, BLOCK, STRIDE, len(crcs), base, zlib.crc32(body)) + body


def _decode_segments(stream: np.ndarray, at: np.ndarray, x: np.ndarray, steps: int, table: Table) -> np.ndarray:
    """Ids of segments of equal height, in the shape (segments, steps, lanes)."""
    out = np.zeros((len(x), steps, x.shape[1]), np.uint32)
    for t in range(steps):
        slot = x & _SLOTS
        ids = table.id_of[slot]
        out[:, t] = ids
        x = table.freq[ids] * (x >> _SHIFT) + slot - table.start[ids]
        low = x < _LOW
        order = np.cumsum(low, axis=1)
        word = stream[np.minimum(at[:, None] + order - 1, len(stream) - 1)]
        x = np.where(low, (x << _WORD) | word, x)
        at = at + order[:, -1]
    return out


def decode(payload: bytes, table: Table, begin: int = 0, end: int | None = None) -> np.ndarray:
    """The ids from ``begin`` up to ``end``; only the segments that hold them are decoded."""
    try:
        magic, version, lanes, scale, n, block, stride, segments, words, crc = _HEADER.unpack_from(payload)
    except struct.error as error:
        raise Corrupt("no header") from error
    if (magic, version, lanes, scale, block, stride) != (_MAGIC, _VERSION, LANES, SCALE, BLOCK, STRIDE):
        raise Corrupt("not a payload of this layout")
    body = memoryview(payload)[_HEADER.size :]
    if zlib.crc32(body) != crc or len(body) != segments * (12 + 8 * lanes) + 4 * words:
        raise Corrupt("the payload's checksum is wrong")
    end = n if end is None else min(end, n)
    if begin >= end:
        return np.zeros(0, np.uint32)
    first = np.frombuffer(body, "<u8", segments).astype(np.int64)
    crcs = np.frombuffer(body, "<u4", segments, 8 * segments)
    states = np.frombuffer(body, "<u8", segments * lanes, 12 * segments).reshape(segments, lanes).astype(np.uint64)
    # One word more, so that a lane that asks for none can point somewhere.
    stream = np.append(np.frombuffer(body, "<u4", words, segments * (12 + 8 * lanes)), 0).astype(np.uint64)
    wide = stride * lanes
    low, high = begin // wide, -(-end // wide)
    last = -(-n // lanes) - (segments - 1) * stride  # steps of the last segment
    wanted = np.arange(low, high)
    parts = []
    for some, steps in ((wanted[wanted < segments - 1], stride), (wanted[wanted == segments - 1], last)):
        if len(some):
            parts.append(_decode_segments(stream, first[some], states[some], steps, table).reshape(-1))
    ids = np.concatenate(parts)
    for k, at in zip(wanted, range(0, len(ids), wide), strict=True):
        if zlib.crc32(ids[at : at + wide].astype("<u4").tobytes()) != crcs[k]:
            raise Corrupt(f"segment {k} decodes to other ids")
    return ids[begin - low * wide : end - low * wide]
