"""Vectorised word hashing over Arrow string columns.

Words are maximal runs of bytes other than space and 0x09-0x0D.  Hashes are
polynomials over whole byte or word sequences modulo 2^64 with mixed
coefficients, computed for a block of texts at once with prefix sums.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 19

_U = np.uint64
_BYTE_BASE = 0x9E3779B97F4A7C15 | 1
_WORD_BASE = 0xD6E8FEB86659FD93 | 1

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit mixer (xor-shift-multiply rounds)."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


_TABLE = mix64(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15))
_LOWER_TABLE = _TABLE.copy()
_LOWER_TABLE[65:91] = _TABLE[97:123]


class Powers:
    """Powers of an odd base and of its inverse modulo 2^64, grown on demand."""

    def __init__(self, base: int):
        self._base, self._inv = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, _U)

    def need(self, n: int) -> Powers:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up), 1 << 16)
            for name, b in (("up", self._base), ("down", self._inv)):
                steps = np.full(size, b, _U)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))
        return self


_BYTES, _WORDS = Powers(_BYTE_BASE), Powers(_WORD_BASE)


@dataclass
class WordBlock:
    """Words of a block of texts: hash, byte span, and the word range of each
    text (``first`` has one entry more than there are texts)."""

    data: np.ndarray
    hashes: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def run_hashes(self, at: np.ndarray, length) -> np.ndarray:
        """Hash of ``length`` words from word ``at`` on."""
        n = len(self.hashes)
        power = _WORDS.need(n + 1)
        if not hasattr(self, "_sums"):
            self._sums = np.zeros(n + 1, _U)
            np.cumsum(self.hashes * power.up[:n], out=self._sums[1:])
        raw = (self._sums[at + length] - self._sums[at]) * power.down[at]
        return mix64(raw ^ (np.asarray(length).astype(_U) * _U(0xA24BAED4963EE407)))


def text_blocks(texts: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """(first row, slice) pieces of about ``limit`` bytes; a text is never cut."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    if not pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.large_string())
    n = len(texts)
    if n == 0:
        return
    off = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + n + 1]
    at = 0
    while at < n:
        to = int(np.searchsorted(off, off[at] + limit, "right")) - 1
        to = min(n, max(to, at + 1))
        yield at, texts.slice(at, to - at)
        at = to


def raw_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets from 0) of a large_string array without nulls."""
    n = len(texts)
    off = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + n + 1]
    buf = texts.buffers()[2]
    data = np.frombuffer(buf, np.uint8) if buf is not None else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def words_of(texts: pa.Array, lower: bool = False) -> WordBlock:
    """Split and hash a block; ``lower`` folds A-Z."""
    data, off = raw_bytes(texts)
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return WordBlock(data, np.zeros(0, _U), z, z, np.zeros(len(off), np.int64))
    solid = ~_SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[off] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = solid[:-1]
    start = np.flatnonzero(solid & (~before | edge[:n]))
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = solid[1:]
    end = np.flatnonzero(solid & (~after | edge[1:])) + 1
    power = _BYTES.need(n + 1)
    sums = np.zeros(n + 1, _U)
    np.cumsum((_LOWER_TABLE if lower else _TABLE)[data] * power.up[:n], out=sums[1:])
    raw = (sums[end] - sums[start]) * power.down[start]
    hashes = mix64(raw ^ ((end - start).astype(_U) * _U(0xA24BAED4963EE407)))
    return WordBlock(data, hashes, start, end, np.searchsorted(start, off))


def shingle_sets(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``width``-word shingles of each lower-cased text as sorted
    hashes, end to end, and their offsets.  Texts with fewer words have their
    whole sequence as the one shingle; texts without words have none."""
    block = words_of(texts, lower=True)
    count = np.diff(block.first)
    n_sh = np.where(count >= width, count - width + 1, np.minimum(count, 1))
    off = np.concatenate(([0], np.cumsum(n_sh)))
    at = np.repeat(block.first[:-1] - off[:-1], n_sh) + np.arange(off[-1])
    length = np.repeat(np.minimum(count, width), n_sh)
    hashes = block.run_hashes(at, length) if len(at) else np.zeros(0, _U)
    parts = [np.unique(hashes[a:b]) for a, b in zip(off[:-1], off[1:], strict=True)]
    sizes = np.array([len(p) for p in parts], np.int64)
    return (np.concatenate(parts) if parts else hashes), np.concatenate(([0], np.cumsum(sizes)))
