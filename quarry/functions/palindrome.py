"""Palindrome radii of a block of texts, and the Arrow functions built on them.

For every centre ``c`` of a text ``t`` of length ``n``:

* ``odd[c]``  = largest ``r`` with ``t[c-r .. c+r]`` a palindrome;
* ``even[c]`` = largest ``r`` with ``t[c-r+1 .. c+r]`` a palindrome
  (``0``: ``t[c] != t[c+1]``; always ``0`` at ``c = n-1``).

The texts of a block stand in one array of code points with separators that
equal nothing else, and the centres of all of them grow together, one radius a
pass over those still growing.  Prose is done after a few short passes.  Texts
in which a centre still grows after ``PASSES`` are finished by one scan that is
linear whatever the text, so no text costs more than O(n) steps and no radius
more than two numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

PASSES = 64
BLOCK_CHARS = 1 << 19       # of the texts that grow together
CHUNK = 256                 # centres that share one piece of their text
BATCH_BYTES = 4 << 20       # of one emitted batch


def _block_codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the texts with a separator of its own before each text and
    at the end, and the place of each text's first character."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    first = np.cumsum(np.r_[1, sizes + 1])[:-1]
    codes = np.frombuffer(("\0" + "\0".join(texts) + "\0").encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    marks = np.r_[first - 1, len(codes) - 1]
    codes[marks] = -1 - np.arange(len(marks))
    return codes, first


def _grow(codes: np.ndarray, shift: int) -> tuple[np.ndarray, np.ndarray]:
    """Radii after at most PASSES passes and the centres that still grow; with
    ``shift`` 1 the centres lie behind their character."""
    radius = np.zeros(len(codes), np.int32)
    alive = np.flatnonzero(codes >= 0)
    for k in range(1, PASSES + 1):
        alive = alive[codes[alive - k + shift] == codes[alive + k]]
        if not alive.size:
            break
        radius[alive] = k
    return radius, alive


def _linear_radii(codes: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Radii of one text by a scan that mirrors what it knows: it never compares
    a character right of the rightmost palindrome's end twice."""
    n = len(codes)
    found = []
    for shift in (0, 1):
        radius = np.zeros(n, np.int32).tolist()
        centre, end = -1, -1                       # of the palindrome that reaches furthest
        for c in range(n - shift):
            r = 0
            if c < end:
                r = min(radius[2 * centre - c], end - c)
            lo, hi = c - r - 1 + shift, c + r + 1
            while lo >= 0 and hi < n and codes[lo] == codes[hi]:
                lo -= 1
                hi += 1
            radius[c] = r = hi - c - 1
            if c + r > end:
                centre, end = c, c + r
        found.append(np.array(radius, np.int32))
    return found[0], found[1]


def block_radii(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """``(odd, even)`` radius arrays of each text (see module doc)."""
    codes, first = _block_codes(texts)
    odd, open_odd = _grow(codes, 0)
    even, open_even = _grow(codes, 1)
    unfinished = set(np.searchsorted(first, np.r_[open_odd, open_even], side="right") - 1)
    out = []
    for k, (text, at) in enumerate(zip(texts, first, strict=True)):
        if k in unfinished:
            out.append(_linear_radii(codes[at:at + len(text)].tolist()))
        else:
            out.append((odd[at:at + len(text)], even[at:at + len(text)]))
    return out


def radii(text: str) -> tuple[np.ndarray, np.ndarray]:
    """``(odd, even)`` radius arrays of one text."""
    return block_radii([text])[0]


def _blocks(texts: list[str | None]) -> Iterator[tuple[int, list[str]]]:
    """Runs of texts of at most BLOCK_CHARS together (a longer text alone) and
    the place of the first; a NULL text goes as an empty one."""
    lo, chars = 0, 0
    for k, t in enumerate(texts):
        n = len(t) if t else 0
        if k > lo and chars + n > BLOCK_CHARS:
            yield lo, [x or "" for x in texts[lo:k]]
            lo, chars = k, 0
        chars += n
    if lo < len(texts):
        yield lo, [x or "" for x in texts[lo:]]


def _longest(odd: np.ndarray, even: np.ndarray) -> tuple[int, int]:
    if odd.size == 0:
        return 0, 0
    o, e = int(odd.argmax()), int(even.argmax())
    a, b = (o - int(odd[o]), 2 * int(odd[o]) + 1), (e - int(even[e]) + 1, 2 * int(even[e]))
    return a if a[1] > b[1] else b


def longest_span(text: str) -> tuple[int, int]:
    """``(start, length)`` of the longest palindromic substring, 0-based
    start; among equally long ones the earliest."""
    return _longest(*radii(text))


_SPAN = T.StructType([T.StructField("start", T.IntegerType()),
                      T.StructField("len", T.IntegerType())])


@pandas_udf(_SPAN)
def longest_span_udf(texts: pd.Series) -> pd.DataFrame:
    values = [t if isinstance(t, str) else None for t in texts]
    spans = [_longest(*r) for _, block in _blocks(values) for r in block_radii(block)]
    return pd.DataFrame([(None, None) if t is None else s for t, s in zip(values, spans, strict=True)],
                        columns=["start", "len"], dtype="Int32")


def centre_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``mapInArrow`` body over (id, text): rows ``(id, base, off, piece, odd,
    even)`` of CHUNK centres from ``base`` on, with the piece of the text from
    ``off`` on that holds their palindromes and their radii (``even`` is NULL at
    the last character).  Batches are handed over at BATCH_BYTES, so what a text
    gives is never held together, however long its palindromes are."""
    rows: list[tuple] = []
    size = 0

    def batch_of(ids: pa.Array) -> pa.RecordBatch:
        at, base, off, piece, odd, even = zip(*rows, strict=True)
        lists = [pa.ListArray.from_arrays(np.cumsum([0, *map(len, x)]).astype(np.int32), np.concatenate(x)) for x in (odd, even)]
        blank = lists[1].values.to_numpy() < 0
        lists[1] = pa.ListArray.from_arrays(lists[1].offsets, pa.array(lists[1].values.to_numpy(), mask=blank))
        return pa.RecordBatch.from_arrays(
            [ids.take(pa.array(at)), pa.array(base, pa.int32()), pa.array(off, pa.int32()), pa.array(piece, pa.string()), *lists],
            names=["id", "base", "off", "piece", "odd", "even"])

    for batch in batches:
        texts = batch.column(1).to_pylist()
        for at, block in _blocks(texts):
            for k, (text, (odd, even)) in enumerate(zip(block, block_radii(block), strict=True)):
                n = len(text)
                if not n:
                    continue
                even = even.copy()
                even[-1] = -1
                place, starts = np.arange(n), np.arange(0, n, CHUNK)
                lo = np.minimum.reduceat(np.minimum(place - odd, place - even + 1), starts)
                hi = np.maximum.reduceat(np.maximum(place + odd, place + even), starts) + 1
                for c, a, b in zip(starts.tolist(), lo.tolist(), hi.tolist(), strict=True):
                    rows.append((at + k, c, a, text[a:b], odd[c:c + CHUNK], even[c:c + CHUNK]))
                    size += 4 * (b - a) + 8 * CHUNK
                    if size > BATCH_BYTES:
                        yield batch_of(batch.column(0))
                        rows, size = [], 0
        if rows:
            yield batch_of(batch.column(0))
            rows, size = [], 0
