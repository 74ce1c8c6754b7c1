"""SentencePiece encoding by forward filtering and backward sampling.

Every segmentation of a text into pieces has a weight, the product of its
pieces' weights (Zipf shares of their merge ranks, to the power ``alpha``).  The
lattice is filtered forwards, summing the weights of all paths to each place,
and a segmentation is sampled backwards with probability in proportion to its
weight.  The random numbers are hashes of the row key and the place, so a row's
ids do not depend on partitions, batches or retries.

No piece holds a word mark after other characters, so a text's lattice falls
apart at word marks: each distinct unit (word marks and what follows) of a block
of texts is filtered once, and every occurrence is sampled on its own.
Characters without a piece become byte pieces, a literal word mark too, which
keeps decoding lossless.  Null and empty texts have no ids.  Rows that repeat an
id and its text get the same ids, other texts under that id the numbers of the same
key; texts of any length are encoded whole; an empty table gives no rows; other
columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from quarry.llm.runtime import prepare
from quarry.llm.words import Powers, mix64

MARK = 0x2581
_LITERAL = 0x110001    # a word mark that the text itself holds
BLOCK = 1 << 20
_POWERS = Powers(0x9E3779B97F4A7C15 | 1)


@dataclass
class PieceModel:
    """Trie of the pieces as sorted (node, character) keys, and their weights."""

    keys: np.ndarray
    nodes: np.ndarray
    piece: np.ndarray       # by node, -1: none
    log_weight: np.ndarray  # by piece
    byte_weight: float
    first_byte: int
    text: np.ndarray        # bytes of all pieces end to end, marks as spaces
    offset: np.ndarray

    def __post_init__(self):
        # first step of the trie by character (the last entry: none)
        self.root = np.full(_LITERAL + 1, -1, np.int32)
        first = self.keys < 1 << 21
        self.root[self.keys[first]] = self.nodes[first]

    def alone(self, cps: np.ndarray) -> np.ndarray:
        """Characters that are pieces by themselves."""
        node = self.root[cps]
        return (node >= 0) & (self.piece[node] >= 0)


def load_model(path: str | None = None, alpha: float = 1.0) -> PieceModel:
    """Read a piece model file (the driver does; the arrays are broadcast)."""
    import sentencepiece

    if path is None:
        import public_tokenizers
        path = public_tokenizers.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    n = sp.get_piece_size()
    spread = np.log(np.log(n) + 0.5772)
    weight = np.full(n, -np.inf)
    children: dict[tuple[int, int], int] = {}
    piece, raw, first_byte = [-1], [], -1
    for i in range(n):
        name = sp.id_to_piece(i)
        if sp.is_byte(i):
            first_byte = i if first_byte < 0 else first_byte
            raw.append(bytes([i - first_byte]))
            continue
        if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
            raw.append(b"")
            continue
        raw.append(name.replace("▁", " ").encode())
        rank = min(max(-sp.get_score(i), 0.0), float(n))
        weight[i] = -alpha * (np.log(rank + 2.7) + spread)
        node = 0
        for c in map(ord, name):
            if (node, c) not in children:
                children[(node, c)] = len(piece)
                piece.append(-1)
            node = children[(node, c)]
        piece[node] = i
    codes = np.array([(a << 21) | c for a, c in children], np.int64)
    order = np.argsort(codes)
    return PieceModel(codes[order], np.array(list(children.values()), np.int64)[order], np.array(piece, np.int64), weight,
                      -alpha * (np.log(n) + spread), first_byte, np.frombuffer(b"".join(raw), np.uint8),
                      np.concatenate(([0], np.cumsum([len(r) for r in raw]))))


def lattice_edges(model: PieceModel, cps: np.ndarray, end: np.ndarray):
    """(from, to, piece, log weight) of all pieces within units; ``end`` gives
    the unit end of each character.  Byte fallback has piece -1."""
    start = np.arange(len(cps))
    node, at = np.zeros(len(cps), np.int64), start
    found = []
    single = np.zeros(len(cps), bool)
    step = 0
    while len(start):
        if step:
            key = (node << 21) | cps[at]
            i = np.minimum(np.searchsorted(model.keys, key), len(model.keys) - 1)
            ok = model.keys[i] == key
            node = model.nodes[i[ok]]
        else:
            node = model.root[cps].astype(np.int64)
            ok = node >= 0
            node = node[ok]
        start, at = start[ok], at[ok] + 1
        whole = model.piece[node] >= 0
        found.append((start[whole], at[whole], model.piece[node[whole]]))
        if step == 0:
            single[start[whole]] = True
        step += 1
        go = at < end[start]
        start, at, node = start[go], at[go], node[go]
    lone = np.flatnonzero(~single)
    a, b, p = (np.concatenate([f[k] for f in found] + [extra]) for k, extra in enumerate((lone, lone + 1, np.full(len(lone), -1))))
    c = np.where(cps[lone] == _LITERAL, MARK, cps[lone])
    size = 1 + (c > 0x7F) + (c > 0x7FF) + (c > 0xFFFF)
    w = np.concatenate([model.log_weight[p[:len(p) - len(lone)]], model.byte_weight * size])
    return a, b, p, w


def filtered(a, b, p, w, unit_start: np.ndarray, unit_of: np.ndarray):
    """Forward filter.  Edges sorted by end, their running shares among the
    edges with one end, and the first edge and group number of each end.  Ends
    are numbered by character + unit + 1, so that units do not touch."""
    own = unit_of[a]
    head, tail = a + own, b + own
    depth = b - unit_start[own]
    order = np.lexsort((a, tail, depth))
    head, tail, depth, p, w = head[order], tail[order], depth[order], p[order], w[order]
    alpha = np.zeros(len(unit_of) + len(unit_start) + 1)
    share = np.empty(len(head))
    fresh = np.flatnonzero(np.concatenate(([True], tail[1:] != tail[:-1]))) if len(tail) else np.zeros(0, np.int64)
    limits = np.searchsorted(depth, np.arange(1, (depth[-1] if len(depth) else 0) + 2))
    for lo, hi in zip(limits[:-1], limits[1:], strict=True):
        if lo == hi:
            continue
        groups = fresh[np.searchsorted(fresh, lo):np.searchsorted(fresh, hi)] - lo
        v = alpha[head[lo:hi]] + w[lo:hi]
        size = np.diff(np.append(groups, hi - lo))
        top = np.maximum.reduceat(v, groups)
        e = np.exp(v - np.repeat(top, size))
        total = np.add.reduceat(e, groups)
        alpha[tail[lo:hi][groups]] = top + np.log(total)
        share[lo:hi] = e / np.repeat(total, size)
    group = np.zeros(len(alpha), np.int64)
    group[tail[fresh]] = np.arange(len(fresh))
    return head, p, np.cumsum(share), fresh, group


def encode_block(model: PieceModel, texts: list[str], row_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sampled ids of a block of texts end to end, and their offsets."""
    full = [t for t in texts if t]
    rows = np.array([i for i, t in enumerate(texts) if t], np.int64)
    out_off = np.zeros(len(texts) + 1, np.int64)
    if not full:
        return np.zeros(0, np.int32), out_off
    joined = " " + " ".join(full)
    cps = np.frombuffer(joined.encode("utf-32-le"), np.uint32).astype(np.int64)
    cps = np.where(cps == MARK, _LITERAL, np.where(cps == 0x20, MARK, cps))
    doc_at = np.concatenate(([0], np.cumsum([len(t) + 1 for t in full])))[:-1]
    mark = cps == MARK
    begin = mark & ~np.concatenate(([False], mark[:-1]))
    known = model.alone(cps)
    begin |= ~known | ~np.concatenate(([True], known[:-1]))  # byte characters are units of their own
    begin[doc_at] = True
    first = np.flatnonzero(begin)
    size = np.diff(np.append(first, len(cps)))

    # distinct units, by a hash of their characters
    power = _POWERS.need(len(cps) + 1)
    sums = np.zeros(len(cps) + 1, np.uint64)
    np.cumsum(mix64(cps.astype(np.uint64) + np.uint64(1)) * power.up[:len(cps)], out=sums[1:])
    down = power.down
    code = mix64((sums[first + size] - sums[first]) * down[first] ^ (size.astype(np.uint64) << np.uint64(40)))
    which, _ = pd.factorize(code)
    example = np.zeros(which.max() + 1, np.int64)
    example[which[::-1]] = np.arange(len(which))[::-1]
    u_size = size[example]
    u_start = np.concatenate(([0], np.cumsum(u_size)))
    unit_of = np.repeat(np.arange(len(example)), u_size)
    take = np.repeat(first[example] - u_start[:-1], u_size) + np.arange(u_start[-1])
    a, b, p, w = lattice_edges(model, cps[take], u_start[1:][unit_of])
    head, piece, running, fresh, group = filtered(a, b, p, w, u_start[:-1], unit_of)
    last = np.append(fresh[1:], len(head))

    # backward sampling of every occurrence at once
    doc = np.searchsorted(doc_at, first, "right") - 1
    key = mix64(row_keys[rows][doc] ^ mix64((first - doc_at[doc]).astype(np.uint64)))
    root = u_start[:-1][which] + which  # node number of the unit's start
    at, live, steps = root + size, np.arange(len(first)), []
    while len(live):
        g = group[at]
        depth = (at - root[live]).astype(np.uint64)
        r = (mix64(key[live] + depth * np.uint64(0xD1B54A32D192ED03)) >> np.uint64(11)).astype(float) * 2.0 ** -53
        e, goal, stop = fresh[g], g + r, last[g] - 1
        more = np.flatnonzero((running[e] <= goal) & (e < stop))
        while len(more):  # ends have few edges
            e[more] += 1
            more = more[(running[e[more]] <= goal[more]) & (e[more] < stop[more])]
        steps.append((live, e))
        at = head[e]
        go = at > root[live]
        live, at = live[go], at[go]

    count = np.bincount(np.concatenate([s[0] for s in steps]), minlength=len(first))
    place = np.cumsum(count)
    edge = np.empty(place[-1], np.int64)
    for t, (who, e) in enumerate(steps):
        edge[place[who] - 1 - t] = e
    ids = piece[edge]
    owner = np.repeat(np.arange(len(first)), count)
    lone = ids < 0
    width = np.ones(len(ids), np.int64)
    if lone.any():
        c = cps[first[owner[lone]]]  # such a unit is one character
        raw = [chr(MARK if x == _LITERAL else x).encode() for x in c.tolist()]
        width[lone] = [len(x) for x in raw]
        spread = np.repeat(ids, width)
        spread[np.repeat(lone, width)] = model.first_byte + np.frombuffer(b"".join(raw), np.uint8)
        ids, owner = spread, np.repeat(owner, width)
    n = np.bincount(rows[doc[owner]], minlength=len(texts))
    out_off[1:] = np.cumsum(n)
    return ids.astype(np.int32), out_off


def decode_ids(model: PieceModel, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
    """Texts of ids given end to end; the mark before the first word goes."""
    start, size = model.offset[ids], model.offset[ids + 1] - model.offset[ids]
    ends = np.concatenate(([0], np.cumsum(size)))
    data = model.text[np.repeat(start - ends[:-1], size) + np.arange(ends[-1])].tobytes()
    cut = ends[offsets]
    return [data[x:y].decode("utf-8", "replace")[1:] for x, y in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]


def _encode_fn(shared, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from quarry.llm.sentencepiece import BLOCK, decode_ids, encode_block
        from quarry.llm.words import mix64, text_blocks

        model = shared.value
        for batch in batches:
            keys = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            keys = mix64(keys ^ np.uint64(seed & (1 << 64) - 1))
            for at, block in text_blocks(batch.column(2), BLOCK):
                texts = block.to_pylist()
                ids, off = encode_block(model, texts, keys[at:at + len(texts)])
                back = decode_ids(model, ids, off)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(texts)),
                     pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(ids)),
                     pa.array(np.diff(off)), pa.array([x == y for x, y in zip(texts, back, strict=True)])],
                    names=["doc_id", "ids", "n_ids", "lossless"])
    return run


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model_path: str | None = None,
           alpha: float = 1.0, seed: int = 0) -> DataFrame:
    """Per row: doc_id, ids (sampled), n_ids and lossless (decoding gives the
    text back)."""
    spark = docs.sparkSession
    prepare(spark)
    shared = spark.sparkContext.broadcast(load_model(model_path, alpha))
    kind = docs.schema[id_col].dataType.simpleString()
    return (docs.select(F.col(id_col), F.xxhash64(F.col(id_col)).alias("key"), F.coalesce(F.col(text_col), F.lit("")))
            .mapInArrow(_encode_fn(shared, seed), f"doc_id {kind}, ids array<int>, n_ids long, lossless boolean"))


def decode(encoded: DataFrame, ids_col: str = "ids", model_path: str | None = None, out: str = "text") -> DataFrame:
    """``encoded`` with the decoded text as column ``out`` (null ids: null)."""
    spark = encoded.sparkSession
    prepare(spark)
    shared = spark.sparkContext.broadcast(load_model(model_path))

    @F.pandas_udf("string")
    def texts(ids: pd.Series) -> pd.Series:
        from quarry.llm.sentencepiece import decode_ids
        return pd.Series([None if x is None else decode_ids(shared.value, np.asarray(x, np.int64), np.array([0, len(x)]))[0]
                          for x in ids])
    return encoded.withColumn(out, texts(F.col(ids_col)))
