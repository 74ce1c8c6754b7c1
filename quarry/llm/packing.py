"""Best-fit packing of token pieces by a grouping genetic algorithm.

Documents are tokenised in Arrow batches; longer ones are cut into pieces of
``CAPACITY`` tokens, of which the first may be shorter.  Only piece lengths
matter to the packing, so a genome is a list of (bin pattern, how many bins):
at most 1,023 lengths occur, whatever the number of documents.  Genomes evolve
on islands, one Spark task each; the best of each island moves on to the next
one between rounds.  Crossover injects whole well-filled bins of one parent,
takes from the other parent the bins whose pieces are still free, and places
the displaced pieces by best fit.

Pieces get their place by rank within their length (counted over salted
buckets, so no length is gathered anywhere): the plan says which ranks of which
length go to which sequence and offset.  Null text counts as empty (its one piece
is the end mark); ids may be null or repeat, and each row has pieces of its own;
texts of any length are tokenised whole; pieces of equal length are
interchangeable, so either may come first; an empty table gives no rows; other
columns are never read.
"""

from __future__ import annotations

import json
import random
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from quarry.llm.runtime import prepare
from quarry.plans.materialize import materialize

CAPACITY = 1024
END = 2                # token after each document
LONG = 100_000         # characters; longer stretches without a cut go to the slower encoder
ISLANDS = 4
ROUNDS = 2
GENERATIONS = 10
POPULATION = 6

# fixed value: the split pattern of the byte-level vocabulary
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

Genome = list[tuple[tuple[int, ...], int]]


# -- tokens ----------------------------------------------------------------------

def vocabulary_ranks(tokenizer_json: str) -> dict[bytes, int]:
    """Byte sequences and ids of a byte-level BPE file.  Such files write each
    byte as one printable character: printable Latin-1 bytes as themselves, the
    others as the characters from 256 on, in order."""
    spec = json.loads(tokenizer_json)
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(plain)]
    byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}
    special = {t["content"] for t in spec.get("added_tokens", [])}
    return {bytes(byte_of[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}


# no token of the split pattern goes on past a printable ASCII character into white space
_CUT = re.compile(r"(?<=[!-~])[ \n]")


def text_parts(text: str) -> list[str]:
    """Parts of a long text that are encoded on their own with the same ids."""
    if len(text) < LONG:
        return [text]
    cuts = [0]
    for found in _CUT.finditer(text):
        if found.start() - cuts[-1] >= LONG // 2:
            cuts.append(found.start())
    return [text[a:b] for a, b in zip(cuts, [*cuts[1:], len(text)], strict=True)]


def encoder(tokenizer_json: str, special: bool = False):
    """Function from a text to its ids, those of ``tokenizers``.  The file's
    special strings are single tokens if ``special``, else plain text.
    ``tiktoken`` is faster but its split pattern fails on a million blanks, so
    long parts and those with special tokens go to ``tokenizers``."""
    import tiktoken
    from tokenizers import Tokenizer

    fast = tiktoken.Encoding("byte_bpe", pat_str=SPLIT, mergeable_ranks=vocabulary_ranks(tokenizer_json), special_tokens={})
    whole = Tokenizer.from_str(tokenizer_json)
    whole.encode_special_tokens = not special
    added = [t["content"] for t in json.loads(tokenizer_json).get("added_tokens", [])] if special else []

    def encode(text: str) -> list[int]:
        ids: list[int] = []
        for part in text_parts(text):
            if len(part) < LONG and not any(t in part for t in added):
                ids += fast.encode_ordinary(part)
            else:
                ids += whole.encode_batch_fast([part], add_special_tokens=False)[0].ids
        return ids
    return encode


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


_ENCODERS: dict = {}


def _pieces_fn(shared, capacity: int, end: int, special: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        from quarry.llm import packing
        from quarry.llm.words import text_blocks

        key = hash((shared.value, special))
        if key not in packing._ENCODERS:  # once a worker
            packing._ENCODERS[key] = packing.encoder(shared.value, special)
        encode = packing._ENCODERS[key]
        for batch in batches:
            for at, texts in text_blocks(batch.column(1)):
                own, piece, start, length, crc = [], [], [], [], []
                for i, text in enumerate(texts.to_pylist()):
                    ids = np.array([*encode(text), end], "<u4")
                    cut = list(range(len(ids) % capacity, len(ids), capacity))
                    edges = ([0] if not cut or cut[0] else []) + cut + [len(ids)]
                    for k, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
                        own.append(at + i)
                        piece.append(k)
                        start.append(a)
                        length.append(b - a)
                        crc.append(zlib.crc32(ids[a:b].tobytes()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(own, pa.int64())), pa.array(piece, pa.int32()),
                     pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"])
    return run


# -- genomes -----------------------------------------------------------------------

def best_fit(free: dict[int, int], bins: Genome, capacity: int) -> Genome:
    """Place the pieces ``free`` (length: count), longest first, each into the
    fullest bin that takes it, after the given bins."""
    by_room: dict[int, list[list]] = {}
    for pattern, k in bins:
        if k:
            by_room.setdefault(capacity - sum(pattern), []).append([pattern, k])
    for size in sorted((s for s, k in free.items() if k), reverse=True):
        left = free[size]
        while left:
            room = next((r for r in range(size, capacity) if by_room.get(r)), None)
            if room is None:
                each = capacity // size
                if left >= each:
                    by_room.setdefault(capacity - each * size, []).append([(size,) * each, left // each])
                    left %= each
                if left:
                    by_room.setdefault(capacity - left * size, []).append([(size,) * left, 1])
                break
            group = by_room[room][-1]
            take = min(left, group[1])
            group[1] -= take
            if not group[1]:
                by_room[room].pop()
            by_room.setdefault(room - size, []).append([(*group[0], size), take])
            left -= take
    merged = Counter()
    for groups in by_room.values():
        for pattern, k in groups:
            merged[tuple(sorted(pattern, reverse=True))] += k
    return sorted(merged.items())


def bin_count(genome: Genome) -> int:
    return sum(k for _, k in genome)


def fitness(genome: Genome, capacity: int) -> tuple[int, float]:
    """Fewer bins first, then fuller ones (mean squared fill)."""
    n = bin_count(genome)
    return -n, sum(k * (sum(p) / capacity) ** 2 for p, k in genome) / max(n, 1)


def crossover(one: Genome, two: Genome, sizes: dict[int, int], capacity: int, rnd: random.Random) -> Genome:
    """Whole well-filled bins of ``one``, the bins of ``two`` that use no piece
    twice, and best fit for the rest."""
    free = dict(sizes)
    child: Genome = []

    def take(pattern, k):
        need = Counter(pattern)
        k = min([k, *(free.get(s, 0) // c for s, c in need.items())])
        if k:
            child.append((pattern, k))
            for s, c in need.items():
                free[s] -= c * k
    ranked = sorted(one, key=lambda g: (-sum(g[0]), g[0]))
    for pattern, k in ranked[:max(1, int(len(ranked) * rnd.uniform(0.3, 0.8)))]:
        if sum(pattern) >= 0.98 * capacity and rnd.random() < 0.85:
            take(pattern, k)
    for pattern, k in sorted(two, key=lambda g: (-sum(g[0]), g[0])):
        if sum(pattern) >= 0.9 * capacity:
            take(pattern, k)
    return best_fit(free, child, capacity)


def shaken(sizes: dict[int, int], capacity: int, rnd: random.Random) -> Genome:
    """A start genome: some random bins that close well, then best fit."""
    free = dict(sizes)
    child: Genome = []
    keys = sorted(sizes)
    for _ in range(min(200, 4 * len(keys))):
        a = rnd.choice(keys)
        room, pattern = capacity - a, [a]
        while room >= keys[0] and len(pattern) < 6:
            fit = [s for s in (room, rnd.choice(keys)) if s <= room and sizes.get(s)]
            if not fit:
                break
            pattern.append(fit[0])
            room -= fit[0]
        if room:
            continue
        need = Counter(pattern)
        k = min(free[s] // c for s, c in need.items()) // 2
        if k:
            child.append((tuple(pattern), k))
            for s, c in need.items():
                free[s] -= c * k
    return best_fit(free, child, capacity)


def evolve(sizes: dict[int, int], start: list[Genome], capacity: int, seed: int, generations: int, population: int) -> Genome:
    """One island: the best genome after some generations."""
    rnd = random.Random(seed)
    pool = [*start, best_fit(sizes, [], capacity)]
    while len(pool) < population:
        pool.append(shaken(sizes, capacity, rnd))
    floor = -(-sum(s * k for s, k in sizes.items()) // capacity)
    for _ in range(generations):
        pool.sort(key=lambda g: fitness(g, capacity), reverse=True)
        if bin_count(pool[0]) <= floor:
            break
        pool = pool[:population]
        one, two = pool[0], pool[rnd.randrange(1, len(pool))]
        pool += [crossover(one, two, sizes, capacity, rnd), crossover(two, one, sizes, capacity, rnd)]
        worst = sorted(pool[0], key=lambda g: sum(g[0]))  # mutation: empty the least filled bins
        drop = worst[:max(1, len(worst) // 10)]
        free = Counter()
        for pattern, k in drop:
            for s in pattern:
                free[s] += k
        pool.append(best_fit(free, [g for g in pool[0] if g not in drop], capacity))
    return max(pool, key=lambda g: fitness(g, capacity))


def plan(spark, sizes: dict[int, int], capacity: int = CAPACITY) -> Genome:
    """Evolve on islands; only genomes (at most a few thousand patterns) travel."""
    if not sizes:
        return []

    def island(batches):
        import pandas as pd

        from quarry.llm.packing import evolve

        for rows in batches:
            for _, r in rows.iterrows():
                start = [[(tuple(p), k) for p, k in g] for g in json.loads(r.elites)]
                best = evolve(sizes, start, capacity, int(r.seed), GENERATIONS, POPULATION)
                yield pd.DataFrame({"island": [int(r.island)], "best": [json.dumps(best)]})

    elites: list[list] = [[] for _ in range(ISLANDS)]
    for turn in range(ROUNDS):
        rows = [(i, 1000 * turn + i, json.dumps(elites[i])) for i in range(ISLANDS)]
        df = spark.createDataFrame(rows, "island int, seed long, elites string").repartition(ISLANDS, "island")
        best = {r.island: json.loads(r.best) for r in df.mapInPandas(island, "island int, best string").collect()}
        elites = [[best[i], best[(i - 1) % ISLANDS]] for i in range(ISLANDS)]
    genomes = [[(tuple(p), k) for p, k in g[0]] for g in elites]
    return max(genomes, key=lambda g: (fitness(g, capacity), g))


def slots(genome: Genome) -> np.ndarray:
    """Rows (length, first rank, first sequence, offset), sorted: the ranks from
    there up to the next row's go to consecutive sequences at this offset."""
    used: Counter = Counter()
    rows, seq = [], 0
    for pattern, k in genome:
        at = 0
        for size in pattern:
            rows.append((size, used[size], seq, at))
            used[size] += k
            at += size
        seq += k
    return np.array(sorted(rows), np.int64).reshape(-1, 4)


def _place_fn(shared, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        keys = (table[:, 0] << 48) + table[:, 1]
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            row = table[np.searchsorted(keys, (length << 48) + rank, "right") - 1]
            keep = [batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays(
                [*keep, pa.array(row[:, 2] + rank - row[:, 1]), pa.array(row[:, 3])], names=[*names, "sequence_id", "offset"])
    return run


# -- the operator ----------------------------------------------------------------------

def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
         end: int = END, tokenizer_path: str | None = None, special: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id
    and offset.  Whole pieces of ``capacity`` tokens are sequences by
    themselves.  With ``special``, special strings in texts are one token, as
    ``tokenizers`` takes them by default."""
    spark = docs.sparkSession
    prepare(spark)
    with open(tokenizer_path or default_tokenizer(), encoding="utf-8") as file:
        shared = spark.sparkContext.broadcast(file.read())  # a vocabulary file: a few MB
    kind = docs.schema[id_col].dataType.simpleString()
    pieces, _ = materialize(
        docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")))
        .mapInArrow(_pieces_fn(shared, capacity, end, special),
                    f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")
        .withColumn("row", F.monotonically_increasing_id()), "pieces")
    # at most capacity - 1 lengths
    sizes = {r.length: r["count"] for r in pieces.filter(F.col("length") < capacity).groupBy("length").count().collect()}
    genome = plan(spark, sizes, capacity)
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]

    buckets = max(256, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    part = (pieces.filter(F.col("length") < capacity)
            .withColumn("bucket", F.pmod(F.xxhash64("row"), F.lit(buckets))))
    before = (part.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
              .withColumn("before", F.coalesce(F.sum("n").over(
                  Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))))
    ranked = (part.withColumn("nth", F.row_number().over(Window.partitionBy("length", "bucket").orderBy("row")))
              .join(before.drop("n"), ["length", "bucket"])
              .select(*names, (F.col("before") + F.col("nth") - 1).alias("rank")))
    placed = ranked.mapInArrow(
        _place_fn(spark.sparkContext.broadcast(slots(genome)), names),
        f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
    full = (pieces.filter(F.col("length") == capacity)
            .select(*names, (F.col("row") + bin_count(genome)).alias("sequence_id"), F.lit(0).cast("long").alias("offset")))
    return placed.unionByName(full)
