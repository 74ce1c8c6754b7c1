"""Packing: pieces against a plain re-computation, genomes, odd rows."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from quarry.llm import packing

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, piece string, row long, rank long, length long"


@pytest.fixture(scope="module")
def reference():
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(packing.default_tokenizer())
    tok.encode_special_tokens = True
    return lambda text: [*tok.encode(text, add_special_tokens=False).ids, packing.END]


def brute_pieces(rows, encode, capacity=1024):
    out = Counter()
    for doc, text in rows:
        ids = encode(text or "")
        head = len(ids) % capacity
        edges = [0] + [e for e in range(head, len(ids) + 1, capacity) if e]
        for k, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
            out[(doc, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))] += 1
    return out


def check_layout(rows, capacity=1024):
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for items in bins.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_documents_match_the_tokenizer_and_layout(spark, reference):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = packing.pack(docs).collect()
    want = brute_pieces([(r.doc_id, r.text) for r in docs.collect()], reference)
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    total = sum(r.length for r in got)
    assert check_layout(got) <= 1.01 * total / 1024 + 2


def test_odd_rows(spark, reference):
    rows = [(1, None), (2, ""), (None, "null id"), (3, "word " * 5000), (4, "same"), (4, "same"), (5, "<|endoftext|> 😀 x"),
            (6, "a" * 3000), (None, "null id")]
    df = spark.createDataFrame([(i, t, "p", 1, 2, 3) for i, t in rows], SCHEMA)
    got = packing.pack(df).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == brute_pieces(rows, reference)
    check_layout(got)


def test_exact_multiple_and_empty(spark, reference):
    df = spark.createDataFrame([], SCHEMA)
    assert packing.pack(df).collect() == []
    word = " hello" * 1023
    got = packing.pack(spark.createDataFrame([(1, word, "", 1, 1, 1)], SCHEMA)).collect()
    assert [(r.piece, r.start, r.length, r.offset) for r in got] == [(0, 0, 1024, 0)]


def used(genome):
    out = Counter()
    for pattern, k in genome:
        for s in pattern:
            out[s] += k
    return out


def test_genomes_keep_every_piece_and_fit():
    rnd = random.Random(3)
    for n in (5, 80, 20_000):
        sizes = dict(Counter(rnd.randint(1, 1023) for _ in range(n)))
        pool = [packing.best_fit(sizes, [], 1024), packing.shaken(sizes, 1024, rnd)]
        pool.append(packing.crossover(*pool, sizes, 1024, rnd))
        pool.append(packing.evolve(sizes, [], 1024, 1, 5, 4))
        for g in pool:
            assert used(g) == sizes and all(sum(p) <= 1024 for p, _ in g)
        assert packing.bin_count(pool[-1]) <= packing.bin_count(pool[0])


def test_evolution_is_optimal_on_small_cases():
    def fewest(items, capacity):
        best = [len(items)]

        def go(i, bins):
            if len(bins) >= best[0]:
                return
            if i == len(items):
                best[0] = len(bins)
                return
            for j in range(len(bins)):
                if bins[j] + items[i] <= capacity:
                    bins[j] += items[i]
                    go(i + 1, bins)
                    bins[j] -= items[i]
            go(i + 1, [*bins, items[i]])
        go(0, [])
        return best[0]
    rnd = random.Random(8)
    extra = 0
    for seed in range(30):
        items = sorted((rnd.randint(2, 15) for _ in range(9)), reverse=True)
        got = packing.evolve(dict(Counter(items)), [], 20, seed, 20, 6)
        extra += packing.bin_count(got) - fewest(items, 20)
    assert extra <= 1


def test_slots_cover_each_rank_once():
    genome = [((5, 5, 3), 4), ((5, 2), 3), ((3,), 2)]
    table = packing.slots(genome)
    by = defaultdict(list)
    for size, rank, _, _ in table.tolist():
        by[size].append(rank)
    assert by == {5: [0, 4, 8], 3: [0, 4], 2: [0]}


def test_very_long_white_space_and_words(spark, reference):
    rows = [(1, "word" + " " * 2_000_000 + "word"), (2, "word" + "\n" * 2_000_000 + "word"), (3, "ab" * 100_000),
            (4, "it's 1 word, \n\n and! \x1c 漢字  " * 20_000), (5, "a " + "\t \n" * 200_000)]
    df = spark.createDataFrame([(i, t, "p", 1, 2, 3) for i, t in rows], SCHEMA)
    got = packing.pack(df).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == brute_pieces(rows, reference)


def test_queries_take_special_strings_as_the_default_tokenizer(spark, tmp_path):
    from tokenizers import Tokenizer

    import corpus_pipeline
    from quarry.llm import catalog
    tok = Tokenizer.from_file(packing.default_tokenizer())
    rows = [(1, "a <|endoftext|> b"), (2, "<|endoftext|>" * 3), (3, "plain <|endoftext"), (4, "it's <|endoftext|>\n\n " * 9000)]
    df = spark.createDataFrame([(i, t, "p", 1, 2, 3) for i, t in rows], SCHEMA)
    df.write.parquet(f"{tmp_path}/documents.parquet")
    want = brute_pieces(rows, lambda t: [*tok.encode(t, add_special_tokens=False).ids, packing.END])
    for out in (catalog.op6_packing(spark, str(tmp_path)), corpus_pipeline.pack_sequences(spark, df, str(tmp_path))):
        assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out.collect()) == want
