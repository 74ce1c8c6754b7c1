"""Sampled segmentation: distribution by enumeration, losslessness, reproducibility."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import sentencepiece as spm

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, ids string, key long, lossless string"


@pytest.fixture(scope="module")
def model():
    return spm.load_model()


@pytest.fixture(scope="module")
def pieces():
    import public_tokenizers
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def paths(model, pieces, text):
    """Every segmentation of a text of known characters, with its weight."""
    vocab = {pieces.id_to_piece(i): i for i in range(pieces.get_piece_size()) if np.isfinite(model.log_weight[i])}
    out = {}

    def go(at, ids, weight):
        if at == len(text):
            out[tuple(ids)] = math.exp(weight)
        for end in range(at + 1, min(at + 16, len(text)) + 1):
            if text[at:end] in vocab:
                i = vocab[text[at:end]]
                go(end, [*ids, i], weight + model.log_weight[i])
    go(0, [], 0.0)
    return out


def test_samples_follow_the_lattice_distribution(model, pieces):
    n = 40_000
    for word in ("hello", "in the", "ab"):
        want = paths(model, pieces, ("▁" + word.replace(" ", "▁")))
        total = sum(want.values())
        ids, off = spm.encode_block(model, [word] * n, np.arange(n, dtype=np.uint64) * np.uint64(7919))
        got = Counter(tuple(ids[a:b].tolist()) for a, b in zip(off[:-1], off[1:], strict=True))
        assert set(got) <= set(want)
        for path, weight in want.items():
            p = weight / total
            assert abs(got[path] / n - p) < 5 * math.sqrt(p * (1 - p) / n) + 1e-4


def test_block_and_order_do_not_matter(model):
    texts = ["Hello  world\n x", "", "▁ literal ▁▁", "😀 漢字\tend ", " lead", "z" * 300 + " q", "Hello  world\n x", "\x00\x7f"]
    keys = np.arange(8, dtype=np.uint64) + np.uint64(5)
    ids, off = spm.encode_block(model, texts, keys)
    assert spm.decode_ids(model, ids, off) == texts
    for i, t in enumerate(texts):
        alone, _ = spm.encode_block(model, [t], keys[i:i + 1])
        assert alone.tolist() == ids[off[i]:off[i + 1]].tolist()


def test_documents_round_trip_and_repeat(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    one = spm.encode(docs)
    rows = one.collect()
    assert len(rows) == docs.count() and all(r.lossless and r.n_ids == len(r.ids) for r in rows)
    again = {r.doc_id: r.ids for r in spm.encode(docs.repartition(7, F.rand(3))).collect()}
    assert all(again[r.doc_id] == r.ids for r in rows)
    other = {r.doc_id: r.ids for r in spm.encode(docs, seed=1).collect()}
    assert np.mean([other[r.doc_id] != r.ids for r in rows if r.n_ids > 50]) > .99
    text = {r.doc_id: r.text for r in docs.collect()}
    assert all(r.text == text[r.doc_id] for r in spm.decode(one).collect())


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (None, "no id"), (3, " "), (4, "long " * 50_000), (5, "x" * 20_000), (6, "same"), (6, "same")]
    df = spark.createDataFrame([(i, t, "i", 1, "l") for i, t in rows], SCHEMA)
    got = spm.encode(df).collect()
    assert len(got) == len(rows) and all(r.lossless for r in got)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r.ids)
    assert by[1] == by[2] == [[]] and by[6][0] == by[6][1] and len(by[3][0]) >= 1
    assert spm.encode(df.limit(0)).collect() == []
    back = spm.decode(spark.createDataFrame([(None,), ([],)], "ids array<int>")).collect()
    assert [r.text for r in back] == [None, ""]
