"""Seed-and-extend removal against counting every window."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from quarry.llm import substring_dedup

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, n_chars long, n_words long, spans string, k1 long"


def brute(rows, width):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    seen = Counter(tuple(w[i:i + width]) for w in words for i in range(len(w) - width + 1))
    out = []
    for (doc, _), w in zip(rows, words, strict=True):
        gone = set()
        for i in range(len(w) - width + 1):
            if seen[tuple(w[i:i + width])] > 1:
                gone.update(range(i, i + width))
        kept = [x for i, x in enumerate(w) if i not in gone]
        out.append((doc, len(w), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return out


def cut(df, **kw):
    out = substring_dedup.cut_repeats(df, with_text=False, **kw)
    return [(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in out.collect()]


def key(r):
    return (r[0] is None, r)


def test_matches_window_counts(spark):
    rnd = random.Random(4)
    vocab = [f"w{i}" for i in range(400)] + ["É", "漢字"]
    shared = [[rnd.choice(vocab) for _ in range(rnd.choice([34, 35, 36, 60, 120]))] for _ in range(12)]
    rows = []
    for i in range(300):
        w = []
        for _ in range(rnd.randint(0, 4)):
            w += [rnd.choice(vocab) for _ in range(rnd.randint(0, 50))]
            p = rnd.choice(shared)
            a = rnd.randint(0, len(p) // 3)
            w += p[a:] if rnd.random() < .5 else p[:len(p) - a]
        if rnd.random() < .1:
            w = ["same"] * rnd.randint(30, 120)
        rows.append((i, "\n".join(w) if i % 3 else " ".join(w) + "  "))
    rows += [(1000 + i, rows[7][1]) for i in range(40)]
    df = spark.createDataFrame([(i, t, "en", 0, 1, "x", 5) for i, t in rows], SCHEMA)
    assert sorted(cut(df)) == sorted(brute(rows, 35))


def test_matches_on_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert sorted(cut(docs)) == sorted(brute([(r.doc_id, r.text) for r in docs.collect()], 35))


def test_odd_rows_and_clashing_columns(spark):
    long = " ".join(str(i) for i in range(70_000))
    body = " ".join(f"b{i}" for i in range(40))
    rows = [(1, None), (2, ""), (3, " \n"), (4, long), (5, "x " + long[:400] + " y"), (None, body), (None, "z " + body),
            (6, "r " * 36), (6, "r " * 36), (7, "once " + " ".join(f"u{i}" for i in range(50)))]
    df = spark.createDataFrame([(i, t, None, -1, 9, None, 3) for i, t in rows], SCHEMA)
    assert sorted(cut(df), key=key) == sorted(brute(rows, 35), key=key)
    out = substring_dedup.remove_repeats(df)
    assert out.columns == df.columns
    by = {(r.doc_id, r.n_words): r for r in out.collect()}
    assert by[(7, 9)].text == rows[-1][1] and by[(7, 9)].n_chars == -1
    assert by[(1, 9)].text is None and by[(2, 9)].text == "" and by[(6, 9)].text == ""
    assert by[(5, 9)].text.startswith("x ") and by[(5, 9)].n_chars == len(by[(5, 9)].text)


def test_cut_text_keeps_spacing(spark):
    p = " ".join(f"p{i}" for i in range(35))
    df = spark.createDataFrame([(1, f" a\n\nb  {p}\tc \n"), (2, f"{p}  d")], "doc_id long, text string")
    got = {r.doc_id: r.text for r in substring_dedup.remove_repeats(df).collect()}
    assert got == {1: "a\n\nb  c \n", 2: "d"}


def test_empty_table(spark):
    assert cut(spark.createDataFrame([], SCHEMA)) == []


def test_leftmost_minima():
    rng = np.random.default_rng(0)
    v = rng.integers(0, 9, 300).astype(np.uint64)
    got = substring_dedup.leftmost_minima(v, 28)
    assert got.tolist() == [i + int(np.argmin(v[i:i + 28])) for i in range(273)]


@pytest.mark.parametrize("kind", ["string", "double", "int", "bigint", "array<int>"])
def test_length_column_of_any_type(spark, kind):
    """Only whole numbers follow the text; other columns of that name stay."""
    words = [f"w{k}" for k in range(40)]
    rows = [(1, "a " + " ".join(words)), (2, " ".join(words) + " b")]
    value = "array(7)" if kind == "array<int>" else f"cast(7 AS {kind})"
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", f"{value} AS n_chars", "'x' AS n_words")
    out = substring_dedup.remove_repeats(df)
    assert out.columns == df.columns and out.schema["n_chars"].dataType == df.schema["n_chars"].dataType
    got = {r.doc_id: r for r in out.collect()}
    assert got[1].text.split() == ["a"] and got[2].text.split() == ["b"] and got[1].n_words == "x"
    for r in got.values():
        assert r.n_chars == (len(r.text) if "int" in kind and "array" not in kind else [7] if "array" in kind else type(r.n_chars)(7))
