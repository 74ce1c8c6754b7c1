"""Fingerprints: brute-force edits, order independence, increments, likeness."""

import hashlib
import os
import subprocess
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import fingerprint as fp

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, fp string, edited long, next_text string"


def brute(rows):
    rows = sorted(rows)
    out = {}
    for i, (doc, text) in enumerate(rows):
        nxt, k = rows[(i + 1) % len(rows)][1] or "", len(text or "") // 4
        edited = (text or "")[:len(text or "") - k] + nxt[:k]
        out[doc] = (len(text or ""), hashlib.sha256(edited.encode()).hexdigest())
    return out


def test_documents_match_brute_force_edits(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = fp.fingerprints(docs).collect()
    assert {r.doc_id: (r.n_chars, r.edited_sha256) for r in got} == brute([(r.doc_id, r.text) for r in docs.collect()])
    text = {r.doc_id: r.text for r in docs.collect()}
    same, parts = {}, {}
    for r in got:
        assert same.setdefault(text[r.doc_id], r.fingerprint) == r.fingerprint
        parts.setdefault(r.fingerprint, set()).add(tuple(sorted(filter(None, text[r.doc_id].split("\n")))))
    assert all(len(p) == 1 for p in parts.values())  # equal fingerprints: equal paragraph multisets
    edited, nxt = np.array([r.near_edited for r in got]), np.array([r.near_next for r in got])
    assert edited.mean() > 0.6 and nxt.mean() < 0.2 and (edited > nxt).mean() > 0.95
    assert edited.min() >= 0 and edited.max() <= 1 and nxt.min() >= 0 and nxt.max() <= 1


@pytest.mark.parametrize("ranges", [1, 3, 7])
def test_next_over_ranges(spark, monkeypatch, ranges):
    ids = sorted({(i * i * 37) % 5003 for i in range(200)})
    monkeypatch.setattr(fp, "ROWS_PER_RANGE", max(1, len(ids) // ranges))
    df = spark.createDataFrame([(i, f"text {i}") for i in ids], "doc_id long, text string").repartition(5)
    got = {r.doc_id: r.next_text for r in fp.with_next(df, "doc_id", ["text"], "next_").collect()}
    assert got == {a: f"text {b}" for a, b in zip(ids, ids[1:] + ids[:1])}


def array_of(spark, text):
    return fp.with_fingerprint(spark.createDataFrame([(text,)], "t string"), F.col("t"), "f").first().f


def test_order_independent_and_incremental(spark):
    a, b = "one two three four five\nsix seven\n", "eight nine ten\n"
    whole, swapped = array_of(spark, a + b), array_of(spark, b + "six seven\none two three four five")
    assert whole == swapped != array_of(spark, a + b + b)
    df = spark.createDataFrame([(array_of(spark, a), array_of(spark, b), whole)], "x array<long>, y array<long>, z array<long>")
    r = df.select(fp.combined(F.col("x"), F.col("y")).alias("s"), fp.combined(F.col("z"), F.col("y"), True).alias("d")).first()
    assert r.s == whole and r.d == array_of(spark, a)


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "😀é漢x"), (4, "w " * 60_000), (5, "same\ntext here now and more"), (6, "same\ntext here now and more")]
    df = spark.createDataFrame([(i, t, "f", 1, None) for i, t in rows] + [(None, "no id at all", "", 1, "")], SCHEMA)
    got = {r.doc_id: r for r in fp.fingerprints(df).collect()}
    want = brute(rows)
    assert {i: (r.n_chars, r.edited_sha256) for i, r in got.items() if i is not None} == want
    assert got[1].fingerprint == got[2].fingerprint and set(got[1].fingerprint) == {"0"}
    assert got[5].fingerprint == got[6].fingerprint and got[5].near_next == 1.0
    assert got[None].near_edited == 1.0 and got[None].near_next == 0.0
    twice = spark.createDataFrame([(1, "a b c d e f g h"), (1, "a b c d e f g h"), (2, "x y z")], "doc_id long, text string")
    assert fp.fingerprints(twice).count() == 3
    assert fp.fingerprints(df.limit(0)).collect() == []


def test_native_plan(spark):
    plan = fp.fingerprints(spark.read.parquet(f"{SF}/documents.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Cartesian" not in plan and "SinglePartition" not in plan


LONG_TEXTS = """
from pyspark.sql import functions as F
from quarry.llm import fingerprint as fp
from quarry.session import build_session
spark = build_session("local[2]", extra={"spark.driver.memory": "3g"})
same = "concat('one two three four', substring(string(id), 2), '\\n')"  # of a column: nothing is computed while planning
made = [f"repeat({same}, 1000)", f"repeat({same}, 1100000)", f"repeat(concat({same}, 'five six\\n'), 550000)"]
few, many, two = (fp.with_fingerprint(spark.range(1).selectExpr(f"{e} AS t"), F.col("t"), "f").first().f for e in made)
df = spark.createDataFrame([(few, many, two)], "few array<long>, many array<long>, two array<long>")
r = df.select(fp.likeness(F.col("few"), F.col("many")).alias("same"), fp.likeness(F.col("many"), F.col("two")).alias("half")).first()
print("GOT", r.same, r.half, many[0])
"""


def test_counters_of_very_long_texts():
    """More than 2^20 equal pieces: the likeness stays that of the pieces.  In a
    session of its own, since the arrays of such a text need more than 1 GB."""
    out = subprocess.run([sys.executable, "-c", LONG_TEXTS], capture_output=True, text=True, cwd=ROOT, timeout=300, check=True).stdout
    same, half, lines = map(float, out.rpartition("GOT")[2].split())
    assert same == pytest.approx(1.0, abs=1e-12) and 0.4 < half < 0.95 and lines == 1_100_000


def test_likeness_is_the_cosine_of_sign_sums(spark):
    """200 random pairs against sums written out in Python."""
    rng = np.random.default_rng(9)
    texts = [" ".join(f"w{v}" for v in rng.integers(0, 30, size=rng.integers(1, 60))) for _ in range(400)]
    df = spark.createDataFrame([(texts[2 * k], texts[2 * k + 1]) for k in range(200)], "a string, b string")
    step = fp.with_fingerprint(fp.with_fingerprint(df, F.col("a"), "fa"), F.col("b"), "fb")
    hashed = step.select("*", fp.likeness(F.col("fa"), F.col("fb")).alias("like"), *[
        F.transform(F.regexp_extract_all(c, F.lit(fp._PIECE), F.lit(0)), lambda x: F.xxhash64(x)).alias("h" + c) for c in ("a", "b")])

    def signs(hashes):
        out = np.zeros(60)
        for h in hashes:
            out += [1 if h >> k & 1 else -1 for k in range(60)]
        return out
    for r in hashed.collect():
        x, y = signs(r.ha), signs(r.hb)
        size = np.sqrt((x @ x) * (y @ y))
        want = 1.0 if r.fa == r.fb else 0.0 if size == 0 else min(1.0, max(0.0, x @ y / size))
        assert r.like == pytest.approx(want, abs=1e-9)
        assert len(r.fa) == 10 + 30
