"""Exact and near deduplication against brute force, with the odd rows."""

import hashlib
import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from quarry.llm import components as near_dedup_components, exact_dedup, near_dedup
from quarry.llm.components import components, extended

SCHEMA = "doc_id long, text string, lang string, kept boolean, bucket long"
SF = "/root/testdata/sf0.01"


def shingles(text, width=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    if len(words) < width:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i:i + width]) for i in range(len(words) - width + 1))


def brute_components(rows):
    sets = {i: shingles(t) for i, t in rows}
    where = {}
    for i, s in sets.items():
        for x in s:
            where.setdefault(x, []).append(i)
    label = {i: i for i in sets}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i
    for a, s in sets.items():
        for b in {b for x in s for b in where[x] if b > a}:
            both = len(s & sets[b])
            if 100 * both >= 75 * (len(s) + len(sets[b]) - both):
                ra, rb = root(a), root(b)
                label[max(ra, rb)] = min(ra, rb)
    return {i: (len(s), root(i)) for i, s in sets.items()}


def got_near(spark, rows, schema=SCHEMA):
    df = spark.createDataFrame(rows, schema)
    return {r.doc_id: r for r in near_dedup.near_duplicates(df).collect()}


def edited_texts(seed=1):
    """Base texts, near copies around the threshold, chains, copies."""
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(3000)]
    texts = []
    for _ in range(25):
        base = [rnd.choice(words) for _ in range(rnd.choice([3, 6, 9, 20, 60, 300]))]
        texts.append(" ".join(base))
        now = base
        for _ in range(8):
            now = list(now if rnd.random() < 0.5 else base)
            for _ in range(rnd.randint(0, max(1, len(now) // 30))):
                now[rnd.randrange(len(now))] = rnd.choice(words)
            texts.append("\t".join(now).upper() if rnd.random() < 0.2 else " ".join(now))
    return texts


def test_near_matches_brute_force(spark):
    rows = [(i * 3, t) for i, t in enumerate(edited_texts())]
    random.Random(5).shuffle(rows)
    want = brute_components(rows)
    got = got_near(spark, [(i, t, "en", True, 1) for i, t in rows])
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == want
    assert all(r.kept == (i == r.component_id) for i, r in got.items())


def test_near_hot_group_of_unequal_near_copies(spark):
    rnd = random.Random(2)
    base = [f"h{i}" for i in range(80)]
    texts = []
    for i in range(200):
        now = list(base)
        for _ in range(rnd.randint(0, 3)):
            now[rnd.randrange(80)] = f"x{rnd.random()}"
        texts.append(" ".join(now))
    rows = list(enumerate(texts))
    got = got_near(spark, [(i, t, "en", True, 1) for i, t in rows])
    assert {i: r.component_id for i, r in got.items()} == {i: c for i, (_, c) in brute_components(rows).items()}


def test_near_matches_brute_force_on_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = brute_components([(r.doc_id, r.text) for r in docs.collect()])
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(docs).collect()}
    assert got == want


def test_near_odd_rows(spark):
    long = " ".join(f"v{i}" for i in range(60_000))
    rows = [(1, None, None, None, None), (2, "", "en", True, 1), (3, " \t\n", "en", True, 1),
            (4, "one two", "en", True, 1), (5, "ONE\ttwo ", "en", True, 1), (6, "one", "en", True, 1),
            (7, long, "en", True, 1), (8, long + " tail", "en", True, 1),
            (9, "É one two three four five", "en", True, 1), (10, "é one two three four five", "en", True, 1),
            (None, "one two", "en", True, 1), (11, "same row", "en", True, 1), (11, "same row", "en", True, 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = near_dedup.near_duplicates(df).collect()
    assert len(out) == len(rows)
    got = {r.doc_id: r for r in out}
    assert [got[i].n_shingles for i in (1, 2, 3, 4, 6)] == [0, 0, 0, 1, 1]
    assert {i: got[i].component_id for i in range(1, 12)} == {
        1: 1, 2: 2, 3: 3, 4: 4, 5: 4, 6: 6, 7: 7, 8: 7, 9: 9, 10: 10, 11: 11}
    stay = near_dedup.keep_one_of_each(df)
    assert stay.columns == df.columns
    assert sorted(r.doc_id or 0 for r in stay.collect()) == [0, 1, 2, 3, 4, 6, 7, 9, 10, 11, 11]


def test_near_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert near_dedup.near_duplicates(df).collect() == []
    assert near_dedup.keep_one_of_each(df).collect() == []


def test_registers_estimate_jaccard():
    import numpy as np
    rng = np.random.default_rng(3)
    errors = []
    for share in (0.2, 0.5, 0.8):
        for _ in range(30):
            n = 2000
            common = rng.integers(0, 1 << 63, int(n * share), dtype=np.uint64)
            a, b = (np.concatenate([common, rng.integers(0, 1 << 63, n - len(common), dtype=np.uint64)]) for _ in "ab")
            regs, _ = near_dedup.registers(np.concatenate([a, b]), np.array([0, n, 2 * n]))
            true = len(common) / (2 * n - len(common))
            errors.append(near_dedup.estimate(regs[:1], regs[1:], np.array([n]), np.array([n]))[0] - true)
    assert abs(np.mean(errors)) < 0.015 and np.std(errors) < 0.06


# -- exact ---------------------------------------------------------------------

def test_exact_groups_and_odd_rows(spark):
    rows = [(1, "a", "x", True, 1), (2, "a", "y", None, 2), (3, "A", "z", True, 3), (4, None, None, None, None),
            (5, "", "q", True, 5), (None, "a", "n", True, 6), (7, "b " * 50_000, "l", True, 7),
            (8, "b " * 50_000, "l", True, 8), (9, "dup", "d", True, 9), (9, "dup", "d", True, 9),
            (None, "only null", "n", True, 1), (None, "only null", "n", True, 2)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = exact_dedup.copy_groups(df).collect()
    assert len(out) == len(rows)
    by = {}
    for r in out:
        by.setdefault(r.doc_id, []).append((r.keep_id, r.group_size, r.kept))
    assert by[1] == [(2, 3, False)] and by[2] == [(2, 3, True)] and by[3] == [(3, 1, True)]
    assert by[4] == [(5, 2, False)] and by[5] == [(5, 2, True)]
    assert by[7] == [(8, 2, False)] and by[8] == [(8, 2, True)]
    assert sorted(by[9]) == [(9, 2, False), (9, 2, True)]
    assert sorted(by[None], key=str) == [(2, 3, False), (None, 2, False), (None, 2, True)]
    sha = {r.doc_id: r.text_sha256 for r in out}
    assert sha[4] == hashlib.sha256(b"").hexdigest()
    stay = exact_dedup.drop_copies(df)
    assert stay.columns == df.columns
    assert sorted(str(r.doc_id) for r in stay.collect()) == sorted(["2", "3", "5", "8", "9", "None"])


def test_exact_saturated_bitmap_is_still_exact(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "slots_for", lambda n: 64)
    rows = [(i, f"t{i % 700}", "en", True, 0) for i in range(1000)]
    out = exact_dedup.copy_groups(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.doc_id: (r.keep_id, r.group_size) for r in out} == {
        i: ((i % 700) + 700, 2) if i % 700 < 300 else (i, 1) for i in range(1000)}


def test_exact_stays_native_and_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    out = exact_dedup.copy_groups(df)
    assert out.collect() == []
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "Cartesian" not in plan


# -- components and torn groups -------------------------------------------------

@pytest.mark.parametrize("seed", range(3))
def test_components_against_union_find(spark, seed):
    rnd = random.Random(seed)
    n = 400
    links = [(rnd.randrange(n), rnd.randrange(n)) for _ in range(rnd.choice([100, 250, 390]))]
    path = list(range(1000, 1200))
    rnd.shuffle(path)
    links += list(zip(path, path[1:]))                       # long and out of order
    links += [(2000, k) for k in range(2001, 2100)]          # a hub
    links += [(None, 3), (4, None), (7, 7), *links[:20]]
    root = {x: x for link in links for x in link if x is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in links:
        if a is not None and b is not None:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    df = spark.createDataFrame(links, "a long, b long")
    want = {x: find(x) for x in root if find(x) != x}
    assert {r.node: r.label for r in components(df, "a", "b").collect()} == want
    first, rest = df.limit(len(links) // 2), spark.createDataFrame(links[len(links) // 2:], "a long, b long")
    label = components(spark.createDataFrame(links[:len(links) // 2], "a long, b long"), "a", "b")
    assert {r.node: r.label for r in extended(label, rest, "a", "b").collect()} == want
    assert first.count() == len(links) // 2


def torn_texts(groups, size, seed):
    """Groups of near copies around one long common passage: all share bands,
    and documents of different groups are not near."""
    rnd = random.Random(seed)
    common = [f"c{k}" for k in range(60)]
    texts = []
    for g in range(groups):
        own = [f"g{g}x{k}" for k in range(40)]
        for _ in range(size):
            now = common + own
            now[60 + rnd.randrange(40)] = f"r{rnd.random()}"
            texts.append(" ".join(now))
    rnd.shuffle(texts)
    return texts


@pytest.mark.parametrize("block", [1024, 16])
def test_near_torn_buckets_match_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    rows = list(enumerate(torn_texts(30, 7, 1)))
    got = got_near(spark, [(i, t, "en", True, 1) for i, t in rows])
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == brute_components(rows)


def test_near_short_documents_in_one_bucket(spark):
    """Sets too small for an estimate are all compared in full."""
    rnd = random.Random(4)
    rows = []
    for i in range(300):
        words = [f"w{k}" for k in range(12)]
        for _ in range(rnd.randint(0, 2)):
            words[rnd.randrange(12)] = f"w{rnd.randrange(40)}"
        rows.append((i, " ".join(words)))
    got = got_near(spark, [(i, t, "en", True, 1) for i, t in rows])
    assert {i: r.component_id for i, r in got.items()} == {i: c for i, (_, c) in brute_components(rows).items()}


def test_pieces_hold_bounded_sets(monkeypatch):
    import numpy as np
    monkeypatch.setattr(near_dedup, "PIECE_SHINGLES", 10)
    assert near_dedup._pieces(np.array([3, 3, 3, 3, 50, 1, 9, 1])).tolist() == [0, 3, 4, 5, 7, 8]
    assert near_dedup._pieces(np.array([], np.int64)).tolist() == [0, 0]


def test_near_writes_few_tables(spark, monkeypatch):
    written = []
    for module in (near_dedup, near_dedup_components):
        for name in ("materialize", "materialize_observed"):
            real = getattr(module, name)
            monkeypatch.setattr(module, name, lambda df, what, *a, _real=real, **k: written.append(what) or _real(df, what, *a, **k))
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(30)), "en", True, 1) for i in range(50)]
    assert len(got_near(spark, rows)) == 50 and len(written) <= 3
    written.clear()
    rows += [(100 + i, rows[i][1] + " tail", "en", True, 1) for i in range(20)]
    assert sum(not r.kept for r in got_near(spark, rows).values()) == 20 and len(written) <= 14
