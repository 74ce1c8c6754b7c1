"""The audit against every order applied to every document, one at a time."""

import re
from itertools import permutations

import pytest

from quarry.llm import filter_audit as fa

COLUMNS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def brute(docs, labels):
    """{(part, order, step): figures} of (id, text, source) and (id, quality, toxic)."""
    good = {i for i, q, _ in labels if i is not None and q == 1}
    toxic = {i for i, _, t in labels if i is not None and t == 1}
    rows = []
    for i, text, source in docs:
        x = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", x)
        fails = set()
        if len(words) < 200:
            fails.add("A")
        if 100 * len(set(words)) < 50 * len(words):
            fails.add("B")
        if 100 * sum(c.isascii() and c.isupper() for c in x) > 2 * len(x):
            fails.add("C")
        if set(x) & set("#$%&*|"):
            fails.add("D")
        if i is not None and any(j is not None and j < i and (t or "") == x for j, t, _ in docs):
            fails.add("E")
        rows.append((source or "", fails, i in good, i in toxic))
    out = {}
    for part in {r[0] for r in rows}:
        mine = [r[1:] for r in rows if r[0] == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[0]]
                left = [r for r in left if f not in r[0]]
                shapley[f] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(f in r[0] for r in mine) - len(gone), sum(r[0] == {f} for r in mine),
                    sum(r[1] for r in gone), sum(r[2] for r in gone)]
        for (p, order, step), figures in out.items():
            if p == part:
                figures.append(shapley[order[step - 1]])
    return out


def run(spark, docs, labels):
    d = spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(3)
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    rows = fa.filter_audit(d, lab).collect()
    got = {(r.part, r.filter_order, r.step): [r[c] for c in COLUMNS] for r in rows}
    assert len(got) == len(rows)
    return got


def test_against_every_order(spark):
    long = " ".join(f"w{k}" for k in range(250))
    docs = [(1, None, None), (2, "", ""), (3, "CAPS and $", "s"), (4, long, "s"), (5, long, "t"), (6, long, None),
            (7, "word " * 300, "s"), (8, long + " #", "s"), (9, "WORD " * 300 + "|", "t"), (None, long, "s"), (None, "", "t"),
            (10, "word " * 30_000 + "%", "s"), (11, "a b c", "s"), (11, "a b c", "s"), (11, "a b c", "t"), (12, "a b c", "t"),
            (13, "\x0b\x0cx y\x85z", "t"), (14, long.upper(), "s")]
    labels = [(3, 1, 0), (4, 1, 1), (5, 0, 1), (5, 1, None), (7, None, 1), (11, 1, 1), (99, 1, 1), (None, 1, 1), (14, 1, 0)]
    assert run(spark, docs, labels) == brute(docs, labels)


def test_a_text_held_by_most_rows(spark):
    docs = [(i, "the same" if i % 3 else f"own {i}", "s" if i % 2 else "t") for i in range(600)]
    labels = [(i, i % 2, int(i % 5 == 0)) for i in range(600)]
    assert run(spark, docs, labels) == brute(docs, labels)


def test_empty_tables_and_clashing_names(spark):
    assert run(spark, [], []) == {}
    odd = spark.createDataFrame([(1, "x", "s", "p", 5, 3, 9, "q")],
                                "doc_id long, text string, source string, part string, id int, mask int, n int, sha string")
    lab = spark.createDataFrame([(1, 1, 1, 4)], "doc_id long, quality int, toxic int, id int")
    rows = fa.filter_audit(odd, lab).collect()
    assert len(rows) == 600 and {r.part for r in rows} == {"s"}


@pytest.mark.parametrize("mask", range(1, 32))
def test_intervals_are_the_first_failing_step(mask):
    failing = {fa.LETTERS[k] for k in range(5) if mask >> k & 1}
    spans = fa.removal_intervals(mask)
    for rank, order in enumerate(sorted(map("".join, permutations("ABCDE")))):
        at = 1 + min(order.index(f) for f in failing)
        assert [s for s, lo, hi in spans if lo <= rank < hi] == [at]
