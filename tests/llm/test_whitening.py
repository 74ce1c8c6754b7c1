"""Whitening against a dense eigen decomposition of whole numbers."""

import math

import numpy as np
import pytest

from quarry.llm import whitening as wh

NAMES = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def frame(spark, vectors, kind="float"):
    return spark.createDataFrame([(i, None if v is None else [None if e is None else float(e) for e in v])
                                  for i, v in enumerate(vectors)], f"vec_id long, embedding array<{kind}>")


def dense(vectors):
    """x, exact deviations, eigenvalues and eigenvectors, falling."""
    x = [[math.floor(64 * float(e)) + 1_000_000 for e in v] for v in vectors]
    n, sums = len(x), [sum(c) for c in zip(*x, strict=True)]
    diff = [[n * e - s for e, s in zip(r, sums, strict=True)] for r in x]
    centred = np.array([[e / n for e in r] for r in diff])
    e, axes = np.linalg.eigh(centred.T @ centred / n)
    return centred, [sum(v * v for v in r) for r in diff], e[::-1], axes[:, ::-1]


def check(spark, vectors, rows, kind="double", gaps=True):
    """``rows`` are the positions that should remain."""
    got = wh.whiten(frame(spark, vectors, kind)).collect()
    assert list(got[0].asDict()) == NAMES
    centred, deviations, e, axes = dense([vectors[i] for i in rows])
    k = min(32, int((e > 1e-13 * e[0]).sum()))
    n, at = len(rows), {v: i for i, v in enumerate(rows)}
    assert len(got) == n * k and {(r.vec_id, r.component) for r in got} == {(v, c) for v in rows for c in range(1, k + 1)}
    white = np.zeros((n, k))
    for r in got:
        white[at[r.vec_id], r.component - 1] = r.whitened
        assert r.n == n and r.deviation == deviations[at[r.vec_id]]
        assert abs(r.explained / (e[r.component - 1] / e.sum()) - 1) < 1e-9
        assert r.identity_error < 1e-8
    assert np.abs(white.T @ white / n - np.eye(k)).max() < 1e-8
    if gaps:
        want = centred @ axes[:, :k] / np.sqrt(e[:k])
        sign = np.sign((want * white).sum(0))
        assert np.abs(white * sign - want).max() < 1e-7
    else:  # equal eigenvalues: the same space
        assert np.allclose(white @ np.diag(e[:k]) @ white.T, centred @ centred.T, atol=1e-6 * e[0] * n)
    return got


def test_whole_table_against_eigh(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    vectors = [r.embedding for r in rows.orderBy("vec_id").collect()]
    assert rows.orderBy("vec_id").first().vec_id == 0
    check(spark, vectors, list(range(len(vectors))), "float")


def test_bad_rows_are_dropped(spark):
    rng = np.random.default_rng(1)
    good = [list(rng.normal(size=5) * [9, 7, 5, 3, 1]) for _ in range(40)]
    bad = [None, [], [1, None, 2, 3, 4], [1, math.nan, 2, 3, 4], [1, math.inf, 0, 0, 0], [1e300, 0, 0, 0, 0], [1, 2, 3]]
    check(spark, good[:20] + bad + good[20:], [*range(20), *range(27, 47)])


def test_rank_and_equal_eigenvalues(spark):
    rng = np.random.default_rng(2)
    flat = rng.normal(size=(60, 3)) @ rng.normal(size=(3, 8)) * 0
    flat[:, 1] = np.round(rng.normal(size=60) * 50)
    flat[:, 4] = 2 * flat[:, 1]
    flat[:, 6] = np.round(rng.normal(size=60) * 20)
    check(spark, flat.tolist(), list(range(60)))                      # rank 2 of 8
    corners = [[a, b, c] for a in (-1, 1) for b in (-1, 1) for c in (-1, 1)]
    check(spark, corners * 5, list(range(40)), gaps=False)            # one eigenvalue three times
    wide = np.kron(np.eye(20), [[1], [-1]])
    check(spark, wide.tolist(), list(range(40)), gaps=False)          # twenty times


def test_more_dimensions_than_components_and_a_very_common_vector(spark):
    rng = np.random.default_rng(3)
    rows = (rng.normal(size=(300, 90)) * np.linspace(20, 1, 90)).tolist()
    rows[50:200] = [rows[50]] * 150
    check(spark, rows, list(range(300)))


def test_large_values_stay_exact(spark):
    rng = np.random.default_rng(4)
    rows = (1e9 + rng.normal(size=(30, 4)) * [4e5, 3e4, 2e3, 100]).tolist()
    got = check(spark, rows, list(range(30)))
    assert max(r.deviation for r in got) > 1 << 50
    far = wh.whiten(frame(spark, [[1e13, 0], [0, 0], [0, 5]], "double")).collect()
    assert {r.deviation for r in far} == {None}                       # beyond a long


@pytest.mark.parametrize("vectors", [[], [None], [[1, 2, 3]], [[1, 2]] * 9, [[], []]])
def test_nothing_to_whiten(spark, vectors):
    out = wh.whiten(frame(spark, vectors))
    assert out.columns == NAMES and out.collect() == []


def test_lengths_ids_and_other_columns(spark):
    rows = [("a", [1.0, 2.0], 1), (None, [3.0, 1.0], 2), ("a", [1.0, 2.0], 3), ("b", [1.0], 4), ("c", [5.0, 5.0], 5)]
    df = spark.createDataFrame(rows, "vec_id string, embedding array<double>, component int")
    got = wh.whiten(df).collect()
    assert sorted((r.vec_id or "") for r in got if r.component == 1) == ["", "a", "a", "c"]
    assert {r.n for r in got} == {4}


def test_centre_of_huge_counts_uses_whole_numbers():
    middle = wh.Centre(1 << 50, [(1 << 50) * 3 + 1], 1 << 20)
    assert middle.wide
    assert middle.differences(np.array([[5]])).tolist() == [[2 * (1 << 50) - 1]]
    assert middle.deviations(np.array([[5]])) == [None]
