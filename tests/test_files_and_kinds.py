"""Numbered files, sorted single files, wide rows, mixed input, moment states and
the edges of the readers and writers."""

import glob
import re
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry import sources
from quarry.operators import graph, matrix, stats
from quarry.sources import files
from quarry.sources.tsv import routed_lines
from tests.test_fixtures import ADD_A, ADD_B, DISTANCES, EDGES, LETTERS, LETTERS_T

# fixed values: the lines of the distance files
SORTED = "s\t0\nw\t1\nr\t1\nx\t2\nv\t2\nt\t2\ny\t3\nu\t3\n"
BY_NUMBER = {0: "s\t0\n", 1: "r\t1\nw\t1\n", 2: "t\t2\nv\t2\nx\t2\n", 3: "u\t3\ny\t3\n"}
DIFFERENCE = "C:1\t1.0\t3.0\t-4.0\t\nC:2\t-6.0\t-5.0\t0.0\t\n"


def part_texts(path):
    out = {}
    for f in glob.glob(f"{path}/part-*"):
        n = int(re.search(r"part-(\d+)", f)[1])
        assert n not in out
        out[n] = open(f, newline="").read()
    return {k: v for k, v in out.items() if v}


# -- file number = value --------------------------------------------------------

def test_file_number_is_the_value(spark, tmp_path):
    df = spark.createDataFrame(DISTANCES, "node string, dist int").repartition(3)
    out = str(tmp_path / "n")
    sources.write_parts(df, out, "dist", 4)
    assert {k: "".join(sorted(v.splitlines(True))) for k, v in part_texts(out).items()} == BY_NUMBER
    back = sources.read_parts(spark, out, "node string, dist int").collect()
    assert sorted((r.node, r.dist) for r in back) == sorted(DISTANCES) and all(r.number == r.dist for r in back)


def test_partition_function_of_the_caller(spark, tmp_path):
    df = spark.range(1000).selectExpr("id", "concat('t', id) AS s")
    out = str(tmp_path / "f")
    sources.write_parts(df, out, (F.length("s") * 2 + F.col("id") % 2).cast("bigint") - 4, 6)
    want = {}
    for i in range(1000):
        want.setdefault(2 * len(f"t{i}") + i % 2 - 4, set()).add(i)
    got = {}
    for r in sources.read_parts(spark, out, "id bigint, s string", "file").collect():
        got.setdefault(r.file, set()).add(r.id)
    assert got == want


@pytest.mark.parametrize("bad", ["-1", "4", "NULL", "2147483650"])
def test_numbers_without_a_file_are_refused(spark, tmp_path, bad):
    df = spark.sql(f"SELECT 'a' AS s, {bad} AS n")
    with pytest.raises(Exception, match="no file of 4"):
        sources.write_parts(df, str(tmp_path / "b"), "n", 4)


# -- one sorted file -------------------------------------------------------------

def test_sorted_file_is_the_golden_one(spark, tsv, tmp_path):
    edges = sources.read_tsv(spark, tsv(EDGES), "src string, dst string")
    path = str(tmp_path / "deep" / "dist.tsv")
    sources.write_sorted_file(graph.bfs(edges, "s"), path, "dist", F.desc("node"))
    assert open(path, newline="").read() == SORTED


def test_sorted_file_of_many_parts(spark, tmp_path):
    df = spark.range(50_000).selectExpr("id * 7919 % 50021 AS k", "id").repartition(7)
    path = str(tmp_path / "s.tsv")
    plan = df.orderBy("k")._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" in plan and "SinglePartition" not in plan
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for _ in range(2):  # an earlier file is replaced
            sources.write_sorted_file(df, path, "k")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    got = [tuple(map(int, line.split("\t"))) for line in open(path)]
    assert got == sorted((i * 7919 % 50021, i) for i in range(50_000))
    sources.write_sorted_file(df.limit(0), path, "k")
    assert open(path).read() == ""


# -- rows of any width -----------------------------------------------------------

def test_wide_rows_are_the_golden_lines(spark, tsv, tmp_path):
    a, b = (sources.read_matrix(spark, tsv(x)) for x in (ADD_A, ADD_B))
    path = str(tmp_path / "c.tsv")
    for chunk in (1, 2, 100):
        sources.write_wide_rows(matrix.subtract(a, b), path, F.concat(F.lit("C:"), F.col("i")), chunk=chunk)
        assert open(path, newline="").read() == DIFFERENCE
    letters = sources.read_matrix(spark, tsv(LETTERS), value_type="string")
    sources.write_wide_rows(matrix.transpose(letters), path, F.concat(F.lit("A"), F.col("i")), chunk=2)
    back = sources.read_matrix(spark, path, value_type="string")
    assert {r.i: r.row for r in matrix.to_rows(back).collect()} == LETTERS_T


def test_a_row_wider_than_a_task(spark, tmp_path):
    n = 400_000
    cells = spark.range(2 * n).selectExpr("id % 2 * 5 + 3 AS i", "id DIV 2 + 1 AS j", "cast(id AS double) AS v")
    pieces = matrix.row_chunks(cells, 1000)
    most = pieces.agg(F.max(F.size("row")).alias("m"), F.count(F.lit(1)).alias("n")).first()
    assert (most.m, most.n) == (1000, 2 * n // 1000)
    path = str(tmp_path / "wide.tsv")
    sources.write_wide_rows(cells, path, F.concat(F.lit("W"), F.col("i")), chunk=1000)
    lines = open(path).read().split("\n")
    assert len(lines) == 3 and lines[2] == ""
    for line, head, odd in zip(lines, ("W3", "W8"), (0, 1), strict=False):
        parts = line.split("\t")
        assert parts[0] == head and parts[-1] == "" and len(parts) == n + 2
        assert parts[1:4] == [f"{odd}.0", f"{odd + 2}.0", f"{odd + 4}.0"] and float(parts[-2]) == 2 * n - 2 + odd
        assert np.array_equal(np.array(parts[1:-1], float), np.arange(odd, 2 * n, 2))


def test_sparse_rows_and_missing_first_pieces(spark, tmp_path):
    cells = spark.createDataFrame([(2, 900, 1.0), (2, 5, None), (7, 901, 3.0), (4, 1, 2.0)], "i int, j int, v double")
    path = str(tmp_path / "sparse.tsv")
    sources.write_wide_rows(cells, path, F.concat(F.lit("R"), F.col("i")), chunk=100)
    assert open(path).read() == "R2\t\t1.0\t\nR4\t2.0\t\nR7\t3.0\t\n"


# -- one scan for several kinds --------------------------------------------------

MIXED = ["D1\t1.5\t2\t10", "ALPHA\t0.1\t0.2\t0.3\t", "D2\t4\t", "a\tx\t\t3", "a\ty"]
KINDS = {"rows": sources.Kind("id string, x array<double>, y double", prefix="D"),
         "weights": sources.Kind("w array<double>", tag="ALPHA"),
         "a": sources.Kind("name string, note string, n int", tag="a")}


def test_kinds_of_one_scan(spark, tsv):
    one, two = tsv(MIXED), tsv(["7\t2\t82.0\t97.0", "8\t\t1.0"])
    kinds = KINDS | {"obs": sources.Kind("id string, cluster int, x array<double>", path=two)}
    plan = routed_lines(spark, [one, two], kinds)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan text") == 1
    got = {k: sorted(map(tuple, f.collect()), key=str) for k, f in sources.read_kinds(spark, [one, two], kinds).items()}
    assert got == {"rows": [("D1", [1.5, 2.0], 10.0), ("D2", [4.0], None)], "weights": [([0.1, 0.2, 0.3],)],
                   "a": [("x", None, 3), ("y", None, None)], "obs": [("7", 2, [82.0, 97.0]), ("8", None, [1.0])]}
    frame = sources.read_kinds(spark, [one, two], kinds)["weights"]
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "kind=weights" in plan.replace(" ", "") or "PartitionFilters: [isnotnull(kind" in plan
    assert "r_rows" not in plan.split("ReadSchema")[1]


def test_lines_of_no_kind(spark, tsv):
    path = tsv([*MIXED, "zzz\t1", "a\tq\t\tbad"])
    with pytest.raises(Exception, match="a line of no kind|CAST_INVALID"):
        sources.read_kinds(spark, path, KINDS)
    got = sources.read_kinds(spark, path, KINDS, on_error="null")
    assert [r.line for r in got[None].collect()] == ["zzz\t1"]
    assert ("q", None, None) in [tuple(r) for r in got["a"].collect()]
    empty = sources.read_kinds(spark, tsv([]), KINDS)
    assert all(f.collect() == [] for f in empty.values())


# -- vector rows, arrays, keys ---------------------------------------------------

def test_empty_class_last_is_null(spark, tsv):
    path = tsv(["1\t2\t", "1\t2\tyes", "\tno", "1\t\t3\tmaybe", "\t"])
    got = sources.read_vectors(spark, path, tail="label string").collect()
    assert [tuple(r) for r in got] == [([1.0, 2.0], None), ([1.0, 2.0], "yes"), ([None], "no"), ([1.0, None, 3.0], "maybe"), ([None], None)]


def test_nulls_in_vectors_come_back(spark, tmp_path):
    rows = [(1, [1.0, None, 2.0]), (2, [None, 5.0]), (3, [7.0, None])]
    out = str(tmp_path / "v")
    sources.write_tsv(spark.createDataFrame(rows, "k int, v array<double>"), out)
    back = sources.read_vectors(spark, out, lead="k int", features="v", trim=False)
    assert sorted(map(tuple, back.collect())) == rows


@pytest.mark.parametrize("bad", ["a\tb", "a\nb", "\r"])
def test_breaks_inside_arrays_are_refused(spark, tmp_path, bad):
    df = spark.createDataFrame([(["x", None, bad],)], "s array<string>")
    with pytest.raises(Exception, match="tab or line end in column s"):
        sources.write_tsv(df, str(tmp_path / "bad"))
    sources.write_tsv(spark.createDataFrame([(["x", None, "y"],), (None,)], "s array<string>"), str(tmp_path / "ok"))
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "ok")).collect()) == ["", "x\t\ty"]


def test_keys_that_look_like_markers(spark, tmp_path):
    keys = ["", None, "__EMPTY__", "__EMPTY__x", "__KEY__", "__KEY____EMPTY__", "__HIVE_DEFAULT_PARTITION__", "plain", "a=b/c", "01"]
    out = str(tmp_path / "k")
    sources.write_by_value(spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k string, v int"), out, "k")
    got = {r.v: r.k for r in sources.read_by_value(spark, out, "v int", "k").collect()}
    assert got == dict(enumerate(keys))


# -- moments ---------------------------------------------------------------------

@pytest.mark.parametrize("splits", [1, 7, 400])
def test_states_of_any_split_give_the_variance(spark, splits):
    values = [1e8 + 0.1 * i for i in range(400)]
    rows = [(i * 17 % splits, "ab"[i % 2] if i % 5 else None, v) for i, v in enumerate(values)]
    df = spark.createDataFrame([*rows, (0, "a", None), (0, "only null", None), (1, "one", 5.0)], "part int, g string, x double")
    parts = stats.moment_state(df, "x", by=["part", "g"])
    got = {r.g: r for r in stats.merge_moments(parts, by="g").select("g", *stats.moments_of()).collect()}
    for g in ("a", "b", None):
        mine = [v for _, k, v in rows if k == g]
        assert got[g].n == len(mine)
        assert got[g].mean == pytest.approx(statistics.fmean(mine), rel=1e-15)
        assert got[g].var == pytest.approx(np.var(np.array(mine) - 1e8, ddof=1), rel=1e-7)
    assert tuple(got["one"])[1:] == (1, 5.0, None) and tuple(got["only null"])[1:] == (0, None, None)
    whole = stats.merge_moments(stats.merge_moments(parts.where("g is null or g != 'one'"), by="g"))
    one = whole.select(*stats.moments_of()).first()
    assert (one.n, one.var) == (400, pytest.approx(np.var(np.arange(400) * 0.1, ddof=1), rel=1e-7))
    direct = stats.moment_state(df.where("x > 100"), "x").select(*stats.moments_of()).first()
    assert direct.var == pytest.approx(one.var, rel=1e-7)


def test_moments_of_nothing(spark):
    none = spark.createDataFrame([], "g string, x double")
    assert stats.merge_moments(stats.moment_state(none, "x", by="g"), by="g").collect() == []
    assert tuple(stats.merge_moments(stats.moment_state(none, "x")).select(*stats.moments_of()).first()) == (0, None, None)


def test_parts_are_copied_in_the_order_of_their_numbers(spark, tmp_path):
    folder = tmp_path / "p"
    folder.mkdir()
    for n, text in ((2, "c"), (100000, "z"), (10, "d"), (0, "a"), (99999, "y"), (1, "b")):
        (folder / f"part-{n:05d}-x.txt").write_text(text)
    (folder / "_SUCCESS").write_text("no")
    files.concatenate(spark, str(folder), str(tmp_path / "all"), end=b"!")
    assert (tmp_path / "all").read_text() == "abcdyz!"
