"""Vector rows, formatted lines and typed keys of tab-separated text."""

import pytest
from pyspark.sql import functions as F

from quarry import sources


def lines_of(spark, path):
    return sorted(r["value"] for r in spark.read.text(path).collect())


def test_vector_rows_of_any_width(spark, tsv):
    path = tsv(["D1\t1.5\t2\t10", "ALPHA\t0.1\t0.2\t0.3", "D2\t4\t20"])
    rows = sources.read_vectors(spark, path, lead="id string", tail="y double", prefix="D").collect()
    assert sorted(tuple(r) for r in rows) == [("D1", [1.5, 2.0], 10.0), ("D2", [4.0], 20.0)]
    w = sources.read_weights(spark, path).collect()
    assert sorted(tuple(r) for r in w) == [(1, 0.1), (2, 0.2), (3, 0.3)]
    obs = sources.read_vectors(spark, tsv(["7\t2\t82.0\t97.0\t1.0"]), lead="id string, cluster int").first()
    assert tuple(obs) == ("7", 2, [82.0, 97.0, 1.0])
    last = sources.read_vectors(spark, tsv(["1\t2\t3\tyes", "4\tno"]), tail="label string").collect()
    assert sorted(tuple(r) for r in last) == [([1.0, 2.0, 3.0], "yes"), ([4.0], "no")]


def test_unknown_tags_do_not_vanish(spark, tsv):
    path = tsv(["a\t1", "c\t2\tx", "a\t\t"])
    with pytest.raises(Exception, match="unknown tag"):
        sources.read_tagged(spark, path, {"a": "n int, s string"})["a"].collect()
    frames = sources.read_tagged(spark, path, {"a": "n int, s string"}, on_error="null")
    assert [tuple(r) for r in frames[None].collect()] == [("c", "c\t2\tx")]
    assert sorted(frames["a"].collect(), key=str) == [(1, None), (None, None)]


def test_null_tail_is_read_back(spark, tmp_path):
    out = str(tmp_path / "t")
    sources.write_tsv(spark.createDataFrame([("a", 1, None), ("a", None, "z")], "t string, n int, s string"), out)
    got = sources.read_tagged(spark, out, {"a": "n int, s string"})["a"].collect()
    assert sorted(got, key=str) == [(1, None), (None, "z")]


def test_formatted_lines(spark, tmp_path):
    df = spark.createDataFrame([(1, [11.0, 2.5]), (2, [0.0, 1.0])], "i int, row array<double>")
    sources.write_lines(df, str(tmp_path / "c"), "C{i}\t{row}")
    assert lines_of(spark, str(tmp_path / "c")) == ["C1\t11.0\t2.5", "C2\t0.0\t1.0"]
    nb = spark.createDataFrame([("yes", 0, 1.5, None)], "label string, pos int, mean double, var double")
    sources.write_lines(nb, str(tmp_path / "n"), "{label},{pos}\tmean = {mean}\tvar = {var}", single_file=True)
    assert lines_of(spark, str(tmp_path / "n")) == ["yes,0\tmean = 1.5\tvar = "]


def test_tabs_and_line_ends_are_refused(spark, tmp_path):
    for bad in ("x\ty", "p\nq", "r\r"):
        with pytest.raises(Exception, match="tab or line end"):
            sources.write_tsv(spark.createDataFrame([(bad,)], "s string"), str(tmp_path / "bad"))


def test_keys_keep_their_type(spark, tmp_path):
    out = str(tmp_path / "k")
    df = spark.createDataFrame([("01", 1), ("1", 2), ("", 3), (None, 4)], "k string, v int")
    sources.write_by_value(df, out, "k")
    got = {r["v"]: r["k"] for r in sources.read_by_value(spark, out, "v int", "k").collect()}
    assert got == {1: "01", 2: "1", 3: "", 4: None}
    nums = str(tmp_path / "n")
    # a blank line is no record, so every row has a second field
    sources.write_by_value(df.select(F.col("v").alias("k"), "k", F.lit("x")).toDF("k", "s", "t"), nums, "k")
    got = sources.read_by_value(spark, nums, "s string, t string", "k", "int").collect()
    assert sorted((r["k"], r["s"]) for r in got if r["s"]) == [(1, "01"), (2, "1")] and {r["k"] for r in got} == {1, 2, 3, 4}


def test_matrix_rows_beyond_int(spark, tsv):
    path = tsv(["A1\t1", "A99999999999\t2"])
    got = sources.read_matrix(spark, path, on_error="null").collect()
    assert [(r["i"], r["v"]) for r in got] == [(1, 1.0)]
    with pytest.raises(Exception):
        sources.read_matrix(spark, path).collect()
