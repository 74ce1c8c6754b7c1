"""Registered queries: each operator run over the driver's whole tables.

Every function takes ``(spark, sf_dir)`` and returns a DataFrame whose column
names equal those of the matching oracle SQL in ``quarry.plans.oracle``.
Doubles are rounded to 6 places at the very end (presentation only).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from quarry import sources
from quarry.operators import cluster, graph, matrix, regression, relational, stats, text
from quarry.plans.tables import round_doubles, table
from quarry.session import scratch_path


def _embedding_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """embeddings as ``(vec_id, label, pos, x double)``, positions 0-based."""
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", "label",
                    F.posexplode("embedding").alias("pos", "x")) \
            .withColumn("x", F.col("x").cast("double"))


# -- relational ---------------------------------------------------------------

def q_equi_join(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    c = table(spark, sf_dir, "customer")
    return relational.equi_join(s, c, [("s_nationkey", "c_nationkey")],
                                ["s_name"], ["c_name"], split_hot=True)


def q_equi_join_lines(spark, sf_dir):
    """Many-to-many join whose output grows with the input: the lines of one
    order among themselves."""
    li = table(spark, sf_dir, "lineitem")
    return relational.equi_join(
        li.select("l_orderkey", F.col("l_partkey").alias("part_a")),
        li.select("l_orderkey", F.col("l_suppkey").alias("supp_b")),
        "l_orderkey", ["part_a"], ["supp_b"])


def q_distinct_count(spark, sf_dir):
    return relational.distinct_count(table(spark, sf_dir, "lineitem"), "l_partkey")


# -- aggregates ---------------------------------------------------------------

def q_mean_count(spark, sf_dir):
    return round_doubles(stats.mean_count(table(spark, sf_dir, "lineitem"), "l_quantity"))


def q_mean_count_by(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return round_doubles(stats.mean_count(li, "l_quantity", by="l_returnflag"))


def q_merge_mean_count(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    partials = stats.mean_count(li, "l_quantity", by="l_suppkey")
    return round_doubles(stats.merge_mean_count(partials))


def q_sum_squares(spark, sf_dir):
    ev = _embedding_values(spark, sf_dir)
    return round_doubles(stats.sum_squares(ev, "x", by=["label", "pos"]))


def q_variance_from_moments(spark, sf_dir):
    ev = _embedding_values(spark, sf_dir)
    means = stats.mean_count(ev, "x", by=["label", "pos"])
    ss = stats.sum_squares(ev, "x", by=["label", "pos"])
    return round_doubles(stats.variance_from_moments(means, ss, ["label", "pos"]))


def q_merge_moments(spark, sf_dir):
    """Moments per supplier and flag merged to the flags; the values are large
    against their spread."""
    li = table(spark, sf_dir, "lineitem").withColumn("x", F.col("l_quantity") + 1e6)
    parts = stats.moment_state(li, "x", by=["l_returnflag", "l_suppkey"])
    return round_doubles(stats.merge_moments(parts, by="l_returnflag").select("l_returnflag", *stats.moments_of()), 4)


def _returns(spark, sf_dir):
    """lineitem quantities by return flag, flag 'A' made NULL."""
    return table(spark, sf_dir, "lineitem").select(
        F.nullif("l_returnflag", F.lit("A")).alias("flag"), F.col("l_quantity").cast("double").alias("x"))


def q_variance_null_key(spark, sf_dir):
    rows = _returns(spark, sf_dir)
    return round_doubles(stats.variance_from_moments(
        stats.mean_count(rows, "x", by="flag"), stats.sum_squares(rows, "x", by="flag"), "flag"))


def q_gaussian_nb_ragged(spark, sf_dir):
    """Vectors of different length: the first vec_id % 3 values, NULL for 0."""
    e = table(spark, sf_dir, "embeddings")
    n = (F.col("vec_id") % 3).cast("int")
    rows = e.select("label", F.when(n > 0, F.slice("embedding", F.lit(1), n)).alias("v"))
    return round_doubles(stats.gaussian_nb_train(rows, "label", "v"))


def q_class_prior(spark, sf_dir):
    return round_doubles(stats.class_prior(table(spark, sf_dir, "embeddings"), "label"))


def q_gaussian_nb(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    return round_doubles(stats.gaussian_nb_train(e, "label", "embedding"))


# -- matrices -----------------------------------------------------------------

def _embedding_cells(spark, sf_dir, shift=0):
    """embeddings as a matrix: row ``vec_id + shift``, column 1..64."""
    e = table(spark, sf_dir, "embeddings")
    return matrix.to_cells(e.select((F.col("vec_id") + shift).alias("i"), "embedding"),
                           "i", "embedding")


def q_to_cells(spark, sf_dir):
    return round_doubles(_embedding_cells(spark, sf_dir))


def q_to_rows(spark, sf_dir):
    rows = matrix.to_rows(_embedding_cells(spark, sf_dir))
    return round_doubles(rows.select(
        "i", F.size("row").alias("n"), F.get("row", 0).alias("first"),
        F.element_at("row", -1).alias("last")))


def q_to_rows_all(spark, sf_dir):
    rows = matrix.to_rows(_embedding_cells(spark, sf_dir))
    return round_doubles(rows.select("i", F.posexplode("row").alias("pos", "v")))


def q_transpose(spark, sf_dir):
    return round_doubles(matrix.transpose(_embedding_cells(spark, sf_dir)))


def q_scale(spark, sf_dir):
    return round_doubles(matrix.scale(_embedding_cells(spark, sf_dir), 2.5))


def q_add(spark, sf_dir):
    a = _embedding_cells(spark, sf_dir)
    b = _embedding_cells(spark, sf_dir, shift=1)
    return round_doubles(matrix.add(a, b))


def q_subtract(spark, sf_dir):
    a = _embedding_cells(spark, sf_dir)
    b = _embedding_cells(spark, sf_dir, shift=1)
    return round_doubles(matrix.subtract(a, b))


def q_matmul(spark, sf_dir):
    cells = _embedding_cells(spark, sf_dir)
    gram = matrix.matmul(matrix.transpose(cells), cells)
    return round_doubles(gram.select("i", F.col("j").alias("k"), "v"))


def q_matmul_blocked(spark, sf_dir):
    cells = _embedding_cells(spark, sf_dir)
    gram = matrix.matmul_blocked(matrix.transpose(cells), cells, block=128)
    return round_doubles(gram.select(F.col("i").cast("int").alias("i"),
                                     F.col("j").cast("int").alias("k"), "v"))


# -- sources and sinks -------------------------------------------------------

def q_read_tsv(spark, sf_dir):
    cust = table(spark, sf_dir, "customer")
    path = scratch_path(spark, "read_tsv")
    sources.write_tsv(cust, path)
    return round_doubles(sources.read_tsv(spark, path, cust.schema))


def q_write_tsv(spark, sf_dir):
    """Arrays and NULLs written as text and read back as vector rows."""
    e = table(spark, sf_dir, "embeddings")
    path = scratch_path(spark, "write_tsv")
    sources.write_tsv(e.select("vec_id", F.nullif("label", F.lit(0)).alias("label"),
                               F.col("embedding").cast("array<double>").alias("v")), path)
    back = sources.read_vectors(spark, path, lead="vec_id bigint, label int", features="v")
    return round_doubles(back.select("vec_id", "label", F.posexplode("v").alias("pos", "v")))


def q_read_tagged(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    path = scratch_path(spark, "read_tagged")
    tagged = s.select(F.lit("a").alias("t"), "s_nationkey", "s_name").unionByName(
        n.select(F.lit("b").alias("t"), F.col("n_nationkey").alias("s_nationkey"),
                 F.col("n_name").alias("s_name")))
    sources.write_tsv(tagged, path)
    frames = sources.read_tagged(spark, path, {"a": "key int, s_name string",
                                               "b": "key int, n_name string"})
    return relational.equi_join(frames["a"], frames["b"], "key", ["s_name"], ["n_name"])


def q_read_matrix(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    path = scratch_path(spark, "read_matrix")
    rows = e.select(F.concat(F.lit("E"), F.col("vec_id").cast("string")).alias("h"),
                    F.col("embedding").cast("array<double>").alias("row"))
    sources.write_tsv(rows, path)
    return round_doubles(sources.read_matrix(spark, path))


def q_write_by_value(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
    path = scratch_path(spark, "write_by_value")
    sources.write_by_value(o, path, "o_orderpriority")
    back = sources.read_tsv(spark, path,
                            "o_orderkey bigint, o_custkey bigint, o_totalprice double")
    return round_doubles(back.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("total")))


def q_read_class_last(spark, sf_dir):
    """Vectors with the class last, which is empty for class 0."""
    e = table(spark, sf_dir, "embeddings")
    path = scratch_path(spark, "class_last")
    sources.write_tsv(e.select("vec_id", F.col("embedding").cast("array<double>").alias("v"),
                               F.nullif("label", F.lit(0)).alias("label")), path)
    back = sources.read_vectors(spark, path, lead="vec_id bigint", tail="label int", features="v")
    return round_doubles(back.select("vec_id", "label", F.posexplode("v").alias("pos", "v")))


def q_write_parts(spark, sf_dir):
    """One file per nation, its number the nation key."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    path = scratch_path(spark, "write_parts")
    sources.write_parts(c, path, "c_nationkey", 25)
    return sources.read_parts(spark, path, "c_custkey bigint, c_name string, c_nationkey int", number="file_no")


def q_read_kinds(spark, sf_dir):
    """Tagged suppliers and nations in one folder, customers in another, read in
    one scan: suppliers and customers per nation name."""
    s, n, c = (table(spark, sf_dir, t) for t in ("supplier", "nation", "customer"))
    mixed, plain = scratch_path(spark, "kinds_mixed"), scratch_path(spark, "kinds_plain")
    sources.write_tsv(s.select(F.lit("a").alias("t"), "s_nationkey", "s_name").union(
        n.select(F.lit("b"), "n_nationkey", "n_name")), mixed)
    sources.write_tsv(c.select("c_nationkey", "c_custkey", "c_acctbal"), plain)
    kinds = sources.read_kinds(spark, [mixed, plain], {
        "supplier": sources.Kind("key int, s_name string", tag="a", path=mixed),
        "nation": sources.Kind("key int, n_name string", tag="b", path=mixed),
        "customer": sources.Kind("key int, rest array<double>", path=plain)})
    per_s = kinds["supplier"].groupBy("key").agg(F.count("s_name").alias("suppliers"))
    per_c = kinds["customer"].groupBy("key").agg(F.count(F.lit(1)).alias("customers"), F.sum(F.get("rest", 1)).alias("balance"))
    return round_doubles(kinds["nation"].join(per_s, "key", "left").join(per_c, "key", "left")
                         .select("n_name", F.coalesce("suppliers", F.lit(0)).alias("suppliers"),
                                 F.coalesce("customers", F.lit(0)).alias("customers"), "balance"), 2)


def q_write_sorted_file(spark, sf_dir):
    """Orders by falling price as one file."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    path = f"{scratch_path(spark, 'sorted')}.tsv"
    sources.write_sorted_file(o, path, F.desc("o_totalprice"), "o_orderkey")
    return round_doubles(sources.read_tsv(spark, path, o.schema))


def q_write_wide_rows(spark, sf_dir):
    """The embeddings transposed -- 64 rows as wide as the table is long -- as text
    lines and back."""
    path = f"{scratch_path(spark, 'wide')}.tsv"
    sources.write_wide_rows(matrix.transpose(_embedding_cells(spark, sf_dir)), path,
                            F.concat(F.lit("E"), F.col("i")), chunk=128, base=0)
    return round_doubles(sources.read_matrix(spark, path))


# -- graphs -------------------------------------------------------------------

BFS_SOURCE = "p0"


def _order_part_edges(spark, sf_dir):
    """Graph of the whole lineitem table: order node -- part node."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.concat(F.lit("o"), F.col("l_orderkey").cast("string")).alias("src"),
                     F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("dst"))


def q_symmetrize(spark, sf_dir):
    return graph.symmetrize(_order_part_edges(spark, sf_dir))


def q_adjacency(spark, sf_dir):
    adj = graph.adjacency(graph.symmetrize(_order_part_edges(spark, sf_dir)))
    return adj.select("node", "part", F.array_join("neighbours", ",").alias("neighbours"))


def q_bfs(spark, sf_dir):
    return graph.bfs(_order_part_edges(spark, sf_dir), BFS_SOURCE)


def q_bfs_unreached(spark, sf_dir):
    return graph.bfs(_order_part_edges(spark, sf_dir), BFS_SOURCE, max_depth=2, include_unreached=True)


def q_bfs_null_ends(spark, sf_dir):
    """Every seventh line has lost its part."""
    li = table(spark, sf_dir, "lineitem")
    edges = li.select(
        F.concat(F.lit("o"), F.col("l_orderkey").cast("string")).alias("src"),
        F.when(F.col("l_orderkey") % 7 != 0, F.concat(F.lit("p"), F.col("l_partkey").cast("string"))).alias("dst"))
    return graph.bfs(edges, BFS_SOURCE)


# -- k-means ------------------------------------------------------------------

def _observations(spark, sf_dir):
    """embeddings as observations, initial cluster = vec_id mod 4."""
    e = table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("id"), (F.col("vec_id") % 4).alias("cluster"),
                    F.col("embedding").alias("features"))


def q_kmeans_update(spark, sf_dir):
    centers = cluster.kmeans_update(_observations(spark, sf_dir))
    return round_doubles(centers.select(
        "cluster", F.posexplode("center").alias("j", "mean"))
        .withColumn("j", F.col("j") + 1))


def q_kmeans_assign(spark, sf_dir):
    obs = _observations(spark, sf_dir)
    return cluster.kmeans_assign(obs, cluster.kmeans_update(obs)).select("id", "cluster")


def _many_observations(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("id"), (F.col("vec_id") % 32).alias("cluster"),
                    F.col("embedding").alias("features"))


def q_kmeans_assign_many(spark, sf_dir):
    obs = _many_observations(spark, sf_dir)
    return cluster.kmeans_assign(obs, cluster.kmeans_update(obs)).select("id", "cluster")


def q_kmeans_centers(spark, sf_dir):
    _, centers = cluster.kmeans(_observations(spark, sf_dir), max_rounds=2)
    return round_doubles(centers.select("cluster", F.posexplode("center").alias("j", "mean"))
                         .withColumn("j", F.col("j") + 1))


def q_kmeans_rounds(spark, sf_dir):
    """Ten rounds with 32 centres."""
    assignments, _ = cluster.kmeans(_many_observations(spark, sf_dir), max_rounds=9)
    return assignments.select("id", "cluster")


def q_kmeans(spark, sf_dir):
    assignments, _ = cluster.kmeans(_observations(spark, sf_dir), max_rounds=2)
    return assignments.select("id", "cluster")


# -- linear regression --------------------------------------------------------

def _regression_rows(spark, sf_dir):
    """embeddings as regression rows: x = embedding, y = label."""
    e = table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("id"), F.col("embedding").alias("x"),
                    F.col("label").cast("double").alias("y"))


def _ramp_weights(spark, sf_dir):
    """w_j = 0.01 * j for every feature position j found in the data."""
    cells = _embedding_cells(spark, sf_dir)
    return cells.select("j").distinct().select("j", (F.col("j") * 0.01).alias("w"))


def q_residuals(spark, sf_dir):
    rows = _regression_rows(spark, sf_dir)
    return round_doubles(regression.residuals(rows, _ramp_weights(spark, sf_dir)))


def q_gradient(spark, sf_dir):
    rows = _regression_rows(spark, sf_dir)
    return round_doubles(regression.gradient(
        regression.with_residual(rows, _ramp_weights(spark, sf_dir))))


def q_linreg_gd(spark, sf_dir):
    rows = _regression_rows(spark, sf_dir)
    w0 = spark.createDataFrame([], "j int, w double")
    return round_doubles(regression.linreg_gd(rows, w0, rate=0.01, iterations=2))


def q_linreg_gd_many(spark, sf_dir):
    """Fifty iterations, from start weights that also lie beyond the rows."""
    rows = _regression_rows(spark, sf_dir)
    w0 = spark.range(1, 131, 2).select(F.col("id").cast("int").alias("j"), (F.col("id") * 0.01).alias("w"))
    return round_doubles(regression.linreg_gd(rows, w0, rate=0.001, iterations=50))


# -- palindromes --------------------------------------------------------------

def q_palindromes_by_center(spark, sf_dir):
    return text.palindromes_by_center(table(spark, sf_dir, "part"), "p_partkey", "p_name")


def q_palindromes_by_center_docs(spark, sf_dir):
    """Every centre of every whole document, summed up per document."""
    per = text.palindrome_lengths(table(spark, sf_dir, "documents"), "doc_id", "text")
    return per.groupBy("id").agg(
        F.count(F.lit(1)).alias("centers"), F.sum("odd_len").alias("odd_chars"),
        F.coalesce(F.sum("even_len"), F.lit(0)).alias("even_chars"),
        F.greatest(F.max("odd_len"), F.coalesce(F.max("even_len"), F.lit(0))).alias("longest"))


def q_longest_palindrome(spark, sf_dir):
    return text.longest_palindrome(table(spark, sf_dir, "part"), "p_partkey", "p_name")


def q_longest_palindrome_all(spark, sf_dir):
    return text.longest_palindrome_all(table(spark, sf_dir, "part"), "p_partkey", "p_name")


def q_longest_palindrome_docs(spark, sf_dir):
    return text.longest_palindrome(table(spark, sf_dir, "documents"), "doc_id", "text")


QUERIES = {
    "equi_join": q_equi_join,
    "equi_join_lines": q_equi_join_lines,
    "distinct_count": q_distinct_count,
    "mean_count": q_mean_count,
    "mean_count_by": q_mean_count_by,
    "merge_mean_count": q_merge_mean_count,
    "sum_squares": q_sum_squares,
    "variance_from_moments": q_variance_from_moments,
    "variance_null_key": q_variance_null_key,
    "merge_moments": q_merge_moments,
    "class_prior": q_class_prior,
    "gaussian_nb": q_gaussian_nb,
    "gaussian_nb_ragged": q_gaussian_nb_ragged,
    "to_cells": q_to_cells,
    "to_rows": q_to_rows,
    "to_rows_all": q_to_rows_all,
    "transpose": q_transpose,
    "scale": q_scale,
    "add": q_add,
    "subtract": q_subtract,
    "matmul": q_matmul,
    "matmul_blocked": q_matmul_blocked,
    "read_tsv": q_read_tsv,
    "write_tsv": q_write_tsv,
    "read_tagged": q_read_tagged,
    "read_matrix": q_read_matrix,
    "write_by_value": q_write_by_value,
    "read_class_last": q_read_class_last,
    "read_kinds": q_read_kinds,
    "write_parts": q_write_parts,
    "write_sorted_file": q_write_sorted_file,
    "write_wide_rows": q_write_wide_rows,
    "symmetrize": q_symmetrize,
    "adjacency": q_adjacency,
    "bfs": q_bfs,
    "bfs_null_ends": q_bfs_null_ends,
    "bfs_unreached": q_bfs_unreached,
    "kmeans_update": q_kmeans_update,
    "kmeans_assign": q_kmeans_assign,
    "kmeans_assign_many": q_kmeans_assign_many,
    "kmeans": q_kmeans,
    "kmeans_centers": q_kmeans_centers,
    "kmeans_rounds": q_kmeans_rounds,
    "residuals": q_residuals,
    "gradient": q_gradient,
    "linreg_gd": q_linreg_gd,
    "linreg_gd_many": q_linreg_gd_many,
    "palindromes_by_center": q_palindromes_by_center,
    "palindromes_by_center_docs": q_palindromes_by_center_docs,
    "longest_palindrome": q_longest_palindrome,
    "longest_palindrome_all": q_longest_palindrome_all,
    "longest_palindrome_docs": q_longest_palindrome_docs,
}
