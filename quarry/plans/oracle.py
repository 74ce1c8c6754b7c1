"""DuckDB SQL that computes the same results as the registered queries.

The tables of the driver are views with their own names.  Doubles are rounded
to 6 places, integer sums cast to BIGINT, as in the Spark results.
"""

# embeddings as (vec_id, label, pos, x double), positions 0-based
_EV = """(SELECT vec_id, label,
                 CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS pos,
                 CAST(unnest(embedding) AS DOUBLE) AS x
          FROM embeddings)"""

# embeddings as matrix cells (i = vec_id + shift, j 1-based, v double)
def _cells(shift: int = 0) -> str:
    return f"""(SELECT vec_id + {shift} AS i,
                  CAST(generate_subscripts(embedding, 1) AS INTEGER) AS j,
                  CAST(unnest(embedding) AS DOUBLE) AS v
           FROM embeddings)"""


# order -- part graph of the whole lineitem table, both directions, distinct
_EDGES = """(SELECT 'o' || l_orderkey AS src, 'p' || l_partkey AS dst FROM lineitem
            UNION
            SELECT 'p' || l_partkey, 'o' || l_orderkey FROM lineitem)"""


# k-means: observations (id, cluster = vec_id % 4) and their cells
_KM_CELLS = """(SELECT vec_id AS id, CAST(generate_subscripts(embedding, 1) AS INTEGER) AS j,
                      CAST(unnest(embedding) AS DOUBLE) AS x
               FROM embeddings)"""


def _km_centres(assign: str) -> str:
    return f"""(SELECT a.cluster, c.j, avg(c.x) AS m
               FROM {assign} a JOIN {_KM_CELLS} c ON a.id = c.id
               GROUP BY a.cluster, c.j)"""


def _km_assign(centres: str) -> str:
    return f"""(SELECT id, first(cluster ORDER BY d, cluster) AS cluster FROM (
                   SELECT c.id, m.cluster, sum((c.x - m.m) * (c.x - m.m)) AS d
                   FROM {_KM_CELLS} c JOIN {centres} m ON c.j = m.j
                   GROUP BY c.id, m.cluster)
               GROUP BY id)"""


_KM_START = "(SELECT vec_id AS id, vec_id % 4 AS cluster FROM embeddings)"



def _km_rounds(k: int, rounds: int) -> str:
    """Update and assign ``rounds`` times from cluster = vec_id mod k."""
    start = f"(SELECT vec_id AS id, vec_id % {k} AS cluster FROM embeddings)"
    steps = [f"a{r} AS MATERIALIZED {_km_assign(_km_centres(start if r == 0 else f'a{r - 1}'))}" for r in range(rounds)]
    return f"WITH {', '.join(steps)} SELECT id, cluster FROM a{rounds - 1}"


# regression rows: (vec_id, y, j 1-based, x double)
_RG = """(SELECT vec_id, CAST(label AS DOUBLE) AS y,
                 CAST(generate_subscripts(embedding, 1) AS INTEGER) AS j,
                 CAST(unnest(embedding) AS DOUBLE) AS x
          FROM embeddings)"""


# palindromes of short names: every radius at every centre is tried; the
# valid radii at a centre are 0..R, so R is their maximum
_NAME_RADII = """
    WITH t AS (SELECT p_partkey AS id, p_name AS s, length(p_name) AS n
               FROM part WHERE length(p_name) > 0),
    cs AS (SELECT id, s, n, unnest(range(0, n)) AS ctr FROM t),
    o AS (SELECT id, ctr, max(r) AS r FROM (
              SELECT id, s, ctr, unnest(range(0, least(ctr, n - 1 - ctr) + 1)) AS r FROM cs)
          WHERE substr(s, ctr - r + 1, 2 * r + 1) = reverse(substr(s, ctr - r + 1, 2 * r + 1))
          GROUP BY id, ctr),
    e AS (SELECT id, ctr, max(r) AS r FROM (
              SELECT id, s, ctr, unnest(range(0, least(ctr + 1, n - 1 - ctr) + 1)) AS r
              FROM cs WHERE ctr < n - 1)
          WHERE substr(s, ctr - r + 2, 2 * r) = reverse(substr(s, ctr - r + 2, 2 * r))
          GROUP BY id, ctr),
    spans AS (SELECT id, ctr - r + 1 AS start, 2 * r + 1 AS len FROM o
              UNION ALL
              SELECT id, ctr - r + 2, 2 * r FROM e),
    best AS (SELECT id, start, len FROM (
                 SELECT *, row_number() OVER (PARTITION BY id ORDER BY len DESC, start) AS rk
                 FROM spans) WHERE rk = 1)"""

# palindromes of whole documents: centres grow one step per recursion round
# over a table of (global position, character); only growing centres recur.
_DOC_BEST = """
    WITH RECURSIVE
    ch AS MATERIALIZED (
        SELECT doc_id * 10000000 + generate_subscripts(string_split(text, ''), 1) AS g,
               unnest(string_split(text, '')) AS c
        FROM documents WHERE length(text) > 0),
    seed AS MATERIALIZED (
        SELECT a.g AS lo, a.g AS hi FROM ch a
        UNION ALL
        SELECT a.g, b.g FROM ch a JOIN ch b ON b.g = a.g + 1 WHERE a.c = b.c),
    grow(lo, hi) AS (
        SELECT * FROM seed
        UNION ALL
        SELECT g.lo - 1, g.hi + 1
        FROM grow g JOIN ch a ON a.g = g.lo - 1 JOIN ch b ON b.g = g.hi + 1
        WHERE a.c = b.c),
    best AS (SELECT doc_id, start, len FROM (
                 SELECT lo // 10000000 AS doc_id, lo % 10000000 AS start, hi - lo + 1 AS len,
                        row_number() OVER (PARTITION BY lo // 10000000
                                           ORDER BY hi - lo + 1 DESC, lo) AS rk
                 FROM grow) WHERE rk = 1)"""


ORACLE = {
    "equi_join": """
        SELECT s.s_name, c.c_name
        FROM supplier s JOIN customer c ON s.s_nationkey = c.c_nationkey""",
    "equi_join_lines": """
        SELECT a.l_partkey AS part_a, b.l_suppkey AS supp_b
        FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey""",
    "variance_null_key": """
        SELECT nullif(l_returnflag, 'A') AS flag, round(avg(CAST(l_quantity AS DOUBLE)), 6) AS mean,
               round(var_samp(CAST(l_quantity AS DOUBLE)), 6) AS var
        FROM lineitem GROUP BY 1""",
    "gaussian_nb_ragged": f"""
        WITH total AS (SELECT count(*) AS n FROM embeddings),
             c AS (SELECT label, count(*) AS k FROM embeddings GROUP BY label),
             m AS (SELECT label, pos, avg(x) AS mean, var_samp(x) AS var, count(x) AS count
                   FROM {_EV} WHERE pos < vec_id % 3 GROUP BY label, pos)
        SELECT c.label, m.pos, round(m.mean, 6) AS mean, round(m.var, 6) AS var,
               coalesce(m.count, 0) AS count, round(c.k / total.n, 6) AS prior
        FROM c CROSS JOIN total LEFT JOIN m ON m.label = c.label""",
    "to_rows_all": f"""
        SELECT vec_id AS i, pos, round(x, 6) AS v FROM {_EV}""",
    "write_tsv": f"""
        SELECT vec_id, nullif(label, 0) AS label, pos, round(x, 6) AS v FROM {_EV}""",
    "bfs_unreached": f"""
        WITH e AS {_EDGES},
        d1 AS (SELECT DISTINCT dst AS node FROM e WHERE src = 'p0'),
        d2 AS (SELECT DISTINCT e.dst AS node FROM e JOIN d1 ON e.src = d1.node
               WHERE e.dst <> 'p0' AND e.dst NOT IN (SELECT node FROM d1))
        SELECT n.node, CAST(CASE WHEN n.node = 'p0' THEN 0 WHEN d1.node IS NOT NULL THEN 1
                                 WHEN d2.node IS NOT NULL THEN 2 END AS INTEGER) AS dist
        FROM (SELECT DISTINCT src AS node FROM e) n
        LEFT JOIN d1 ON d1.node = n.node LEFT JOIN d2 ON d2.node = n.node""",
    "bfs_null_ends": f"""
        WITH RECURSIVE e AS (SELECT * FROM {_EDGES}
                             WHERE CAST(CASE WHEN src LIKE 'o%' THEN substr(src, 2) ELSE substr(dst, 2) END AS BIGINT) % 7 <> 0),
        reach(node, dist) USING KEY (node) AS (
            SELECT src, 0 FROM (SELECT DISTINCT src FROM e WHERE src = 'p0')
            UNION
            SELECT e.dst, min(r.dist) + 1
            FROM reach r JOIN e ON e.src = r.node
            WHERE NOT EXISTS (SELECT 1 FROM recurring.reach v WHERE v.node = e.dst)
            GROUP BY e.dst)
        SELECT node, dist FROM reach""",
    "kmeans_assign_many": f"""
        SELECT id, cluster FROM {_km_assign(_km_centres("(SELECT vec_id AS id, vec_id % 32 AS cluster FROM embeddings)"))}""",
    "kmeans_centers": f"""
        WITH a0 AS {_km_assign(_km_centres(_KM_START))},
             a1 AS {_km_assign(_km_centres('a0'))}
        SELECT cluster, j, round(m, 6) AS mean FROM {_km_centres('a1')}""",
    "distinct_count": """
        SELECT count(DISTINCT l_partkey) AS n FROM lineitem""",
    "mean_count": """
        SELECT round(avg(l_quantity), 6) AS mean, count(l_quantity) AS count
        FROM lineitem""",
    "mean_count_by": """
        SELECT l_returnflag, round(avg(l_quantity), 6) AS mean,
               count(l_quantity) AS count
        FROM lineitem GROUP BY l_returnflag""",
    "merge_mean_count": """
        SELECT round(avg(l_quantity), 6) AS mean, count(l_quantity) AS count
        FROM lineitem""",
    "sum_squares": f"""
        SELECT label, pos, round(sum(x * x), 6) AS sumsq
        FROM {_EV} GROUP BY label, pos""",
    "variance_from_moments": f"""
        SELECT label, pos, round(avg(x), 6) AS mean,
               round(CASE WHEN count(x) > 1 THEN
                   (sum(x * x) - count(x) * avg(x) * avg(x)) / (count(x) - 1) END, 6) AS var
        FROM {_EV} GROUP BY label, pos""",
    "class_prior": """
        SELECT label, round(count(*) / sum(count(*)) OVER (), 6) AS prior
        FROM embeddings GROUP BY label""",
    "gaussian_nb": f"""
        SELECT label, pos, round(avg(x), 6) AS mean, round(var_samp(x), 6) AS var,
               count(x) AS count,
               round(count(*) / (SELECT count(*) FROM embeddings), 6) AS prior
        FROM {_EV} GROUP BY label, pos""",
    "to_cells": f"""
        SELECT i, j, round(v, 6) AS v FROM {_cells()}""",
    "to_rows": """
        SELECT vec_id AS i, CAST(len(embedding) AS INTEGER) AS n,
               round(CAST(embedding[1] AS DOUBLE), 6) AS first,
               round(CAST(embedding[len(embedding)] AS DOUBLE), 6) AS last
        FROM embeddings""",
    "transpose": f"""
        SELECT j AS i, i AS j, round(v, 6) AS v FROM {_cells()}""",
    "scale": f"""
        SELECT i, j, round(2.5 * v, 6) AS v FROM {_cells()}""",
    "add": f"""
        SELECT coalesce(a.i, b.i) AS i, coalesce(a.j, b.j) AS j,
               round(coalesce(a.v, 0.0) + coalesce(b.v, 0.0), 6) AS v
        FROM {_cells()} a FULL JOIN {_cells(1)} b ON a.i = b.i AND a.j = b.j""",
    "subtract": f"""
        SELECT coalesce(a.i, b.i) AS i, coalesce(a.j, b.j) AS j,
               round(coalesce(a.v, 0.0) - coalesce(b.v, 0.0), 6) AS v
        FROM {_cells()} a FULL JOIN {_cells(1)} b ON a.i = b.i AND a.j = b.j""",
    "matmul": f"""
        SELECT a.j AS i, b.j AS k, round(sum(a.v * b.v), 6) AS v
        FROM {_cells()} a JOIN {_cells()} b ON a.i = b.i
        GROUP BY a.j, b.j""",
    "matmul_blocked": f"""
        SELECT a.j AS i, b.j AS k, round(sum(a.v * b.v), 6) AS v
        FROM {_cells()} a JOIN {_cells()} b ON a.i = b.i
        GROUP BY a.j, b.j""",
    "read_tsv": """
        SELECT c_custkey, c_name, c_nationkey, round(c_acctbal, 6) AS c_acctbal,
               c_mktsegment
        FROM customer""",
    "read_tagged": """
        SELECT s.s_name, n.n_name
        FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey""",
    "read_matrix": f"""
        SELECT 'E' AS matrix, CAST(i AS INTEGER) AS i, j, round(v, 6) AS v FROM {_cells()}""",
    "write_by_value": """
        SELECT o_orderpriority, count(*) AS n, round(sum(o_totalprice), 6) AS total
        FROM orders GROUP BY o_orderpriority""",
    "read_class_last": f"""
        SELECT vec_id, nullif(label, 0) AS label, pos, round(x, 6) AS v FROM {_EV}""",
    "read_kinds": """
        SELECT n_name,
               (SELECT count(*) FROM supplier WHERE s_nationkey = n_nationkey) AS suppliers,
               (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey) AS customers,
               (SELECT round(sum(c_acctbal), 2) FROM customer WHERE c_nationkey = n_nationkey) AS balance
        FROM nation""",
    "write_parts": """
        SELECT c_custkey, c_name, c_nationkey, c_nationkey AS file_no FROM customer""",
    "write_sorted_file": """
        SELECT o_orderkey, o_custkey, round(o_totalprice, 6) AS o_totalprice FROM orders""",
    "write_wide_rows": f"""
        SELECT 'E' AS matrix, j AS i, CAST(row_number() OVER (PARTITION BY j ORDER BY i) AS INTEGER) AS j, round(v, 6) AS v
        FROM {_cells()}""",
    "merge_moments": """
        SELECT l_returnflag, count(*) AS n, round(avg(CAST(l_quantity AS DOUBLE)) + 1e6, 4) AS mean,
               round(var_samp(CAST(l_quantity AS DOUBLE)), 4) AS var
        FROM lineitem GROUP BY l_returnflag""",
    "kmeans_rounds": _km_rounds(32, 10),
    "symmetrize": f"""
        SELECT src, dst FROM {_EDGES}""",
    "adjacency": f"""
        SELECT src AS node, 0 AS part, string_agg(dst, ',' ORDER BY dst) AS neighbours
        FROM {_EDGES} GROUP BY src""",
    "bfs": f"""
        WITH RECURSIVE e AS {_EDGES},
        reach(node, dist) USING KEY (node) AS (
            SELECT src, 0 FROM (SELECT DISTINCT src FROM e WHERE src = 'p0')
            UNION
            SELECT e.dst, min(r.dist) + 1
            FROM reach r JOIN e ON e.src = r.node
            WHERE NOT EXISTS (SELECT 1 FROM recurring.reach v WHERE v.node = e.dst)
            GROUP BY e.dst)
        SELECT node, dist FROM reach""",
    "kmeans_update": f"""
        SELECT cluster, j, round(m, 6) AS mean FROM {_km_centres(_KM_START)}""",
    "kmeans_assign": f"""
        SELECT id, cluster FROM {_km_assign(_km_centres(_KM_START))}""",
    "kmeans": f"""
        WITH a0 AS {_km_assign(_km_centres(_KM_START))},
             a1 AS {_km_assign(_km_centres('a0'))},
             a2 AS {_km_assign(_km_centres('a1'))}
        SELECT id, cluster FROM a2""",
    "residuals": f"""
        SELECT vec_id AS id, round(any_value(y) - sum(x * 0.01 * j), 6) AS e
        FROM {_RG} GROUP BY vec_id""",
    "gradient": f"""
        WITH e AS (SELECT vec_id, any_value(y) - sum(x * 0.01 * j) AS e
                   FROM {_RG} GROUP BY vec_id)
        SELECT r.j, round(sum(r.x * e.e), 6) AS g
        FROM {_RG} r JOIN e USING (vec_id) GROUP BY r.j""",
    "linreg_gd": f"""
        WITH r AS {_RG},
             w1 AS (SELECT j, 0.01 * sum(x * y) AS w FROM r GROUP BY j),
             e1 AS (SELECT r.vec_id, any_value(r.y) - sum(r.x * w1.w) AS e
                    FROM r JOIN w1 USING (j) GROUP BY r.vec_id),
             g2 AS (SELECT r.j, sum(r.x * e1.e) AS g
                    FROM r JOIN e1 USING (vec_id) GROUP BY r.j)
        SELECT w1.j, round(w1.w + 0.01 * g2.g, 6) AS w
        FROM w1 JOIN g2 USING (j)""",
    "linreg_gd_many": f"""
        WITH RECURSIVE r AS MATERIALIZED {_RG},
        g AS MATERIALIZED (SELECT a.j AS i, b.j, sum(a.x * b.x) AS v FROM r a JOIN r b USING (vec_id) GROUP BY a.j, b.j),
        sys AS MATERIALIZED (SELECT list(row ORDER BY i) AS gram, list(t ORDER BY i) AS target
                FROM (SELECT i, list(v ORDER BY j) AS row FROM g GROUP BY i)
                JOIN (SELECT j AS i, sum(x * y) AS t FROM r GROUP BY j) USING (i)),
        step(n, w) AS (
            SELECT 0, list_transform(range(1, len(target) + 1), lambda j: CASE WHEN j % 2 = 1 THEN 0.01 * CAST(j AS DOUBLE) ELSE 0.0 END)
            FROM sys
            UNION ALL
            SELECT n + 1, list_transform(range(1, len(target) + 1), lambda j: w[j] + 0.001 * (target[j] - list_dot_product(gram[j], w)))
            FROM step, sys WHERE n < 50)
        SELECT CAST(j AS INTEGER) AS j, round(w, 6) AS w
        FROM (SELECT unnest(range(1, len(w) + 1)) AS j, unnest(w) AS w FROM step WHERE n = 50)
        UNION ALL
        SELECT CAST(j AS INTEGER), round(0.01 * j, 6) FROM range(1, 131, 2) t(j) WHERE j > (SELECT max(j) FROM r)""",
    "palindromes_by_center": _NAME_RADII + """
        SELECT cs.id, CAST(cs.ctr AS INTEGER) AS center,
               substr(cs.s, cs.ctr - o.r + 1, 2 * o.r + 1) AS odd,
               CASE WHEN cs.ctr < cs.n - 1 THEN substr(cs.s, cs.ctr - e.r + 2, 2 * e.r) END AS even
        FROM cs JOIN o USING (id, ctr) LEFT JOIN e USING (id, ctr)""",
    "palindromes_by_center_docs": _DOC_BEST + """,
        per AS (SELECT lo // 10000000 AS doc_id, lo + hi AS twice, max(hi - lo + 1) AS len
                FROM grow GROUP BY 1, 2)
        SELECT doc_id AS id, CAST(count(*) FILTER (WHERE len % 2 = 1) AS BIGINT) AS centers,
               CAST(sum(len) FILTER (WHERE len % 2 = 1) AS BIGINT) AS odd_chars,
               CAST(coalesce(sum(len) FILTER (WHERE len % 2 = 0), 0) AS BIGINT) AS even_chars,
               CAST(max(len) AS INTEGER) AS longest
        FROM per GROUP BY doc_id""",
    "longest_palindrome": _NAME_RADII + """
        SELECT p.p_partkey AS id,
               CAST(CASE WHEN p.p_name IS NOT NULL THEN coalesce(b.len, 0) END AS INTEGER) AS len,
               CASE WHEN p.p_name IS NOT NULL THEN coalesce(substr(p.p_name, b.start, b.len), '') END AS pal
        FROM part p LEFT JOIN best b ON b.id = p.p_partkey""",
    "longest_palindrome_all": _NAME_RADII + """
        SELECT b.id, CAST(b.len AS INTEGER) AS len, substr(p.p_name, b.start, b.len) AS pal
        FROM best b JOIN part p ON p.p_partkey = b.id
        ORDER BY b.len DESC, b.id LIMIT 1""",
    "longest_palindrome_docs": _DOC_BEST + """
        SELECT d.doc_id AS id,
               CAST(CASE WHEN d.text IS NOT NULL THEN coalesce(b.len, 0) END AS INTEGER) AS len,
               CASE WHEN d.text IS NOT NULL THEN coalesce(substr(d.text, b.start, b.len), '') END AS pal
        FROM documents d LEFT JOIN best b ON b.doc_id = d.doc_id""",
}
