"""Guards on the physical plans of the registered queries."""

import contextlib
import io
import os

import pytest

import __spark_entry__ as entry
from quarry.operators import cluster, graph
from quarry.plans import catalog

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables absent")


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@contextlib.contextmanager
def _watched(plans):
    """Collects the plan of every frame that an operator writes."""
    from pyspark.sql.readwriter import DataFrameWriter
    real = DataFrameWriter.parquet

    def parquet(self, *args, **kwargs):
        plans.append(_plan(self._df))
        return real(self, *args, **kwargs)
    DataFrameWriter.parquet = parquet
    try:
        yield
    finally:
        DataFrameWriter.parquet = real


@pytest.mark.parametrize("key", sorted(catalog.QUERIES))
def test_no_cartesian_product(spark, key):
    plans = []
    with _watched(plans):  # the rounds of iterative operators too
        plans.append(_plan(catalog.QUERIES[key](spark, SF)))
    for plan in plans:
        assert "CartesianProduct" not in plan
        assert "BroadcastNestedLoopJoin" not in plan


def test_rounds_are_watched(spark):
    plans = []
    with _watched(plans):
        catalog.QUERIES["bfs"](spark, SF)
    assert len(plans) > 3 and any("Join" in p for p in plans)


def test_scans_are_pruned(spark):
    plan = _plan(entry.queries()["equi_join"](spark, SF))
    assert "ReadSchema: struct<c_name:string,c_nationkey:int>" in plan
    assert "ReadSchema: struct<s_name:string,s_nationkey:int>" in plan


def test_aggregates_are_partial(spark):
    plan = _plan(entry.queries()["gaussian_nb"](spark, SF))
    main = plan.split("===== Subqueries")[0]
    assert main.count("HashAggregate") >= 2 and "partial_avg" in main


def test_kmeans_assign_does_not_shuffle_observations(spark):
    obs = catalog._observations(spark, SF)
    plan = _plan(cluster.kmeans_assign(obs, cluster.kmeans_update(obs)))
    assert "Exchange" not in plan


def test_bfs_result_is_one_scan(spark):
    plan = _plan(catalog.QUERIES["bfs"](spark, SF))
    assert plan.count("Scan parquet") == 2  # the node of the tree and its detail


def _above(plan, what):
    """For every line of a printed plan with ``what``: the lines it hangs from, up
    to the nearest join."""
    stack, out = [], []
    for line in plan.split("\n"):
        name = line.lstrip(" :+-")
        depth = len(line) - len(name)
        while stack and stack[-1][0] >= depth:
            stack.pop()
        if what in line:
            path = []
            for _, x in reversed(stack):
                path.append(x)
                if "Join" in x:
                    break
            out.append(path)
        stack.append((depth, name))
    return out


@pytest.mark.parametrize("upwards", [False, True])
def test_bfs_round_does_not_move_the_edges(spark, upwards, monkeypatch):
    monkeypatch.setattr(graph, "LOOKUP", 0)
    monkeypatch.setattr(graph, "HUB", 1e9)
    edges = spark.range(4000).selectExpr("id % 500 AS src", "id * 7 % 3001 AS dst")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with graph.edge_store(edges) as store:
            frontier = store.nodes.where("node % 3 = 0").select("node")
            rows = frontier.count()
            visited = store.n_nodes - 1 if upwards else rows
            step = graph.next_frontier(store, frontier, rows, None, lambda: frontier, visited)
            plan = step._jdf.queryExecution().executedPlan().toString()
            paths = _above(plan, "quarry_edges")
            assert paths and "Bucketed: true" in plan
            for path in paths:
                assert "Join" in path[-1] and not any("Exchange" in x for x in path)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_bfs_with_a_small_frontier_reads_few_buckets(spark):
    edges = spark.range(4000).selectExpr("id % 500 AS src", "id * 7 % 3001 AS dst")
    with graph.edge_store(edges) as store:
        few = store.nodes.where("node in (3, 8)").select("node")
        plan = store.neighbours(few, 2)._jdf.queryExecution().executedPlan().toString()
        assert "PushedFilters: [In(src, [3,8])]" in plan and "Exchange" not in plan


def test_descent_scans_once(spark):
    plans = []
    with _watched(plans):
        catalog.QUERIES["linreg_gd_many"](spark, SF)
    assert sum("MapInArrow" in p for p in plans) <= 1
