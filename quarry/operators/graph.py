"""Undirected graphs held as edge tables ``(src, dst)``: symmetric closure,
neighbour lists and breadth-first hop distances."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from quarry.plans.materialize import materialize, materialize_observed
from quarry.session import scratch_path

#: a frontier of at most so many nodes is looked up by value: only the buckets and
#: row groups that hold them are read
LOOKUP = 1000
#: a node with more than so many times the mean of a bucket has its edges apart
HUB = 4


def _both_directions(edges: DataFrame, src: str, dst: str) -> DataFrame:
    # One scan of the input emits each edge both ways (no union of two scans).
    pair = F.explode(F.array(
        F.struct(F.col(src).alias("src"), F.col(dst).alias("dst")),
        F.struct(F.col(dst).alias("src"), F.col(src).alias("dst"))))
    return edges.select(pair.alias("_e")).select("_e.src", "_e.dst")


def symmetrize(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Every edge in both directions, once: ``(src, dst)``.

    Both directions come from one scan of the input; duplicates are removed
    by an aggregation that first de-duplicates inside each task.
    """
    return _both_directions(edges, src, dst).distinct()


def adjacency(edges: DataFrame, src: str = "src", dst: str = "dst", parts: int = 1) -> DataFrame:
    """Sorted neighbour list per node: ``(node, part, neighbours)``.

    Every node's list is dealt into at most ``parts`` pieces by a hash of the
    neighbour (pieces without a neighbour are absent); the pieces of a node
    together hold all its neighbours.  The rule is the same for every node, so
    a caller with hubs chooses ``parts`` to bound the longest list.  One lazy
    plan with one shuffle by (node, part).
    """
    part = F.pmod(F.xxhash64(F.col(dst)), F.lit(parts)).cast("int")
    return (edges.select(F.col(src).alias("node"), F.col(dst).alias("nb"), part.alias("part"))
            .groupBy("node", "part").agg(F.sort_array(F.collect_list("nb")).alias("neighbours")))


@dataclass
class EdgeStore:
    """Both directions of a graph's edges, written for rounds of expansion (an edge
    given twice stands twice: rounds de-duplicate what they reach).

    ``main`` is bucketed and sorted by ``src``: meeting a frontier moves the
    frontier, never the edges.  The edges of hubs -- at most a quarter as many
    nodes as buckets, by their degree -- would make one bucket too large and stand
    in ``hub``, split by size alone; the few hubs of a frontier reach them as a
    broadcast.  ``nodes`` is ``(node, degree)``.
    """

    main: DataFrame
    hub: DataFrame | None
    hubs: list
    nodes: DataFrame
    n_nodes: int

    def neighbours(self, frontier: DataFrame, rows: int) -> DataFrame:
        """``node``: the far ends of all edges of ``frontier``."""
        if rows <= LOOKUP:
            wanted = [r[0] for r in frontier.limit(LOOKUP).collect()]
            found = self.main.where(F.col("src").isin(wanted))
            hub = self.hub.where(F.col("src").isin(wanted)) if self.hub is not None else None
        else:
            found = frontier.join(self.main, frontier["node"] == F.col("src"))
            hub = None
            if self.hub is not None:
                few = F.broadcast(frontier.where(F.col("node").isin(self.hubs)))
                hub = self.hub.join(few, F.col("src") == few["node"])
        out = found.select(F.col("dst").alias("node"))
        return out if hub is None else out.unionByName(hub.select(F.col("dst").alias("node")))

    def with_neighbour_in(self, unvisited: DataFrame, frontier: DataFrame) -> DataFrame:
        """``node``: the ``unvisited`` ones that have a neighbour in ``frontier``."""
        mine = unvisited.join(self.main, unvisited["node"] == F.col("src")).select("src", "dst")
        if self.hub is not None:
            few = F.broadcast(unvisited.where(F.col("node").isin(self.hubs)))
            mine = mine.unionByName(self.hub.join(few, F.col("src") == few["node"]).select("src", "dst"))
        # an inner join (frontier nodes are unique): a semi join would be planned
        # below the first one and move all edges
        return (mine.join(frontier.select(F.col("node").alias("_f")), F.col("dst") == F.col("_f"))
                .select(F.col("src").alias("node")).distinct())


@contextmanager
def edge_store(edges: DataFrame, src: str = "src", dst: str = "dst"):
    """An ``EdgeStore`` below the checkpoint folder; edges with a NULL end are
    left out.  Its catalog entry goes when the block ends, its files stay with the
    other rounds."""
    spark = edges.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    both = _both_directions(edges.where(F.col(src).isNotNull() & F.col(dst).isNotNull()), src, dst)
    nodes, _, seen = materialize_observed(
        both.groupBy(F.col("src").alias("node")).agg(F.count(F.lit(1)).alias("degree")), "graph-nodes", edges=F.sum("degree"))
    bound = HUB * (seen["edges"] or 0) / buckets
    hubs = [r.node for r in nodes.where(F.col("degree") > bound).select("node").limit(buckets).collect()]
    plain, hub = both, None
    if hubs:
        plain = both.where(~F.col("src").isin(hubs))
        hub, _ = materialize(both.where(F.col("src").isin(hubs)), "graph-hub-edges")
    name = f"quarry_edges_{uuid.uuid4().hex}"
    (plain.repartition(buckets, "src").write.bucketBy(buckets, "src").sortBy("src")
     .option("path", scratch_path(spark, "graph-edges")).saveAsTable(name))
    try:
        yield EdgeStore(spark.table(name), hub, hubs, nodes, seen["rows"])
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def next_frontier(store: EdgeStore, frontier: DataFrame, rows: int, previous: DataFrame | None,
                  visited: Callable[[], DataFrame], n_visited: int) -> DataFrame:
    """The nodes one hop beyond ``frontier``; ``visited()`` has all so far.

    Downwards: the frontier's neighbours (marked new) and the last two frontiers
    (marked old) are grouped by node, and nodes with no old mark are next; the
    grouping de-duplicates inside each task first, so a hub reached from many
    nodes is shuffled once per task.  Upwards, when fewer nodes are left than
    the frontier has: each of those looks for a neighbour in the frontier, and
    only their edges move.
    """
    left = store.n_nodes - n_visited
    if not left:
        return frontier.limit(0)
    if left < rows and rows > LOOKUP:
        rest = store.nodes.select("node").join(visited().select("node"), "node", "left_anti")
        return store.with_neighbour_in(rest, frontier)
    seen = frontier.select("node", F.lit(False).alias("_new"))
    if previous is not None:
        seen = seen.unionByName(previous.select("node", F.lit(False).alias("_new")))
    reached = store.neighbours(frontier, rows).withColumn("_new", F.lit(True))
    return (reached.unionByName(seen).groupBy("node").agg(F.min("_new").alias("_new"))
            .where("_new").select("node"))


def bfs(edges: DataFrame, source, src: str = "src", dst: str = "dst",
        max_depth: int | None = None, include_unreached: bool = False) -> DataFrame:
    """Hop distance from ``source`` in an undirected, unweighted graph:
    ``(node, dist)`` for every reachable node, ordered by ``dist, node``.
    With ``include_unreached`` every node of the graph is listed and those
    not reached (or beyond ``max_depth``) have a NULL ``dist``, sorted last.

    Frontier expansion, one round per distance (``next_frontier``).  Because edges
    go both ways, the neighbours of frontier ``F_d`` lie in ``F_{d-1}``, ``F_d`` or
    ``F_{d+1}``, so a round looks at the last two frontiers or at the nodes not yet
    visited, whichever is less.  The edges are moved once, when they are written
    bucketed by node (``edge_store``); after that a round shuffles frontiers and
    candidates only.

    Each frontier is written as one ``dist=<d>`` directory of one folder, so
    the result is a single scan whatever the depth, and a lost executor costs
    one round.  Edges with a NULL end lead nowhere; their other end
    is still a node of the graph.  The loop ends at an empty frontier --
    unreachable nodes are absent from the result -- or after ``max_depth``
    rounds.
    """
    spark = edges.sparkSession
    base = scratch_path(spark, "bfs-frontiers")
    ends = F.explode(F.array(F.col(src), F.col(dst))).alias("node")
    kind = edges.select(ends).schema["node"].dataType.simpleString()

    def found() -> DataFrame:
        return spark.read.schema(f"node {kind}, dist int").parquet(base)

    def write(frontier: DataFrame, depth: int) -> tuple[DataFrame, int]:
        read, _, seen = materialize_observed(frontier, f"bfs-{depth}", path=f"{base}/dist={depth}")
        return read, seen["rows"]

    def at_source(nodes: DataFrame) -> DataFrame:
        return nodes.select("node").where(F.col("node") == F.lit(source)).limit(1)
    with edge_store(edges, src, dst) as store:
        frontier, rows = write(at_source(store.nodes), 0)
        if not rows:  # perhaps it has edges without another end only
            touching = edges.where((F.col(src) == F.lit(source)) | (F.col(dst) == F.lit(source)))
            write(at_source(touching.select(ends)), 0)
        previous, depth, total = None, 0, rows
        while rows and (max_depth is None or depth < max_depth):
            new = next_frontier(store, frontier, rows, previous, found, total)
            depth += 1
            previous, (frontier, rows) = frontier, write(new, depth)
            total += rows
    result = found()
    if include_unreached:
        nodes = edges.select(ends).where(F.col("node").isNotNull()).distinct()
        result = nodes.join(result, "node", "left")
    return result.orderBy(F.col("dist").asc_nulls_last(), "node")
