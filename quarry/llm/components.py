"""Connected components of a link table by contraction.

A round points every node to the smallest of itself and its neighbours, follows
the pointers once more, and moves the links to where their ends point; links
within one point go.  At most half of the nodes remain in a round, and links
between hubs and their neighbours, as most are, go in the first one.  The loop
ends when no link is left, so nothing is computed twice to see that it stands.
Rounds are written below the checkpoint folder, in files sized by the rows known
before; only row counts reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from quarry.plans.materialize import materialize, materialize_observed

#: rows of a written round that share a file
FILE_ROWS = 100_000


def sized(df: DataFrame, rows: int) -> DataFrame:
    """``df`` in no more partitions than ``rows`` (an upper bound of its size) or the
    cores need."""
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // FILE_ROWS)))


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``links`` (a, b) to (node, label): label is the smallest node reachable.
    Nodes that are their own label, or without links, are absent; null ends are
    ignored."""
    edges, _, seen = materialize_observed(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct(), "links")
    label = None
    rows = seen["rows"]
    while rows:
        low = (edges.select(F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("e"))
               .groupBy(F.col("e.u").alias("u")).agg(F.min("e.v").alias("v"))
               .select("u", F.least("u", "v").alias("m")))
        ahead = low.select(F.col("u").alias("m"), F.col("m").alias("to"))
        point, _ = materialize(sized(low.join(ahead, "m").select("u", "to"), 2 * rows), "points")
        label = point.withColumnsRenamed({"u": "node", "to": "label"}) if label is None else renamed(label, point, "u", "to")
        moved = (edges.join(point.withColumnRenamed("to", "tu"), "u")
                 .join(point.select(F.col("u").alias("v"), F.col("to").alias("tv")), "v")
                 .filter("tu != tv").select(F.greatest("tu", "tv").alias("u"), F.least("tu", "tv").alias("v")).distinct())
        edges, _, seen = materialize_observed(sized(moved, rows), "links")
        rows = seen["rows"]
    if label is None:
        return edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return materialize(label.filter("node != label"), "labels")[0]


def renamed(label: DataFrame, by: DataFrame, node: str, to: str) -> DataFrame:
    """``label`` (node, label) with the labels listed in ``by`` replaced."""
    again = by.select(F.col(node).alias("label"), F.col(to).alias("__q_to"))
    return label.join(again, "label", "left").select("node", F.coalesce("__q_to", "label").alias("label"))


def extended(label: DataFrame, links: DataFrame, a: str, b: str) -> DataFrame:
    """Labels after further ``links``: only the labels of their ends are joined,
    none of the nodes labelled before is looked at again but to rename it."""
    ends = links.select(F.col(a).alias("a"), F.col(b).alias("b"))
    for end in ("a", "b"):
        own = label.select(F.col("node").alias(end), F.col("label").alias("__q_label"))
        ends = ends.join(own, end, "left").withColumn(end, F.coalesce("__q_label", end)).drop("__q_label")
    more = components(ends, "a", "b")
    return materialize(renamed(label, more, "node", "label").union(more.select("node", "label")), "labels")[0]
