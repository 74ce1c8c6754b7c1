"""Interaction of five text filters over all orders of applying them.

A document is described by the set of filters it fails (a mask of five bits).
Counts per (part, mask) are all that the audit needs: in an order of filters a
document goes at the first filter of its mask.  The 120 orders are numbered
lexicographically by their Lehmer code, so that all orders with a given
beginning are one interval of ranks.  A mask therefore leaves at step ``s`` on a
few intervals; its counts are added at the start of each and taken off at its
end, and one running sum over the 120 ranks gives every order's figures.

Filters: A fewer than 200 words; B fewer than half of the words distinct; C more
than 2 % of the code points in A-Z; D one of ``#$%&*|``; E equal to the text of a
smaller doc_id anywhere in the table.

Defined results: a null text is the empty text (fails A, and E after the first);
a null part is the empty string and meets the empty one; a null id fails E
never, nor makes others fail it; rows that repeat an id with the same text fail
E together or not at all; a document is good (toxic) if any of its label rows
says 1; an empty table has no parts and gives no rows.  Other columns of the
tables are never read.  Texts of any length are judged whole.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quarry.plans.materialize import materialize

LETTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(LETTERS)]
_SPACE = r"[\x20\x09-\x0D]+"
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def removal_intervals(mask: int) -> list[tuple[int, int, int]]:
    """(step, first rank, end rank) of the orders in which a document failing
    the filters of ``mask`` (bit 0 is A) goes at that step."""
    out = []

    def walk(left: tuple[int, ...], rank: int, step: int) -> None:
        width = factorial(len(left) - 1)
        for digit, letter in enumerate(left):  # the next digit of the Lehmer code
            start = rank + digit * width
            if mask >> letter & 1:
                out.append((step, start, start + width))
            elif len(left) > 1:
                walk(left[:digit] + left[digit + 1:], start, step + 1)
    walk(tuple(range(len(LETTERS))), 0, 1)
    return out


def _differences(spark: SparkSession) -> DataFrame:
    """(mask, step, rank, sign): where the counts of a mask are added and taken
    off.  Touching intervals cancel; fewer than 3,000 rows whatever the input."""
    ends: dict[tuple[int, int, int], int] = {}
    for mask in range(1, 1 << len(LETTERS)):
        for step, lo, hi in removal_intervals(mask):
            ends[mask, step, lo] = ends.get((mask, step, lo), 0) + 1
            ends[mask, step, hi] = ends.get((mask, step, hi), 0) - 1
    rows = ", ".join(f"({m}, {s}, {r}, {v})" for (m, s, r), v in ends.items() if v and r < len(ORDERS))
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(mask, step, rank, sign)")


def own_mask(text: Column) -> Column:
    """Filters A to D as bits 0 to 3 of an int."""
    words = F.array_remove(F.split(text, _SPACE), "")
    n = F.size(words)
    capitals = F.length(text) - F.length(F.translate(text, _CAPITALS, ""))
    fails = [n < 200, 100 * F.size(F.array_distinct(words)) < 50 * n,
             100 * capitals.cast("long") > 2 * F.length(text).cast("long"), text.rlike(r"[#$%&*|]")]
    return sum((F.when(c, 1 << k).otherwise(0) for k, c in enumerate(fails)), F.lit(0))


def mask_counts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                part_col: str = "source") -> DataFrame:
    """(part, mask, n, good, toxic): documents per part and set of failed filters.

    Texts meet by SHA-256.  Equal texts fail the same of A to D, so the rows of a
    text are summed per (part, labels) before they meet and a text held by a
    third of all rows costs a few rows a task; only its smallest id, with the
    number of rows that carry it, goes along.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col), F.lit("")).alias("part"),
                       F.sha2(text, 256).alias("sha"), own_mask(text).alias("mask"))
    marks = labels.groupBy(F.col("doc_id").alias("id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    same = (rows.groupBy("id", "sha", "part", "mask").agg(F.count(F.lit(1)).alias("n"))
            .join(marks, "id", "left").fillna(0, ["good", "toxic"])
            .groupBy("sha", "part", "mask", "good", "toxic")
            .agg(F.sum("n").alias("n"), F.min(F.when(F.col("id").isNotNull(), F.struct("id", "n"))).alias("low"),
                 F.coalesce(F.sum(F.when(F.col("id").isNull(), F.col("n"))), F.lit(0)).alias("anonymous")))
    same, _ = materialize(same, "audit-texts")
    first = same.groupBy("sha").agg(F.min("low.id").alias("first"), F.sum("n").alias("all")).filter("all > 1").drop("all")
    copies = F.expr("coalesce(n - anonymous - if(low.id = first, low.n, 0), 0)")
    told = same.join(first, "sha", "left").withColumn(
        "copies", F.when(F.col("first").isNull(), F.lit(0)).otherwise(copies))
    split = told.select("part", "good", "toxic", F.explode(F.array(
        F.struct(F.col("mask"), (F.col("n") - F.col("copies")).alias("n")),
        F.struct((F.col("mask") + 16).alias("mask"), F.col("copies").alias("n")))).alias("m"))
    return (split.select("part", F.col("m.mask").alias("mask"), F.col("m.n").alias("n"), "good", "toxic").filter("n > 0")
            .groupBy("part", "mask").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"),
                                         F.sum(F.col("n") * F.col("toxic")).alias("toxic")))


def audit(counts: DataFrame) -> DataFrame:
    """One row per part, order and step from (part, mask, n, good, toxic).

    Columns: part, filter_order, step, kept, removed, redundant, unique_fails,
    good_lost, toxic_lost, shapley.
    """
    spark = counts.sparkSession
    failing = [F.sum(F.when(F.col("mask").bitwiseAND(1 << k) != 0, F.col("n")).otherwise(0)) for k in range(5)]
    only = [F.sum(F.when(F.col("mask") == 1 << k, F.col("n")).otherwise(0)) for k in range(5)]
    parts = counts.groupBy("part").agg(F.sum("n").alias("total"), F.array(*failing).alias("fails"), F.array(*only).alias("only"))
    grid = (parts.withColumn("rank", F.explode(F.sequence(F.lit(0), F.lit(len(ORDERS) - 1))))
            .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(LETTERS))))))
    what = ["n", "good", "toxic"]
    deltas = (counts.join(F.broadcast(_differences(spark)), "mask").groupBy("part", "step", "rank")
              .agg(*[F.sum(F.col(c) * F.col("sign")).alias(c) for c in what]))
    # running sums over the 120 ranks of each part and step
    by_rank = "(PARTITION BY part, step ORDER BY rank ROWS UNBOUNDED PRECEDING)"
    gone = grid.join(deltas, ["part", "rank", "step"], "left").select(
        *grid.columns, *[F.expr(f"cast(coalesce(sum({c}) OVER {by_rank}, 0) AS bigint)").alias(c) for c in what])
    letter = F.substring(F.col("filter_order"), F.col("step"), F.lit(1))
    named = (gone.withColumn("filter_order", F.element_at(F.array(*map(F.lit, ORDERS)), F.col("rank") + 1))
             .withColumn("letter", F.ascii(letter) - ord("A")))
    return named.select(
        "part", "filter_order", "step",
        F.expr("total - sum(n) OVER (PARTITION BY part, rank ORDER BY step ROWS UNBOUNDED PRECEDING)").alias("kept"),
        F.col("n").alias("removed"), F.expr("fails[letter] - n").alias("redundant"),
        F.expr("only[letter]").alias("unique_fails"), F.col("good").alias("good_lost"), F.col("toxic").alias("toxic_lost"),
        F.expr("sum(n) OVER (PARTITION BY part, letter)").alias("shapley"))


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of ``docs`` (doc_id, text, source) with ``labels`` (doc_id,
    quality, toxic).  The counts per mask, a few rows a part, are written once."""
    counts, _ = materialize(mask_counts(docs, labels), "audit-masks")
    return audit(counts)
