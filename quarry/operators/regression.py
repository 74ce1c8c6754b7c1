"""Least squares by batch gradient descent (no intercept, no regularisation).

Rows are ``(id, x array, y)``; weights are a table ``(j, w)`` with 1-based
positions.  Positions beyond the longest row cannot touch any dot product, so
the weight vector that reaches the rows (a scalar subquery holding an array) is
never longer than a row, and residuals are a narrow projection.  The gradient is a sum over
rows per position: partial sums in every task, one row per position shuffled.

Descent needs of the rows only ``X'X`` and ``X'y``: they are summed in one scan
(a block a task, then by cell), and every iteration is a step on that small
system.  Rows too wide for it are scanned once per iteration instead.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from quarry.functions.vector import as_double_vector, dot_dense
from quarry.plans.materialize import materialize
from quarry.session import ship_package

#: widest rows whose sufficient statistics (width^2 / 2 numbers) a task and the
#: driver hold
GRAM_WIDTH = 1024


def with_residual(data: DataFrame, w: DataFrame, x: str = "x", y: str = "y") -> DataFrame:
    """``data`` plus a column ``e = y - x . w``; a position without weight
    counts 0, a weight beyond every row counts nothing."""
    longest = data.agg(F.max(F.size(x)).alias("n")).scalar()
    near = w.where((F.col("j") >= 1) & (F.col("j") <= F.coalesce(longest, F.lit(0))))
    dense = near.agg(_dense_weights().alias("_w")).scalar()
    xs = as_double_vector(x)
    return data.withColumn("_w", dense).withColumn(
        "e", F.col(y).cast("double") - dot_dense(xs, F.col("_w"))).drop("_w")


def _dense_weights():
    """Aggregate over the weight table ``(j, w)`` giving ``[w_1 .. w_m]``
    (m = largest position, absent positions 0).  Built once per iteration on
    the small weight table, so every row does a plain positional dot
    product."""
    entries = F.sort_array(F.collect_list(
        F.struct(F.col("j").cast("int").alias("j"), F.col("w").cast("double").alias("w"))))
    top = F.max(F.col("j").cast("int"))
    by_position = F.map_from_entries(entries)
    gaps = F.transform(F.sequence(F.lit(1), top),
                       lambda i: F.coalesce(F.element_at(by_position, i), F.lit(0.0)))
    dense = F.when(top < 1, F.array().cast("array<double>")) \
             .when(F.size(entries) == top, F.transform(entries, lambda e: e["w"])) \
             .otherwise(gaps)
    return F.coalesce(dense, F.array().cast("array<double>"))


def residuals(data: DataFrame, w: DataFrame, id_col: str = "id", x: str = "x",
              y: str = "y") -> DataFrame:
    """``e = y - x . w`` per row: ``(id, e)``; a position without weight
    counts 0."""
    return with_residual(data, w, x, y).select(id_col, "e")


def gradient(data: DataFrame, residuals: DataFrame | None = None, x: str = "x",
             e: str = "e", id_col: str = "id") -> DataFrame:
    """``g_j = sum over rows of x_j * e``: ``(j, g)``, 1-based ``j``.

    ``e`` is a column of ``data`` (as left by ``with_residual``, no join), or
    comes from a separate ``(id, e)`` table joined on ``id``.
    """
    if residuals is not None:
        data = data.select(id_col, x).join(residuals.select(id_col, e), id_col)
    terms = data.select(F.col(e).alias("_e"),
                        F.posexplode(as_double_vector(x)).alias("_p", "_x"))
    return terms.groupBy("_p").agg(F.sum(F.col("_x") * F.col("_e")).alias("g")) \
                .select((F.col("_p") + 1).alias("j"), "g")


def _statistics_fn(width: int):
    """``mapInArrow`` body over (x, y): ``(i, j, v)`` with X'X at i <= j (1-based),
    X'y at i = 0 and the longest row at (0, 0); sums of a whole task.  A task that
    meets a longer row than ``width`` tells only that."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        longest = 0
        total = np.zeros((1, 1))                 # row 0: X'y, row and column i: X'X
        for batch in batches:
            xs, ys = batch.column(0), batch.column(1)
            sizes = xs.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            longest = max(longest, int(sizes.max(initial=0)))
            if longest > width:
                continue
            cells = xs.flatten()
            # a missing entry, vector or target takes the whole row out
            row = np.repeat(np.arange(len(sizes)), sizes)
            out = ys.is_null().to_numpy(zero_copy_only=False)
            out[row[cells.is_null().to_numpy(zero_copy_only=False)]] = True
            d = int(sizes.max(initial=0))
            x = np.zeros((len(sizes), d + 1))
            start = np.cumsum(sizes) - sizes
            x[row, 1 + np.arange(len(row)) - start[row]] = cells.to_numpy(zero_copy_only=False)
            x[:, 0] = ys.to_numpy(zero_copy_only=False)
            x[out] = 0.0
            if d + 1 > len(total):
                total = np.pad(total, (0, d + 1 - len(total)))
            total[:d + 1, :d + 1] += x.T @ x
        if longest <= width:
            total[0, 0] = 0.0
            i, j = np.nonzero(np.triu(total != 0))
            yield pa.RecordBatch.from_arrays(
                [pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])], names=["i", "j", "v"])
        yield pa.RecordBatch.from_arrays(
            [pa.array([-1], pa.int32()), pa.array([-1], pa.int32()), pa.array([float(longest)])], names=["i", "j", "v"])
    return run


def sufficient_statistics(data: DataFrame, x: str = "x", y: str = "y",
                          width: int = GRAM_WIDTH) -> tuple[np.ndarray, np.ndarray] | None:
    """``X'X`` and ``X'y`` as dense arrays from one scan; None if some row is
    longer than ``width``.  Shorter rows count 0 at the positions they lack; a row
    with a NULL target or entry counts nowhere, but its length does."""
    ship_package(data.sparkSession)
    cells = data.select(as_double_vector(x).alias("x"), F.col(y).cast("double").alias("y")).mapInArrow(
        _statistics_fn(width), "i int, j int, v double")
    got = cells.groupBy("i", "j").agg(F.when(F.col("i") < 0, F.max("v")).otherwise(F.sum("v")).alias("v")).collect()
    d = max((int(r.v) for r in got if r.i < 0), default=0)
    if d > width:
        return None
    gram, target = np.zeros((d, d)), np.zeros(d)
    for r in got:
        if r.i > 0:
            gram[r.i - 1, r.j - 1] = gram[r.j - 1, r.i - 1] = r.v
        elif r.i == 0:
            target[r.j - 1] = r.v
    return gram, target


def linreg_gd(data: DataFrame, w0: DataFrame, rate: float = 0.01,
              iterations: int = 2, x: str = "x", y: str = "y", width: int = GRAM_WIDTH) -> DataFrame:
    """``w <- w + rate * gradient`` repeated ``iterations`` times: ``(j, w)``.

    A weight without gradient keeps its value; a gradient without weight
    starts from 0 (so ``w0`` may be empty for all-zero weights).

    Rows of at most ``width`` values are scanned once for ``X'X`` and ``X'y``, and
    the iterations ``w + rate * (X'y - X'X w)`` cost no scan; if some row is
    longer, every iteration scans the rows and writes its weight table to the
    checkpoint folder.
    """
    w = w0.select(F.col("j").cast("int").alias("j"), F.coalesce(F.col("w").cast("double"), F.lit(0.0)).alias("w"))
    if iterations < 1:
        return w
    known = sufficient_statistics(data, x, y, width)
    if known is None:
        return _descent_by_rows(data.select(x, y), w, rate, iterations, x, y)
    gram, target = known
    d = len(target)
    weights = np.zeros(d)
    near = (F.col("j") >= 1) & (F.col("j") <= d)
    given = w.where(near).limit(d + 1).collect()
    if len({r.j for r in given}) < len(given):
        raise ValueError("a position with two start weights")
    for r in given:
        weights[r.j - 1] = r.w
    for _ in range(iterations):
        weights = weights + rate * (target - gram @ weights)
    spark = data.sparkSession
    moved = spark.createDataFrame([(j + 1, float(v)) for j, v in enumerate(weights)], "j int, w double")
    return moved.unionByName(w.where(~F.coalesce(near, F.lit(False))))


def _descent_by_rows(rows: DataFrame, w: DataFrame, rate: float, iterations: int, x: str, y: str) -> DataFrame:
    for _ in range(iterations):
        g = gradient(with_residual(rows, w, x, y), x=x, e="e")
        step = w.join(g, "j", "full").select(
            "j", (F.coalesce(F.col("w"), F.lit(0.0))
                  + F.lit(float(rate)) * F.coalesce(F.col("g"), F.lit(0.0))).alias("w"))
        w, _ = materialize(step, "linreg-weights")
    return w
