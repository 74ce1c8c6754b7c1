"""Column expressions on fixed-width numeric vectors (``array<double>``).

All are built-in higher-order functions, evaluated in the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def as_double_vector(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("array<double>")


def squared_distance(a: Column, b: Column) -> Column:
    """sum_k (a_k - b_k)^2 of two equal-length vectors."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)),
                       F.lit(0.0), lambda acc, t: acc + t)


def dot_dense(x: Column, weights: Column) -> Column:
    """sum_k x_k * w_k for a dense weight array; positions of ``x`` beyond
    the weights count 0, weights beyond ``x`` are ignored."""
    w = F.slice(weights, 1, F.size(x))
    terms = F.zip_with(x, w, lambda v, c: v * F.coalesce(c, F.lit(0.0)))
    return F.aggregate(terms, F.lit(0.0), lambda acc, t: acc + t)
