"""Mergeable aggregates: mean and count, sums of squares, sample variance,
class priors and Gaussian naive Bayes training.

All of them are plain ``groupBy().agg()`` plans, so Spark runs a partial
aggregate in every task before the shuffle (the combiner of a map-reduce job)
and a key holding a third of all rows costs one partial row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def _by(by) -> list[str]:
    if by is None:
        return []
    return [by] if isinstance(by, str) else list(by)


def mean_count(df: DataFrame, col: str | Column, by: Sequence[str] | str = (),
               mean: str = "mean", count: str = "count") -> DataFrame:
    """Mean and number of non-NULL values of ``col``, global or per ``by``."""
    x = F.col(col) if isinstance(col, str) else col
    aggs = [F.avg(x).alias(mean), F.count(x).alias(count)]
    keys = _by(by)
    return df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)


def merge_mean_count(partials: DataFrame, by: Sequence[str] | str = (),
                     mean: str = "mean", count: str = "count") -> DataFrame:
    """Combine pre-aggregated ``(mean, count)`` rows into one per group.

    Works for partials of any split of the data: the merged mean is the
    count-weighted mean of the partial means.
    """
    m, n = F.col(mean), F.col(count)
    aggs = [(F.sum(m * n) / F.sum(n)).alias(mean), F.sum(n).alias(count)]
    keys = _by(by)
    return (partials.groupBy(*keys).agg(*aggs) if keys else partials.agg(*aggs))


def sum_squares(df: DataFrame, col: str | Column, by: Sequence[str] | str = (),
                alias: str = "sumsq") -> DataFrame:
    """Sum of ``col * col`` per group."""
    x = F.col(col) if isinstance(col, str) else col
    keys = _by(by)
    agg = F.sum(x * x).alias(alias)
    return df.groupBy(*keys).agg(agg) if keys else df.agg(agg)


def variance_from_moments(means: DataFrame, sumsq: DataFrame,
                          by: Sequence[str] | str, mean: str = "mean",
                          count: str = "count", ss: str = "sumsq",
                          alias: str = "var") -> DataFrame:
    """Sample variance ``(sumsq - n * mean^2) / (n - 1)`` from two aggregate
    tables.

    A group missing from one side takes 0 for its moments; a group with
    ``n <= 1`` gets NULL (the sample variance is undefined there).  The two
    tables, one row per group each, are united and grouped, so NULL keys meet
    like any other key.  The subtraction cancels where the mean is large against
    the spread; the result is never below 0, and ``gaussian_nb_train`` has the
    safe one-pass form.
    """
    keys = _by(by)
    both = means.select(*keys, F.col(mean).cast("double").alias("_m"), F.col(count).cast("double").alias("_n"),
                        F.lit(None).cast("double").alias("_s")).unionByName(
        sumsq.select(*keys, F.lit(None).cast("double").alias("_m"), F.lit(None).cast("double").alias("_n"),
                     F.col(ss).cast("double").alias("_s")))
    moments = [F.max("_m").alias("_m"), F.max("_n").alias("_n"), F.max("_s").alias("_s")]
    j = both.groupBy(*keys).agg(*moments) if keys else both.agg(*moments)
    n, mu, s2 = (F.coalesce(F.col(c), F.lit(0.0)) for c in ("_n", "_m", "_s"))
    var = F.when(n > 1, F.greatest(F.lit(0.0), (s2 - n * mu * mu) / (n - 1)))
    return j.select(*keys, mu.alias(mean), var.alias(alias))


def moment_state(df: DataFrame, col: str | Column, by: Sequence[str] | str = (), state: str = "state") -> DataFrame:
    """Mergeable moments of the non-NULL values of ``col``, global or per ``by``:
    a struct ``(n, mean, m2)`` with ``m2`` the sum of squared distances from the
    mean.  ``merge_moments`` joins states of any split of the rows."""
    x = (F.col(col) if isinstance(col, str) else col).cast("double")
    n = F.count(x)
    made = F.struct(n.alias("n"), F.avg(x).alias("mean"), F.coalesce(F.var_pop(x) * n, F.lit(0.0)).alias("m2"))
    keys = _by(by)
    return df.groupBy(*keys).agg(made.alias(state)) if keys else df.agg(made.alias(state))


def merge_moments(partials: DataFrame, by: Sequence[str] | str = (), state: str = "state") -> DataFrame:
    """Merge states, global or per ``by``; the result is again a state.

    The merged mean is the count-weighted one, and the sum of squares grows by
    every part's ``n * (its mean - merged mean)^2``: distances from a mean, never
    differences of large squares.  Two grouped sums with map-side combining; the
    first one's rows meet the parts by a join that treats NULL keys as equal.
    """
    keys = _by(by)
    s = F.col(state)
    weight = F.sum(s["n"] * F.when(s["n"] > 0, s["mean"]))
    centre = (weight / F.sum(F.when(s["n"] > 0, s["n"]))).alias("_mean")
    if keys:
        centres = partials.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(centre)
        meet = None
        for i, k in enumerate(keys):
            same = F.col(k).eqNullSafe(F.col(f"_k{i}"))
            meet = same if meet is None else meet & same
        parts = partials.join(centres, meet)
        grouped = parts.groupBy(*keys)
    else:
        parts = partials.withColumn("_mean", partials.agg(centre).scalar())
        grouped = parts.groupBy()
    apart = F.when(s["n"] > 0, s["n"] * (s["mean"] - F.col("_mean")) * (s["mean"] - F.col("_mean"))).otherwise(0.0)
    return grouped.agg(F.struct(F.coalesce(F.sum(s["n"]), F.lit(0)).alias("n"), F.max("_mean").alias("mean"),
                                F.coalesce(F.sum(s["m2"] + apart), F.lit(0.0)).alias("m2")).alias(state))


def moments_of(state: str | Column = "state") -> list[Column]:
    """``n``, ``mean`` and the sample variance ``var`` (NULL for fewer than two
    values) of a state column."""
    s = F.col(state) if isinstance(state, str) else state
    return [s["n"].alias("n"), s["mean"].alias("mean"), F.when(s["n"] > 1, s["m2"] / (s["n"] - 1)).alias("var")]


def class_prior(df: DataFrame, label: str, alias: str = "prior") -> DataFrame:
    """Share of rows per class.

    The total is an uncorrelated scalar subquery: Spark computes it once and
    inlines it, so no single-partition window or cross join is needed.
    """
    total = df.agg(F.count(F.lit(1))).scalar()
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    return counts.select(label, (F.col("_n") / total).alias(alias))


def gaussian_nb_train(df: DataFrame, label: str, features: str,
                      pos: str = "pos") -> DataFrame:
    """Per class and feature position: mean, sample variance, count, and the
    class prior, in one scan.

    ``features`` is an array column (0-based positions, as in the input
    rows).  The array is exploded inside the map stage and immediately
    partially aggregated, so only ``classes x features`` rows per task are
    shuffled.  ``var_samp`` is used instead of the sum-of-squares formula:
    same value, no cancellation.  The prior counts each row of a class once, NULL
    and short vectors too; a class without any value has one row with a NULL
    position.
    """
    total = df.agg(F.count(F.lit(1))).scalar()
    classes = df.groupBy(F.col(label).alias("_label")).agg(F.count(F.lit(1)).alias("_rows"))
    exploded = df.select(F.col(label), F.posexplode(F.col(features)).alias(pos, "_x"))
    x = F.col("_x").cast("double")
    stats = exploded.groupBy(label, pos).agg(
        F.avg(x).alias("mean"), F.var_samp(x).alias("var"),
        F.count(x).alias("count"))
    return classes.join(stats, F.col("_label").eqNullSafe(F.col(label)), "left").select(
        F.col("_label").alias(label), pos, "mean", "var",
        F.coalesce("count", F.lit(0)).alias("count"), (F.col("_rows") / total).alias("prior"))
