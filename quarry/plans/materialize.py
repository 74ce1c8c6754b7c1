"""Cutting lineage in iterative operators.

Each round of a loop (k-means, BFS, gradient descent) is written as Parquet to
the shared checkpoint folder and read back.  The next round then plans against
a short scan instead of an ever-growing lineage, a lost executor only costs the
current round, and AQE sees real file sizes when it chooses join strategies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from quarry.session import scratch_path


def materialize(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``df`` below the checkpoint folder; return the re-read frame and
    its path."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return _read_back(spark, df, path), path


def _read_back(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    # the schema is known: no footer-reading job to infer it again
    return spark.read.schema(df.schema).parquet(path)


def materialize_observed(df: DataFrame, name: str, path: str | None = None,
                         **metrics: Column) -> tuple[DataFrame, str, dict]:
    """Like ``materialize``, and also return aggregate metrics computed while
    the rows are written (``rows`` always, plus the given named aggregate
    expressions) -- no second pass over the data.  An explicit ``path`` is
    overwritten (loops alternate between two paths this way).

    A task re-run after an executor loss may be counted twice, so callers
    only use these numbers where that cannot change the decision: emptiness
    tests, upper-bound checks, and ratios of counts taken from the same rows
    (``unmoved >= rows``)."""
    spark = df.sparkSession
    path = path or scratch_path(spark, name)
    obs = Observation(name)
    exprs = [F.count(F.lit(1)).alias("rows")] + [c.alias(k) for k, c in metrics.items()]
    df.observe(obs, *exprs).write.mode("overwrite").parquet(path)
    return _read_back(spark, df, path), path, obs.get
