"""Joins and distinct counts (the tagged-table join and the distinct-key
count of the value-partitioning program)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from quarry.plans.materialize import materialize, materialize_observed

BLOCK = 2048  # rows of a side in one piece of a hot key, about


def _key_pairs(on) -> list[tuple[str, str]]:
    if isinstance(on, str):
        return [(on, on)]
    pairs = []
    for item in on:
        pairs.append((item, item) if isinstance(item, str) else tuple(item))
    return pairs


def equi_join(a: DataFrame, b: DataFrame, on, a_cols: Sequence[str],
              b_cols: Sequence[str], split_hot: bool = False) -> DataFrame:
    """Many-to-many inner equi-join; the key is dropped from the output.

    ``on`` is a column name, a list of names, or a list of
    ``(a_column, b_column)`` pairs.  Rows whose key is NULL or missing on the
    other side produce nothing.  The strategy (broadcast hash, shuffled hash
    or sort-merge, with skew splitting) is left to AQE, which knows the real
    sizes of both sides at run time.

    AQE judges a partition by its bytes, not by the pairs it makes.  With
    ``split_hot`` both sides are counted by key first (a scan and a grouping
    of each), and a key of more than ``BLOCK * BLOCK`` pairs is joined in
    pieces of about ``BLOCK`` by ``BLOCK`` rows, dealt over all partitions.
    Meant for few or uneven keys.
    """
    clash = set(a_cols) & set(b_cols)
    if clash:
        raise ValueError(f"output columns taken from both sides: {sorted(clash)}; "
                         "rename them on one side first")
    pairs = _key_pairs(on)
    left = a.select(*[F.col(x).alias(f"_k{i}") for i, (x, _) in enumerate(pairs)],
                    *a_cols)
    right = b.select(*[F.col(y).alias(f"_k{i}") for i, (_, y) in enumerate(pairs)],
                     *b_cols)
    keys = [f"_k{i}" for i in range(len(pairs))]
    if split_hot:
        left, right, keys = _split_hot(left, right, keys)
    return left.join(right, keys, "inner").select(*a_cols, *b_cols)


def _split_hot(left: DataFrame, right: DataFrame, keys: list[str]):
    """Both sides and the keys to join them by: every row of a hot key has a
    piece number on its own side and is repeated for each piece of the other."""
    pairs = (left.groupBy(keys).agg(F.count(F.lit(1)).alias("_kl"))
             .join(right.groupBy(keys).agg(F.count(F.lit(1)).alias("_kr")), keys)
             .filter(F.col("_kl").cast("double") * F.col("_kr") > BLOCK * BLOCK))
    hot, _, seen = materialize_observed(
        pairs.select(*keys, *[F.ceil(F.col(n) / BLOCK).alias(n) for n in ("_kl", "_kr")]), "hot-keys")
    if not seen["rows"]:
        return left, right, keys
    n = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    some = " and ".join(f"{k} is not null" for k in keys)
    keys_and_pieces = [*keys, "_kl_piece", "_kr_piece"]

    def dealt(side: DataFrame, own: str, other: str) -> DataFrame:
        # written once, so that a task run again sees the same numbers
        numbered, _ = materialize(
            side.filter(some).join(hot, keys, "left").withColumn(
                f"{own}_piece", F.expr(f"pmod(xxhash64(monotonically_increasing_id()), coalesce({own}, 1))")), "pieces")
        return (numbered.withColumn(f"{other}_piece", F.explode(F.expr(f"sequence(0L, coalesce({other}, 1) - 1)")))
                .drop("_kl", "_kr").repartition(n, *keys_and_pieces))

    return dealt(left, "_kl", "_kr"), dealt(right, "_kr", "_kl"), keys_and_pieces


def distinct_count(df: DataFrame, col: str, alias: str = "n") -> DataFrame:
    """Exact number of distinct non-NULL values of ``col``.

    Planned as a two-level aggregate: each task first de-duplicates its own
    values, so a value held by a third of all rows still crosses the shuffle
    once per task.
    """
    return df.agg(F.count_distinct(F.col(col)).alias(alias))
