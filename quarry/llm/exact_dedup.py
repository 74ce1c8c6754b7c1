"""Exact deduplication by two passes over a Bloom bitmap (DataFrame functions
only).

Pass 1 counts hash slots and keeps the slots hit twice or more; pass 2 probes
every row with that bitmap.  Only rows whose slots are all repeated -- true
copies and a few chance hits -- are shuffled and compared by SHA-256; every
other row is a group of its own and passes straight through.

Null text counts as empty.  Of equal texts the row with the largest id stays;
null ids sort lowest, and between rows with the same id and text one is kept
(the last in the written order of the candidate rows).  Texts of any length are
hashed whole; an empty table gives no rows; other columns are carried or left out,
never read, and their names cannot clash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from quarry.llm.bitmap import probe, repeated_bitmap, slots_for
from quarry.plans.materialize import materialize

SALTS = 16
_SHA, _HASH, _ROW = "__q_sha", "__q_hash", "__q_row"
_KEEP, _SIZE, _STAYS = "__q_keep_id", "__q_group_size", "__q_kept"


def _annotated(df: DataFrame, id_col: str, text_col: str, payload: list[str]) -> DataFrame:
    """``payload`` columns and _SHA, _KEEP, _SIZE, _STAYS for every row."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = df.select(*[F.col(c) for c in payload], F.sha2(text, 256).alias(_SHA),
                      F.xxhash64(text).alias(_HASH))
    keys = df.select(F.xxhash64(text).alias(_HASH))
    slots = slots_for(df.count())
    one = repeated_bitmap(keys, _HASH, slots, seed=1)
    two = repeated_bitmap(keys, _HASH, slots, seed=2)
    seen = probe(probe(keyed, _HASH, one, slots, 1, "__q_h1"), _HASH, two, slots, 2, "__q_h2")
    both = F.col("__q_h1") & F.col("__q_h2")
    drop = ("__q_h1", "__q_h2", _HASH)

    alone = (seen.filter(~both).drop(*drop)
             .withColumn(_KEEP, F.col(id_col)).withColumn(_SIZE, F.lit(1).cast("long"))
             .withColumn(_STAYS, F.lit(True)))

    # the ordinal is fixed by writing it, so both sides of the join agree
    cand, _ = materialize(seen.filter(both).drop(*drop)
                          .withColumn(_ROW, F.monotonically_increasing_id()), "copies")
    groups = (cand.groupBy(_SHA)
              .agg(F.max(F.struct(F.col(id_col).alias("i"), F.col(_ROW).alias("r"))).alias("__q_top"),
                   F.count(F.lit(1)).alias(_SIZE))
              .withColumn("__q_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))))
    salted = cand.withColumn("__q_salt", F.pmod(F.xxhash64(_ROW), F.lit(SALTS)).cast("int"))
    shared = (salted.join(groups, [_SHA, "__q_salt"])
              .withColumn(_KEEP, F.col("__q_top.i"))
              .withColumn(_STAYS, F.col("__q_top.r") == F.col(_ROW))
              .drop("__q_top", "__q_salt", _ROW))
    return alone.unionByName(shared)


def copy_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, ``keep_id`` (id of the row that stays),
    ``group_size``, ``kept`` and ``text_sha256``."""
    done = _annotated(df.select(id_col, text_col), id_col, text_col, [id_col])
    return done.select(F.col(id_col), F.col(_KEEP).alias("keep_id"), F.col(_SIZE).alias("group_size"),
                       F.col(_STAYS).alias("kept"), F.col(_SHA).alias("text_sha256"))


def drop_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with all their columns."""
    done = _annotated(df, id_col, text_col, df.columns)
    return done.filter(F.col(_STAYS)).select(*[F.col(c) for c in df.columns])
