"""Bounded one-hash Bloom bitmaps as small DataFrames.

A bitmap is a table (word, bits): 64 slots a word.  Its size is bounded by
``MAX_SLOTS`` whatever the input (2^27 slots are at most 2,097,152 rows of 16
bytes), so it may be broadcast; a fuller bitmap lets more rows through and
never loses one.  Callers follow it with an exact join over the rows that hit,
so that only those rows are shuffled and the others pass straight through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

MAX_SLOTS = 1 << 27
MIN_SLOTS = 1 << 16
SLOTS_PER_KEY = 16
HIT = "__q_hit"


def slots_for(n_keys: int) -> int:
    """Power of two of at least 16 slots a key, within the fixed bounds."""
    need = max(MIN_SLOTS, SLOTS_PER_KEY * max(1, n_keys))
    return min(MAX_SLOTS, 1 << (need - 1).bit_length())


def _slot(key: Column, slots: int, seed: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(slots))


def _words(slot_table: DataFrame) -> DataFrame:
    bit = F.expr("shiftleft(1L, cast(__q_slot & 63 AS int))")
    return (slot_table.groupBy(F.expr("__q_slot >> 6").alias("__q_word"))
            .agg(F.bit_or(bit).alias("__q_bits")))


def bitmap_of(keys: DataFrame, col: str, slots: int, seed: int = 0) -> DataFrame:
    """Bitmap of every value of ``col``."""
    return _words(keys.select(_slot(F.col(col), slots, seed).alias("__q_slot")))


def repeated_bitmap(keys: DataFrame, col: str, slots: int, seed: int = 0) -> DataFrame:
    """Bitmap of the slots that two or more rows fall into (counts are summed
    before the shuffle)."""
    counted = (keys.select(_slot(F.col(col), slots, seed).alias("__q_slot"))
               .groupBy("__q_slot").agg(F.count(F.lit(1)).alias("__q_n")))
    return _words(counted.filter("__q_n > 1"))


def probe(df: DataFrame, col: str, bitmap: DataFrame, slots: int, seed: int = 0,
          out: str = HIT) -> DataFrame:
    """``df`` with a boolean ``out``: false means certainly not in the bitmap."""
    small = F.broadcast(bitmap.select(F.col("__q_word"), F.col("__q_bits")))
    return (df.withColumn("__q_slot", _slot(F.col(col), slots, seed))
            .join(small, F.expr("__q_slot >> 6") == F.col("__q_word"), "left")
            .withColumn(out, F.expr(
                "coalesce((shiftrightunsigned(__q_bits, cast(__q_slot & 63 AS int)) & 1) = 1, false)"))
            .drop("__q_slot", "__q_word", "__q_bits"))


def rows_with_ids(df: DataFrame, col: str, ids: DataFrame, n_ids: int) -> tuple[DataFrame, DataFrame]:
    """Split ``df`` by a bitmap of ``ids[col]``: (rows that may be listed, rows
    that certainly are not).  Null ids are never listed."""
    slots = slots_for(n_ids)
    seen = probe(df, col, bitmap_of(ids, col, slots), slots)
    hit = F.col(HIT) & F.col(col).isNotNull()
    return seen.filter(hit).drop(HIT), seen.filter(~hit).drop(HIT)
