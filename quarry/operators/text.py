"""Longest palindromic substrings of a text column.

The per-text search runs in Arrow batches in the Python workers (linear time
per text, see ``quarry.functions.palindrome``); everything around it --
exploding centres, cutting substrings, choosing the overall winner -- is
built-in Spark.  Texts are processed whole.  Centres come in small groups that
share the piece of text around them, streamed in batches of bounded size, so
neither a task nor a row ever holds all palindromes of a text (their lengths
together grow with the square of a long run).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from quarry.functions.palindrome import centre_chunks, longest_span_udf
from quarry.session import ship_package


def _centres(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, center, _o, _e, _piece, _off): radii per centre and the shared piece."""
    ship_package(df.sparkSession)
    kind = df.schema[id_col].dataType.simpleString()
    chunks = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t")).mapInArrow(
        centre_chunks, f"id {kind}, base int, off int, piece string, odd array<int>, even array<int>")
    return chunks.select("id", "base", "off", "piece", "even", F.posexplode("odd").alias("_k", "_o")).select(
        "id", (F.col("base") + F.col("_k")).alias("center"), "_o", F.get("even", F.col("_k")).alias("_e"),
        F.col("piece").alias("_piece"), F.col("off").alias("_off"))


def palindromes_by_center(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per centre of every text: ``(id, center, odd, even)`` where
    ``odd`` is the longest palindrome centred on character ``center``
    (0-based) and ``even`` the longest one centred between ``center`` and
    ``center + 1`` (empty if those differ, NULL at the last character).

    The palindromes are cut from the shared pieces as rows are used; a plan
    that does not use them does not cut them.  NULL and empty texts have no
    centres.
    """
    return _centres(df, id_col, text_col).select(
        "id", "center",
        F.substring(F.col("_piece"), F.col("center") - F.col("_o") - F.col("_off") + 1, 2 * F.col("_o") + 1).alias("odd"),
        F.substring(F.col("_piece"), F.col("center") - F.col("_e") - F.col("_off") + 2, 2 * F.col("_e")).alias("even"))


def palindrome_lengths(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id, center, odd_len, even_len)``: the lengths of the palindromes of
    ``palindromes_by_center``, where only figures are asked."""
    return _centres(df, id_col, text_col).select(
        "id", "center", (2 * F.col("_o") + 1).alias("odd_len"), (2 * F.col("_e")).alias("even_len"))


def longest_palindrome(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Longest palindromic substring per row: ``(id, len, pal)``; ties go to
    the earliest start.  An empty text gives ``(0, '')``, NULL gives NULL."""
    ship_package(df.sparkSession)
    r = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("_t"),
                  longest_span_udf(F.col(text_col)).alias("_s"))
    return r.select("id", F.col("_s.len").alias("len"),
                    F.expr("substring(_t, _s.start + 1, _s.len)").alias("pal"))


def longest_palindrome_all(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The longest palindrome over the whole table: one row ``(id, len, pal)``;
    ties go to the lowest id (then the earliest start within that row).

    ``min_by`` over ``(-len, id)`` is a mergeable aggregate (any orderable
    id type): each task keeps its own best row and only those cross the
    shuffle.
    """
    per = longest_palindrome(df, id_col, text_col).where(F.col("len").isNotNull())
    key = F.struct((-F.col("len")).alias("_neg_len"), F.col("id"))
    best = per.agg(F.min_by(F.struct("id", "len", "pal"), key).alias("_b"))
    return best.where(F.col("_b").isNotNull()).select("_b.id", "_b.len", "_b.pal")
