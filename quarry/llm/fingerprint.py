"""Document fingerprints: homomorphic multiset hashes (DataFrame functions
only).

A fingerprint is an array of longs modulo 2^60, the sum of one vector for every
paragraph (line), so the order of paragraphs does not matter and paragraphs are
inserted or deleted by adding or subtracting their vectors.  A paragraph's
vector has a count, eight dense 60-bit hashes of the whole line (equality), and a
wide part summed over its pieces of up to four words: 60 signs of a piece's
hash, two 30-bit counters in each of 30 longs.  A text has fewer than 2^30 pieces
(it has fewer than 2^31 bytes, and a piece takes two), so no counter of a text can
overflow.  The wide part is linear, so the cosine of two documents' sign sums
estimates how alike their piece multisets are.

Null texts count as empty; an empty text's fingerprint is all zeros.  Texts of any
length are read whole.  Rows that repeat an id are fingerprinted each by its own
text and follow one another by text hash; rows without id have no next document.
An empty table gives no rows; other columns are never read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

MODULUS_BITS = 60
_MASK = (1 << MODULUS_BITS) - 1
_LANES = 30
_FIELD_BITS = 30
_FIELD = (1 << _FIELD_BITS) - 1
_BITS = 1 | 1 << _FIELD_BITS
_PIECE = r"\S+(?:[^\S\n]+\S+){0,3}"
_DENSE = 8
HEADER = 2 + _DENSE    # paragraphs, the dense sums, pieces
ROWS_PER_RANGE = 1000
MOST_RANGES = 10_000


def _summed(values: Column, of) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, x: (a + of(x)).bitwiseAND(F.lit(_MASK)))


def _counted(values: Column, of) -> Column:
    """Sum of counters that cannot leave their fields."""
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, x: a + of(x))


def with_fingerprint(df: DataFrame, text: Column, out: str) -> DataFrame:
    """``df`` with the fingerprint array of ``text`` as column ``out``."""
    body = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(body, "\n", -1), lambda x: x != "")
    step = (df.withColumn("__q_lines", lines)
            .withColumn("__q_pieces", F.transform(F.regexp_extract_all(body, F.lit(_PIECE), F.lit(0)), lambda x: F.xxhash64(x))))
    lanes = [_counted(F.col("__q_pieces"), lambda x, j=j: F.shiftrightunsigned(x, j).bitwiseAND(F.lit(_BITS)))
             for j in range(_LANES)]
    # hashed as they are summed: no second array as long as the text
    dense = [_summed(F.col("__q_lines"), lambda x, k=k: F.xxhash64(F.lit(k), x).bitwiseAND(F.lit(_MASK))) for k in range(_DENSE)]
    parts = [F.size("__q_lines").cast("long"), *dense, F.size("__q_pieces").cast("long")]
    return step.withColumn(out, F.array(*parts, *lanes)).drop("__q_lines", "__q_pieces")


def combined(a: Column, b: Column, remove: bool = False) -> Column:
    """Fingerprint of the paragraphs of both (``remove``: of ``a`` without
    those of ``b``)."""
    return F.zip_with(a, b, lambda x, y: ((x - y) if remove else (x + y)).bitwiseAND(F.lit(_MASK)))


def as_text(fp: Column) -> Column:
    """Hexadecimal form, 15 digits a number."""
    return F.array_join(F.transform(fp, lambda x: F.lpad(F.lower(F.hex(x)), 15, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """0 to 1: cosine of the sign sums, 1 for equal fingerprints, 0 where one
    has no pieces or is null."""
    na, nb = F.element_at(a, HEADER), F.element_at(b, HEADER)

    def dot(p: Column, q: Column, np: Column, nq: Column) -> Column:
        def field(x, n, f):
            return (2 * F.shiftright(x, _FIELD_BITS * f).bitwiseAND(F.lit(_FIELD)) - n).cast("double")
        lanes = F.zip_with(F.slice(p, HEADER + 1, _LANES), F.slice(q, HEADER + 1, _LANES),
                           lambda x, y: sum((field(x, np, f) * field(y, nq, f) for f in range(2)), F.lit(0.0)))
        return F.aggregate(lanes, F.lit(0.0), lambda s, x: s + x)
    size = F.sqrt(dot(a, a, na, na) * dot(b, b, nb, nb))
    return (F.when(a.isNull() | b.isNull(), 0.0).when(a == b, 1.0).when((na == 0) | (nb == 0) | (size == 0), 0.0)
            .otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), dot(a, b, na, nb) / size))))


def _range_of(key: Column, edges: list) -> Column:
    """Index of the last of the sorted ``edges`` that is not above ``key``, by
    a coarse and a fine step."""
    width = max(1, math.isqrt(len(edges)))
    groups = [edges[i:i + width] for i in range(0, len(edges), width)]
    coarse = F.size(F.filter(F.lit([g[0] for g in groups]), lambda e: e <= key))
    within = F.element_at(F.lit([g + [g[-1]] * (width - len(g)) if len(g) < width else g for g in groups]), F.greatest(coarse, F.lit(1)))
    fine = F.size(F.filter(within, lambda e: e <= key))
    at = (F.greatest(coarse, F.lit(1)) - 1) * width + F.greatest(fine, F.lit(1)) - 1
    return F.least(at, F.lit(len(edges) - 1)).cast("int")


def with_next(df: DataFrame, id_col: str, columns: list[str], prefix: str) -> DataFrame:
    """Each row with ``columns`` of the next row by ascending id, the first one
    after the last (equal ids by text hash).  Rows are dealt into id ranges cut
    at values that occur; the first row of a range is also sent to the range
    before it, so one shuffle suffices.  Rows without id have no next."""
    known = df.filter(F.col(id_col).isNotNull())
    n = known.count()
    out = [F.col(c) for c in df.columns]
    blank = df.filter(F.col(id_col).isNull()).select(
        *out, *[F.lit(None).cast(df.schema[c].dataType).alias(prefix + c) for c in columns])
    if not n:
        return blank
    ranges = max(1, min(MOST_RANGES, n // ROWS_PER_RANGE))
    shares = [i / ranges for i in range(1, ranges)]
    low, cuts = known.agg(F.min(id_col), F.percentile_approx(id_col, shares or [0.0], 20 * ranges)).first()
    edges = sorted({low, *(c for c in cuts if c >= low)})
    bucket = _range_of(F.col(id_col), edges)
    first = F.col(id_col) == F.element_at(F.lit(edges), F.col("__q_range") + 1)
    dealt = (known.withColumn("__q_range", bucket)
             .withColumn("__q_copies", F.when(first, F.array(F.col("__q_range"),
                         F.pmod(F.col("__q_range") - 1, F.lit(len(edges))))).otherwise(F.array("__q_range")))
             .select(*out, F.posexplode("__q_copies").alias("__q_extra", "__q_range")))
    order = Window.partitionBy("__q_range").orderBy("__q_extra", id_col, F.xxhash64(*[F.col(c) for c in columns if c != id_col]))
    return (dealt.select("*", *[F.lead(c).over(order).alias(prefix + c) for c in columns])
            .filter("__q_extra = 0").drop("__q_extra", "__q_range").unionByName(blank))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited and near_next, where the edited text has
    its last quarter replaced by the start of the next document."""
    plain = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    own = with_fingerprint(plain, F.col("text"), "fp")
    both = with_next(own, "doc_id", ["text", "fp"], "next_")
    chars = F.length("text")
    quarter = F.when(F.col("next_text").isNull(), 0).otherwise(F.floor(chars / 4)).cast("int")
    edited = both.withColumn("edited", F.concat(
        F.col("text").substr(F.lit(1), chars - quarter),
        F.coalesce(F.col("next_text"), F.lit("")).substr(F.lit(1), quarter)))
    done = with_fingerprint(edited, F.col("edited"), "edited_fp")
    return done.select("doc_id", chars.cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
                       as_text(F.col("fp")).alias("fingerprint"), as_text(F.col("edited_fp")).alias("edited_fingerprint"),
                       likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
                       likeness(F.col("fp"), F.col("next_fp")).alias("near_next"))
