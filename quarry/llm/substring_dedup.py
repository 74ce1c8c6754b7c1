"""Substring deduplication by seed and extend.

A window is ``width`` consecutive words of one text (words split at space and
0x09-0x0D, unchanged).  Every word covered by a window whose word sequence also
starts anywhere else, the same text included, is removed; windows are judged on
the input.

Seeds are winnowed anchors: in each window the smallest of its 8-word hashes
(the leftmost of equal ones), so equal windows have equal anchors at equal
places.  Consecutive windows with one anchor occurrence form a run, which spans
up to 62 words around the seed.  Seeds are joined on their hash; a seed seen
once proves all its windows unique.  Runs whose whole extension is equal are
one class, counted before any shuffle, and a class of two or more is repeated
as a whole.  Only where extensions of one seed differ is the extension taken
window by window, once per class, and only the classes seen once need the
result.  Work and rows stay proportional to the text: occurrences of a seed are
never paired with one another.

Hash equality of two independent 64-bit hashes (seed and extension) stands for
word equality.  Null texts have no words; rows are told apart by (id, text), so
rows that repeat both share their windows and are removed alike.  Texts of any
length are cut whole, an empty table gives no rows, and equal windows are all
removed, whichever comes first.  A column of the documents named like a figure
(``n_words``, ``n_removed``, ``kept_sha256``) stays and that figure is left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from quarry.llm.bitmap import rows_with_ids
from quarry.llm.runtime import prepare
from quarry.plans.materialize import materialize

WINDOW = 35
SEED = 8


def leftmost_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Index of the smallest of ``width`` values from each place on, the
    leftmost of equal ones."""
    best, at, reach = values, np.arange(len(values)), 1
    while reach < width and len(best):
        step = min(reach, width - reach)
        n = max(len(best) - step, 0)
        left = best[:n] <= best[step:step + n]
        at = np.where(left, at[:n], at[step:step + n])
        best = np.where(left, best[:n], best[step:step + n])
        reach += step
    return at


def anchor_runs(block, width: int, seed: int):
    """Runs of windows with one anchor: (text index, seed hash, first and last
    window start in words of the text, extension hash)."""
    n = len(block.hashes)
    z = np.zeros(0, np.int64)
    if n < width:
        return z, z.view(np.uint64), z, z, z.view(np.uint64)
    grams = block.run_hashes(np.arange(n - seed + 1), seed)
    anchor = leftmost_minima(grams, width - seed + 1)
    owner = np.repeat(np.arange(len(block.first) - 1), np.diff(block.first))
    start = np.arange(len(anchor))
    start = start[start + width <= block.first[1:][owner[:len(anchor)]]]
    if not len(start):
        return z, z.view(np.uint64), z, z, z.view(np.uint64)
    a = anchor[start]
    fresh = np.ones(len(start), bool)
    fresh[1:] = (a[1:] != a[:-1]) | (start[1:] != start[:-1] + 1)
    head = np.flatnonzero(fresh)
    lo, hi = start[head], start[np.concatenate((head[1:], [len(start)])) - 1]
    own = owner[lo]
    span = block.run_hashes(lo, hi - lo + width)
    return own, grams[a[head]], lo - block.first[own], hi - block.first[own], span


def _runs_fn(width: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from quarry.llm.substring_dedup import anchor_runs
        from quarry.llm.words import text_blocks, words_of

        for batch in batches:
            k1, k2 = (batch.column(i).to_numpy() for i in (0, 1))
            for at, texts in text_blocks(batch.column(2)):
                own, seeds, lo, hi, span = anchor_runs(words_of(texts), width, seed)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(k1[at + own]), pa.array(k2[at + own]), pa.array(seeds.view(np.int64)),
                     pa.array(span.view(np.int64)), pa.array(lo.astype(np.int32)), pa.array(hi.astype(np.int32))],
                    names=["k1", "k2", "seed", "span", "lo", "hi"])
    return run


def _windows_fn(width: int):
    """(k1, k2, text, runs) to one row per window of the listed runs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from quarry.llm.words import text_blocks, words_of

        for batch in batches:
            k1, k2 = (batch.column(i).to_numpy() for i in (0, 1))
            for at, texts in text_blocks(batch.column(2)):
                block = words_of(texts)
                runs = batch.column(3).slice(at, len(texts))
                flat = runs.flatten()
                own = np.repeat(np.arange(len(texts)), runs.value_lengths().to_numpy())
                lo, hi, seed, once = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(4))
                count = hi - lo + 1
                pick = np.repeat(np.arange(len(own)), count)
                start = lo[pick] + np.arange(len(pick)) - np.repeat(np.cumsum(count) - count, count)
                window = block.run_hashes(block.first[own[pick]] + start, width)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(k1[at + own[pick]]), pa.array(k2[at + own[pick]]), pa.array(seed[pick]),
                     pa.array(window.view(np.int64)), pa.array(start.astype(np.int32)), pa.array(once[pick])],
                    names=["k1", "k2", "seed", "window", "start", "once"])
    return run


def _cut_fn(width: int, n_payload: int, schema: list[str], text_at: int | None, chars_at: int | None):
    """Payload columns, text, spans -> payload (with the cut text in place
    where ``text_at`` is given), n_words, n_removed, kept_sha256."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        from quarry.llm.words import text_blocks, words_of

        for batch in batches:
            for at, texts in text_blocks(batch.column(n_payload)):
                n = len(texts)
                spans = batch.column(n_payload + 1).slice(at, n)
                cut = np.flatnonzero(spans.is_valid().to_numpy(zero_copy_only=False))
                raw = [t.encode() for t in texts.to_pylist()]
                words = [t.split() for t in raw]
                total, removed = [len(w) for w in words], [0] * n
                kept = list(words)
                changed: dict[int, str] = {}
                if len(cut):
                    block = words_of(texts.take(pa.array(cut)))
                    for j, i in enumerate(cut.tolist()):
                        a, b = block.first[j], block.first[j + 1]
                        edge = np.zeros(b - a + 1, np.int64)
                        one = spans[i].values
                        np.add.at(edge, one.field(0).to_numpy(), 1)
                        np.add.at(edge, np.minimum(one.field(1).to_numpy() + width, b - a), -1)
                        stay = np.cumsum(edge[:-1]) == 0
                        kept[i] = [words[i][k] for k in np.flatnonzero(stay)]
                        removed[i] = int((~stay).sum())
                        if text_at is not None:
                            # a kept word keeps the white space that follows it
                            base = block.start[a] if b > a else 0
                            lead = raw[i].find(words[i][0]) if words[i] else 0
                            s = block.start[a:b] - base + lead
                            e = np.append(s[1:], len(raw[i]))
                            changed[i] = b"".join(raw[i][x:y] for x, y in zip(s[stay], e[stay], strict=True)).decode()
                cols = [batch.column(c).slice(at, n) for c in range(n_payload)]
                if text_at is not None and changed:
                    was = cols[text_at].to_pylist()
                    cols[text_at] = pa.array([changed.get(i, t) for i, t in enumerate(was)], pa.string())
                    if chars_at is not None:
                        was = cols[chars_at].to_pylist()
                        cols[chars_at] = pa.array([len(changed[i]) if i in changed else c for i, c in enumerate(was)],
                                                  cols[chars_at].type)
                sha = [hashlib.sha256(b" ".join(w)).hexdigest() for w in kept]
                yield pa.RecordBatch.from_arrays(
                    [*cols, pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(sha, pa.string())],
                    names=schema)
    return run


def _spread_semi(rows: DataFrame, counted: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` whose keys are in ``counted`` (keys, n).  Keys with more than a
    thousandth of all counted rows -- fewer than a thousand keys, so their list
    may be broadcast -- are dealt over 64 partitions by a salt."""
    total = counted.agg(F.sum("n")).first()[0] or 0
    hot = counted.filter(F.col("n") * 1000 > total).select(*keys, F.lit(True).alias("__q_hot"))
    salted = (rows.join(F.broadcast(hot), keys, "left")
              .withColumn("__q_salt", F.expr("if(coalesce(__q_hot, false), cast(pmod(xxhash64(k1, lo), 64) AS int), 0)")).drop("__q_hot"))
    dealt = (counted.select(*keys).join(F.broadcast(hot), keys, "left")
             .select(*keys, F.explode(F.expr("if(coalesce(__q_hot, false), sequence(0, 63), array(0))")).alias("__q_salt")))
    return salted.join(dealt, [*keys, "__q_salt"], "left_semi").drop("__q_salt")


def repeated_spans(docs: DataFrame, text_col: str = "text", width: int = WINDOW, seed: int = SEED) -> DataFrame:
    """(k1, k2, lo, hi): window starts lo..hi of the text with that key are
    repeated.  ``docs`` needs k1 and k2, a 128-bit key of (id, text)."""
    prepare(docs.sparkSession)
    runs = (docs.select("k1", "k2", F.col(text_col))
            .mapInArrow(_runs_fn(width, seed), "k1 long, k2 long, seed long, span long, lo int, hi int"))
    seeds, _ = materialize(runs.groupBy("seed").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "seeds")
    seen, _ = materialize(_spread_semi(runs, seeds, ["seed"]), "runs")

    classes, _ = materialize(
        seen.groupBy("seed", "span").agg(F.count(F.lit(1)).alias("n"),
                                         F.min(F.struct("k1", "k2", "lo", "hi")).alias("one")), "classes")
    whole = (_spread_semi(seen, classes.filter("n > 1").select("seed", "span", "n"), ["seed", "span"])
             .select("k1", "k2", "lo", "hi"))

    # seeds whose extensions differ, with one seen only once
    mixed = (classes.groupBy("seed").agg(F.count(F.lit(1)).alias("k"), F.min("n").alias("n"))
             .filter("k > 1 and n = 1").select("seed"))
    open_runs, _ = materialize(
        classes.join(mixed, "seed", "left_semi")
        .select("one.k1", "one.k2", F.struct("one.lo", "one.hi", "seed", (F.col("n") == 1).alias("once")).alias("run"))
        .groupBy("k1", "k2").agg(F.collect_list("run").alias("runs")), "open")
    near, _ = rows_with_ids(docs.select("k1", "k2", F.col(text_col).alias("text")), "k1", open_runs, open_runs.count())
    windows, _ = materialize(
        near.join(open_runs, ["k1", "k2"]).select("k1", "k2", "text", "runs")
        .mapInArrow(_windows_fn(width), "k1 long, k2 long, seed long, window long, start int, once boolean"),
        "windows")
    twice = (windows.groupBy("seed", "window")
             .agg(F.countDistinct("k1", "k2", "start").alias("n"), F.max("once").alias("any"))
             .filter("n > 1 and any").select("seed", "window"))
    single = (windows.filter("once").join(twice, ["seed", "window"], "left_semi")
              .select("k1", "k2", F.col("start").alias("lo"), F.col("start").alias("hi")))
    return whole.union(single)


def cut_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WINDOW,
                with_text: bool = True, chars_col: str | None = "n_chars") -> DataFrame:
    """Every row with n_words, n_removed and kept_sha256 (SHA-256 of the kept
    words joined by one space).  ``with_text`` keeps all columns and cuts the
    text in place (white space after kept words stays; ``chars_col``, if it is a
    column of whole numbers, follows); else only the id column is returned beside
    the figures."""
    names = docs.columns if with_text else [id_col]
    payload = [f"c{i}" for i in range(len(names))]
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(*[F.col(c).alias(p) for c, p in zip(names, payload, strict=True)], text.alias("text"),
                        F.xxhash64(F.lit(1), F.col(id_col), text).alias("k1"),
                        F.xxhash64(F.lit(2), F.col(id_col), text).alias("k2"))
    spans, _ = materialize(
        repeated_spans(keyed, "text", width)
        .groupBy("k1", "k2").agg(F.collect_set(F.struct("lo", "hi")).alias("spans")), "spans")
    maybe, clear = rows_with_ids(keyed, "k1", spans, spans.count())
    both = (maybe.join(spans, ["k1", "k2"], "left")
            .unionByName(clear.withColumn("spans", F.lit(None).cast(spans.schema["spans"].dataType))))
    figures = [T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
               T.StructField("kept_sha256", T.StringType())]
    fields = [T.StructField(p, docs.schema[c].dataType) for c, p in zip(names, payload, strict=True)]
    done = both.select(*payload, "text", "spans").mapInArrow(
        _cut_fn(width, len(payload), [*payload, "n_words", "n_removed", "kept_sha256"],
                names.index(text_col) if with_text else None,
                names.index(chars_col) if with_text and chars_col in names
                and isinstance(docs.schema[chars_col].dataType, (T.IntegerType, T.LongType)) else None),
        T.StructType([*fields, *figures]))
    return done.select(*[F.col(p).alias(c) for c, p in zip(names, payload, strict=True)],
                       *[F.col(f.name).alias(f.name) for f in figures if f.name not in names])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WINDOW) -> DataFrame:
    """The documents with repeated passages cut out of their texts; every row
    and column stays."""
    return cut_repeats(docs, id_col, text_col, width).select(*[F.col(c) for c in docs.columns])
