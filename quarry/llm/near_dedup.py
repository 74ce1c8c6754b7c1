"""MinHash near-duplicates with HyperMinHash registers.

A text's set is its distinct five-word shingles (words lower-cased A-Z).  Each
shingle hash picks one of 128 buckets; a bucket stores the leading-zero count
and ten mantissa bits of its smallest remainder, and empty buckets borrow from
filled ones by a fixed probe order.  Bands of four compressed registers give
candidates, the collision-corrected Jaccard estimate drops those six standard
errors below the threshold, and every link is then confirmed on full sets.

No group is ever paired out.  Texts with equal sets share one representative.
A band bucket first links its members to its smallest one.  In buckets that
still hold several components, documents outside the largest are compared with
the rest by their registers (256 bytes a document), in blocks of 1024 documents.
Sizes that cannot reach the threshold and the estimate leave few pieces of block
pairs; only the documents in those fetch their texts, as shingle sets, and a
piece gives one confirmed link for each two components it joins.  So every
candidate pair is confirmed, refused, or already joined by confirmed links.
Steps without rows are skipped, and labels found before are carried on.

Null and empty texts have empty sets and link with nothing.  Rows with a null
id are returned with a null component and ``kept`` true.  Ids should be unique:
rows that repeat an id are judged each by its own text, under the one id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from quarry.llm.bitmap import rows_with_ids
from quarry.llm.components import components, extended, sized
from quarry.llm.runtime import prepare
from quarry.plans.materialize import materialize, materialize_observed

REGISTERS = 128
BAND = 4
BANDS = REGISTERS // BAND
MANTISSA = 10
_BUCKET_BITS = 7
_VALUE_BITS = 52
_EMPTY = np.uint64(1 << 53)
BLOCK = 1024            # documents whose registers are compared together
PIECE_SHINGLES = 1 << 16  # of the documents whose full sets are compared together


def registers(hashes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """HyperMinHash registers (texts x 128, uint16) of sets given end to end,
    and the number of buckets filled without borrowing."""
    from quarry.llm.words import mix64

    n = len(offsets) - 1
    low = np.full(n * REGISTERS, _EMPTY, np.uint64)
    h = mix64(hashes ^ np.uint64(0x5851F42D4C957F2D))
    owner = np.repeat(np.arange(n), np.diff(offsets))
    slot = owner * REGISTERS + (h >> np.uint64(64 - _BUCKET_BITS)).astype(np.int64)
    value = ((h << np.uint64(_BUCKET_BITS)) >> np.uint64(64 - _VALUE_BITS)) + np.uint64(1)
    np.minimum.at(low, slot, value)
    low = low.reshape(n, REGISTERS)
    full = low != _EMPTY
    filled = full.sum(1)
    # exponent and leading mantissa bits of a float64 are the leading-zero
    # count and the mantissa of the minimum
    code = (low.astype(np.float64).view(np.uint64) >> np.uint64(52 - MANTISSA)) - np.uint64(1023 << MANTISSA)
    code = code.astype(np.uint16)
    row, col = np.nonzero(~full & (filled > 0)[:, None])
    step = 0
    while len(row):
        step += 1
        probe = (mix64(col.astype(np.uint64) * np.uint64(0x100000001B3) + np.uint64(step))
                 & np.uint64(REGISTERS - 1)).astype(np.int64)
        if step > 4096:  # a fixed last resort: the first filled bucket
            probe = full[row].argmax(1)
        got = full[row, probe]
        code[row[got], col[got]] = code[row[got], probe[got]]
        row, col = row[~got], col[~got]
    return code, filled


def octave_masses(n: np.ndarray) -> np.ndarray:
    """Probability of each octave for the minimum of a bucket, by set size."""
    octave = np.arange(0, 44, dtype=np.float64)
    hi, lo = 2.0 ** -octave, 2.0 ** -(octave + 1)
    per = np.maximum(np.asarray(n) / REGISTERS, 1.0)[:, None]
    return np.exp(-per * lo) - np.exp(-per * hi)


def chance_match(n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Probability that two buckets hold equal codes for different minima: the
    two must fall into one octave and one of its 2^10 mantissa cells."""
    return (octave_masses(n_a) * octave_masses(n_b)).sum(1) / (1 << MANTISSA)


def estimate(regs_a: np.ndarray, regs_b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Collision-corrected Jaccard estimate of register rows."""
    equal = (regs_a == regs_b).mean(1)
    chance = chance_match(n_a, n_b)
    return (equal - chance) / (1 - chance)


def _sketch_fn(width: int, id_col: str, text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from quarry.llm.words import mix64, shingle_sets, text_blocks

        for batch in batches:
            ids = batch.column(0)
            for at, texts in text_blocks(batch.column(1)):
                hashes, off = shingle_sets(texts, width)
                size = np.diff(off)
                regs, filled = registers(hashes, off)
                sums = []
                for seed in (0x1F83D9ABFB41BD6B, 0x5BE0CD19137E2179):
                    run_sum = np.zeros(len(hashes) + 1, np.uint64)
                    np.cumsum(mix64(hashes ^ np.uint64(seed)), out=run_sum[1:])
                    sums.append((run_sum[off[1:]] - run_sum[off[:-1]]).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(at, len(texts)), pa.array(size), pa.array(filled.astype(np.int32)),
                     pa.array(sums[0]), pa.array(sums[1]),
                     pa.array([r.tobytes() for r in regs], pa.binary())],
                    names=["doc_id", "n_shingles", "filled", "sig_a", "sig_b", "regs"])
    return run


def _verify_fn(width: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from quarry.llm.words import shingle_sets, text_blocks

        def sets_of(column):
            """Shingle set of each row; a repeated text is split once."""
            coded = column.dictionary_encode()
            sets = []
            for _, texts in text_blocks(coded.dictionary):
                h, off = shingle_sets(texts, width)
                sets += [h[x:y] for x, y in zip(off[:-1], off[1:], strict=True)]
            return [sets[i] for i in coded.indices.to_pylist()]

        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                ok = []
                for a, b in zip(sets_of(part.column(2)), sets_of(part.column(3)), strict=True):
                    both = len(np.intersect1d(a, b, assume_unique=True))
                    ok.append(both > 0 and 100 * both >= percent * (len(a) + len(b) - both))
                keep = pa.array(ok)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).filter(keep), part.column(1).filter(keep)], names=["a", "b"])
    return run


_ENDS = "array<struct<doc_id:long,label:long>>"


def _pieces(sizes: np.ndarray) -> np.ndarray:
    """Bounds of runs of documents of at most PIECE_SHINGLES together (a larger
    one alone)."""
    bounds, total = [0], 0
    for k, n in enumerate(sizes.tolist()):
        if total and total + n > PIECE_SHINGLES:
            bounds.append(k)
            total = 0
        total += n
    return np.array([*bounds, len(sizes)])


def _survivors_fn(percent: int):
    """Pieces of a block pair in which some two documents of different labels may
    reach the threshold, with just those documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from quarry.llm.near_dedup import REGISTERS as k, _pieces, octave_masses

        t = percent / 100

        def read(block):
            names = ("doc_id", "label", "n_shingles", "filled")
            doc, label, n, filled = (block.field(c).to_numpy() for c in names)
            regs = np.frombuffer(b"".join(block.field("regs").to_pylist()), np.uint16).reshape(-1, k)
            order = np.argsort(n, kind="stable")   # like sizes stand together
            return doc[order], label[order], n[order], filled[order], np.ascontiguousarray(regs[order].T)

        def listed(doc, label):
            return pa.StructArray.from_arrays([pa.array(doc), pa.array(label)], names=["doc_id", "label"])

        for batch in batches:
            for i in range(batch.num_rows):
                dx, lx, nx, fx, rx = read(batch.column(0)[i].values)
                dy, ly, ny, fy, ry = read(batch.column(1)[i].values)
                may = lx[:, None] != ly[None, :]
                may &= 100 * np.minimum(nx[:, None], ny[None, :]) >= percent * np.maximum(nx[:, None], ny[None, :])
                if not may.any():
                    continue
                equal = np.zeros(may.shape, np.uint8)
                for r in range(k):
                    equal += rx[r][:, None] == ry[r][None, :]
                chance = octave_masses(nx) @ octave_masses(ny).T / (1 << MANTISSA)
                est = (equal / k - chance) / (1 - chance)
                full = np.minimum(k, np.minimum(fx[:, None], fy[None, :])).astype(float)
                may &= est >= t - 6 * np.sqrt(t * (1 - t) / full)
                bx, by = _pieces(nx), _pieces(ny)
                xs, ys, sizes = [], [], []
                for x0, x1 in zip(bx[:-1], bx[1:], strict=True):
                    for y0, y1 in zip(by[:-1], by[1:], strict=True):
                        part = may[x0:x1, y0:y1]
                        px, py = x0 + np.flatnonzero(part.any(1)), y0 + np.flatnonzero(part.any(0))
                        if len(px):
                            xs.append(px)
                            ys.append(py)
                            sizes.append((len(px), len(py)))
                if sizes:
                    ox, oy = (np.cumsum([0, *c]).astype(np.int32) for c in zip(*sizes, strict=True))
                    px, py = np.concatenate(xs), np.concatenate(ys)
                    yield pa.RecordBatch.from_arrays(
                        [pa.ListArray.from_arrays(pa.array(ox), listed(dx[px], lx[px])),
                         pa.ListArray.from_arrays(pa.array(oy), listed(dy[py], ly[py]))], names=["xs", "ys"])
    return run


def _sets_fn(width: int):
    """(doc_id, hashes): the full shingle set of each text, as bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from quarry.llm.words import shingle_sets, text_blocks

        for batch in batches:
            for at, texts in text_blocks(batch.column(1)):
                h, off = shingle_sets(texts, width)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(texts)),
                     pa.array([h[x:y].tobytes() for x, y in zip(off[:-1], off[1:], strict=True)], pa.binary())],
                    names=["doc_id", "hashes"])
    return run


def _compare_fn(percent: int):
    """Label pairs that some confirmed link of a piece joins, each once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def sets_of(block, side):
            block = block.filter(pa.array(block.field("side").to_numpy() == side))
            sets = [np.frombuffer(b, np.uint64) for b in block.field("hashes").to_pylist()]
            sizes = np.array([len(x) for x in sets], np.int64)
            return block.field("label").to_numpy(), np.repeat(np.arange(len(sets)), sizes), np.concatenate(sets), sizes

        for batch in batches:
            for i in range(batch.num_rows):
                block = batch.column(0)[i].values
                (lx, ox, hx, nx), (ly, oy, hy, ny) = sets_of(block, 0), sets_of(block, 1)
                common = np.intersect1d(hx, hy)
                keep_x, keep_y = np.isin(hx, common), np.isin(hy, common)
                ox, cx = ox[keep_x], np.searchsorted(common, hx[keep_x])
                oy, cy = oy[keep_y], np.searchsorted(common, hy[keep_y])
                both = np.zeros((len(nx), len(ny)))
                for lo in range(0, len(common), 2048):  # columns of the incidence matrices
                    m, n = np.zeros((len(nx), 2048), np.float32), np.zeros((len(ny), 2048), np.float32)
                    px, py = (cx >= lo) & (cx < lo + 2048), (cy >= lo) & (cy < lo + 2048)
                    m[ox[px], cx[px] - lo] = 1
                    n[oy[py], cy[py] - lo] = 1
                    both += m @ n.T
                union = nx[:, None] + ny[None, :] - both
                px, py = np.nonzero((both > 0) & (100 * both >= percent * union) & (lx[:, None] != ly[None, :]))
                pairs = np.unique(np.column_stack([lx[px], ly[py]]), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])
    return run


def _with_label(rows: DataFrame, label: DataFrame, col: str, out: str) -> DataFrame:
    named = label.select(F.col("node").alias(col), F.col("label").alias("__q_label"))
    return (rows.join(named, col, "left").withColumn(out, F.coalesce("__q_label", col)).drop("__q_label"))


def _apart(pairs: DataFrame, label: DataFrame) -> DataFrame:
    """The (a, b) rows whose ends have different labels."""
    return (_with_label(_with_label(pairs, label, "a", "la"), label, "b", "lb")
            .filter("la != lb").select("a", "b"))


def _torn(buckets: DataFrame, label: DataFrame) -> DataFrame:
    """(bucket, doc_id, label) of the buckets of three members or more with two
    labels or more."""
    named = _with_label(buckets.select("bucket", "doc_id"), label, "doc_id", "label")
    split = (named.groupBy("bucket").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count(F.lit(1)).alias("n"))
             .filter("lo != hi and n > 2").select("bucket"))
    return named.join(split, "bucket", "left_semi")


def _estimated(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """(a, b, est) of the pairs whose estimate may reach the threshold."""
    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from quarry.llm.near_dedup import REGISTERS as k, estimate as est_of

        for p in batches:
            if len(p):
                a, b = (np.frombuffer(b"".join(p[c]), np.uint16).reshape(-1, k) for c in ("ra", "rb"))
                est = est_of(a, b, p.na.to_numpy(float), p.nb.to_numpy(float))
                eff = np.minimum(k, np.minimum(p.fa, p.fb)).to_numpy(float)
                t = percent / 100
                ok = est >= t - 6 * np.sqrt(t * (1 - t) / eff)
                yield pd.DataFrame({"a": p.a[ok], "b": p.b[ok], "est": est[ok]})

    def side(end: str) -> DataFrame:
        return reps.select(F.col("doc_id").alias(end), F.col("regs").alias("r" + end),
                           F.col("n_shingles").alias("n" + end), F.col("filled").alias("f" + end))
    return (pairs.join(side("b"), "b").join(side("a"), "a")
            .mapInPandas(score, "a long, b long, est double"))


def _confirmed(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The (a, b) rows whose full sets reach the threshold."""
    def side(end: str) -> DataFrame:
        return texts.select(F.col("doc_id").alias(end), F.col("text").alias("t" + end))
    return (pairs.select("a", "b").join(side("b"), "b").join(side("a"), "a")
            .select("a", "b", "ta", "tb")
            .mapInArrow(_verify_fn(width, percent), "a long, b long"))


def _texts_of(source: DataFrame, ids: DataFrame, n_ids: int) -> DataFrame:
    """The rows of ``source`` whose doc_id is listed."""
    near, _ = rows_with_ids(source, "doc_id", ids, n_ids)
    return near.join(ids, "doc_id", "left_semi")


def _torn_links(torn: DataFrame, n_torn: int, reps: DataFrame, source: DataFrame, width: int, percent: int) -> DataFrame | None:
    """(a, b) label pairs joined by links between documents of one torn bucket.

    A document belongs to the home of its most crowded bucket, the largest label
    there; documents of that label are the inner ones, and inner blocks of one
    home are not compared with each other.
    """
    main = (torn.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("k"))
            .groupBy("bucket").agg(F.max(F.struct("k", "label")).alias("most"), F.sum("k").alias("crowd")))
    home = (torn.join(main, "bucket").groupBy("doc_id", "label")
            .agg(F.max(F.struct("crowd", F.col("most.label").alias("home"))).alias("top"))
            .select("doc_id", "label", F.col("top.home").alias("home"))
            .withColumn("inner", F.col("label") == F.col("home")))
    counts = home.groupBy("home", "inner").agg(F.count(F.lit(1)).alias("k"))
    placed, _ = materialize(sized(
        home.join(counts, ["home", "inner"])
        .withColumn("block", F.expr(f"""struct(home, inner,
            pmod(xxhash64(doc_id), cast(ceil(k / {BLOCK}) AS bigint)) AS piece)"""))
        .select("doc_id", "label", "block"), n_torn), "placed")
    blocks = (placed.join(reps, "doc_id").groupBy("block")
              .agg(F.collect_list(F.struct("doc_id", "label", "n_shingles", "filled", "regs")).alias("docs")))
    per_bucket = torn.select("bucket", "doc_id").join(placed.select("doc_id", "block"), "doc_id").select("bucket", "block").distinct()
    mates = (per_bucket.withColumnRenamed("block", "x")
             .join(per_bucket.withColumnRenamed("block", "y"), "bucket")
             .filter("x <= y and not (x.inner and y.inner and x.home = y.home)").select("x", "y").distinct())
    pieces, _, seen = materialize_observed(
        mates.join(blocks.select(F.col("block").alias("y"), F.col("docs").alias("ys")), "y")
        .join(blocks.select(F.col("block").alias("x"), F.col("docs").alias("xs")), "x")
        .select("xs", "ys").mapInArrow(_survivors_fn(percent), f"xs {_ENDS}, ys {_ENDS}"), "pieces",
        ends=F.sum(F.size("xs") + F.size("ys")))
    if not seen["rows"]:
        return None
    def sided(c: str, side: int):
        return F.transform(c, lambda d: F.struct(d["doc_id"].alias("doc_id"), d["label"].alias("label"), F.lit(side).alias("side")))
    ends = (pieces.select(F.xxhash64("xs", "ys").alias("piece"), F.explode(F.concat(sided("xs", 0), sided("ys", 1))).alias("d"))
            .select("piece", "d.doc_id", "d.label", "d.side").distinct())
    wanted, _ = materialize(sized(ends.select("doc_id").distinct(), min(n_torn, seen["ends"])), "wanted")
    sets, _ = materialize(sized(_texts_of(source, wanted, n_torn), 50 * n_torn)
                          .mapInArrow(_sets_fn(width), "doc_id long, hashes binary"), "sets")
    joined = ends.join(sets, "doc_id").groupBy("piece").agg(F.collect_list(F.struct("side", "label", "hashes")).alias("docs"))
    return joined.select("docs").mapInArrow(_compare_fn(percent), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    width: int = 5, percent: int = 75) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept and
    class_id (smallest id with the same set)."""
    prepare(docs.sparkSession)
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sketch, _ = materialize(source.mapInArrow(
        _sketch_fn(width, "doc_id", "text"),
        "doc_id long, n_shingles long, filled int, sig_a long, sig_b long, regs binary"), "sketch")

    # equal sets: one representative each
    keys = ["sig_a", "sig_b", "n_shingles"]
    known = sketch.filter("n_shingles > 0 and doc_id is not null")
    classes = known.groupBy(*keys).agg(F.min("doc_id").alias("rep"))
    members = sketch.select("doc_id", *keys).join(classes, keys, "left")
    label = _linked(source, known, classes, keys, width, percent)
    if label is None:
        return members.select("doc_id", "n_shingles", F.coalesce("rep", "doc_id").alias("component_id"),
                              F.expr("doc_id is null or doc_id = coalesce(rep, doc_id)").alias("kept"),
                              F.coalesce("rep", "doc_id").alias("class_id"))
    return (members.join(label.withColumnRenamed("node", "rep"), "rep", "left")
            .select("doc_id", "n_shingles",
                    F.coalesce("label", "rep", "doc_id").alias("component_id"),
                    F.expr("doc_id is null or doc_id = coalesce(label, rep, doc_id)").alias("kept"),
                    F.coalesce("rep", "doc_id").alias("class_id")))


def _linked(source: DataFrame, known: DataFrame, classes: DataFrame, keys: list[str], width: int, percent: int) -> DataFrame | None:
    """(node, label) of the representatives that confirmed links lead to a smaller
    one; None without any."""
    reps, _ = materialize(
        known.join(classes.withColumnRenamed("rep", "doc_id"), ["doc_id", *keys], "left_semi")
        .select("doc_id", "n_shingles", "filled", "regs").dropDuplicates(["doc_id", "regs"]), "reps")

    # band buckets with two members or more
    banded = (reps.select("doc_id", "regs", F.explode(F.sequence(F.lit(0), F.lit(BANDS - 1))).alias("band"))
              .select("doc_id", F.expr(f"xxhash64(band, substring(regs, band * {2 * BAND} + 1, {2 * BAND}))").alias("bucket")))
    shared = (banded.groupBy("bucket").agg(F.min("doc_id").alias("hub"), F.max("doc_id").alias("top"))
              .filter("hub != top").drop("top"))
    buckets, _, seen = materialize_observed(banded.join(shared, "bucket"), "buckets")
    if not seen["rows"]:
        return None

    # each member with its bucket's smallest one; the likeliest link first
    star, _, seen = materialize_observed(sized(_estimated(
        buckets.filter("doc_id != hub").select(F.col("hub").alias("a"), F.col("doc_id").alias("b")).distinct(),
        reps, percent), 20 * seen["rows"]), "star")
    if seen["rows"]:
        involved, _ = materialize(sized(star.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), 2 * seen["rows"]), "involved")
        texts, _ = materialize(sized(_texts_of(source, involved, 2 * seen["rows"]), 50 * 2 * seen["rows"]), "texts")
    else:
        texts = source.limit(0)
    best = (star.groupBy("b").agg(F.max(F.struct("est", (-F.col("a")).alias("neg"))).alias("top"))
            .select((-F.col("top.neg")).alias("a"), "b"))
    first = sized(_confirmed(best, texts, width, percent), 50 * seen["rows"])
    label = components(first, "a", "b")

    # the other links to bucket minima that still join two components
    rest = _apart(star.join(best, ["a", "b"], "left_anti").select("a", "b"), label)
    rest, _, more = materialize_observed(sized(rest, seen["rows"]), "rest")
    if more["rows"]:
        label = extended(label, sized(_confirmed(rest, texts, width, percent), 50 * more["rows"]), "a", "b")

    # buckets of three or more that still hold two components or more (the one
    # pair of a smaller bucket is settled)
    torn, _, left = materialize_observed(_torn(buckets, label), "torn")
    if left["rows"]:
        third = _torn_links(torn, left["rows"], reps, source, width, percent)
        if third is not None:
            label = extended(label, third, "a", "b")
    return label


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, with all their columns."""
    decided, _ = materialize(near_duplicates(docs, id_col, text_col)
                             .filter("not kept").select(F.col("doc_id").alias("__q_id")).distinct(), "dropped")
    maybe, clear = rows_with_ids(docs.withColumn("__q_id", F.col(id_col).cast("long")), "__q_id",
                                 decided, decided.count())
    stay = maybe.join(decided, "__q_id", "left_anti")
    return clear.unionByName(stay).select(*[F.col(c) for c in docs.columns])
