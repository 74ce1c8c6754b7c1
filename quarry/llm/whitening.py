"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

Entries become whole numbers ``x = floor(64 * c) + 1000000``; rows are centred
exactly (``n * x - S`` is a whole number, divided once), so the large common
offset costs no digits.  With centred rows ``X`` a step takes a right vector
``v`` to ``X v``, orthogonalises it against all earlier left vectors, and takes
the result back by ``X' u``, orthogonalised against all earlier right vectors.
A left vector is as long as the table and is never held: it is ``X g`` for a
short vector ``g``, so each task makes its own rows of all left vectors and one
scan yields ``|p|^2``, ``U' p`` and ``X' p`` together.  Tasks send one number per
position; Spark sums them.  The small upper bidiagonal matrix is decomposed on
the driver.

The driver and the broadcasts hold at most 3 d^2 numbers for vectors of length d,
whatever the number of rows.

Defined results: rows with a null vector, or with a null or non-finite entry,
are dropped, as is an entry too large for ``x`` to be a 53-bit whole number;
of vectors of different lengths those of the commonest length remain (the
longer of equally common ones); an empty vector counts as null.  Repeated rows
and repeated or null ids stay as they are.  Components whose deviation is not
above ``RANK`` times the largest are noise of the arithmetic and are left out,
so a constant table, a single row and an empty table have no rows.  Equal
eigenvalues come in any order.  A deviation beyond a long is null.  Other
columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from quarry.llm.runtime import prepare
from quarry.plans.materialize import materialize

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
#: deviation of a component, against the largest, that is still told from rounding
RANK = 1e-9
#: a Ritz pair stands when its residual is below this share of the largest deviation
SETTLED = 1e-14
_LARGEST = float(1 << 53)


def clean(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(id, x array<long>) of the rows that count."""
    c = F.col(vec_col).cast("array<double>")
    ok = F.forall(c, lambda e: e.isNotNull() & (F.abs(e) * SCALE < _LARGEST))  # false for NaN and infinities
    kept = vectors.select(F.col(id_col).alias("id"), F.when(ok & (F.size(c) > 0), c).alias("c")).filter("c is not null")
    return kept.select("id", F.transform("c", lambda e: F.floor(e * SCALE) + OFFSET).alias("x"))


def _block(column: pa.Array) -> np.ndarray:
    """The rows of a list column as a matrix of longs."""
    if not len(column):
        return np.zeros((0, 0), np.int64)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _sums_fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums per position as high and low halves (no overflow in a task), and at
    position -1 the rows and the largest absolute value."""
    high = low = None
    n = most = 0
    for batch in batches:
        x = _block(batch.column(0))
        if len(x):
            h, lo = (x >> 26).sum(0), (x & ((1 << 26) - 1)).sum(0)
            high, low = (h, lo) if high is None else (high + h, low + lo)
            n, most = n + len(x), max(most, int(np.abs(x).max()))
    if n:
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(-1, len(high), dtype=np.int32)), pa.array(np.r_[n, high]), pa.array(np.r_[0, low]),
             pa.array(np.r_[most, np.zeros(len(high), np.int64)])], names=["pos", "high", "low", "most"])


class Centre:
    """Row count, sums and exact centring of the fit list."""

    def __init__(self, n: int, sums: list[int], most: int):
        self.n, self.sums = n, sums
        self.wide = 2 * n * max(most, 1) >= 1 << 62  # else longs hold n * x - S

    def differences(self, x: np.ndarray) -> np.ndarray:
        if self.wide:
            return x.astype(object) * self.n - np.array(self.sums, object)
        return x * self.n - np.array(self.sums, np.int64)

    def rows(self, x: np.ndarray) -> np.ndarray:
        return self.differences(x).astype(float) / self.n

    def deviations(self, x: np.ndarray) -> list[int | None]:
        diff = self.differences(x)
        far = [int(v) for v in np.abs(diff).max(1, initial=0)]
        if max(far, default=0) ** 2 * x.shape[1] >= 1 << 62:
            diff = diff.astype(object)
        return [v if v < 1 << 63 else None for v in map(int, (diff * diff).sum(1))]


def _fit_list(rows: DataFrame) -> Centre | None:
    def total(c: str):
        return F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    got = (rows.select("x").mapInArrow(_sums_fn, "pos int, high long, low long, most long")
           .groupBy("pos").agg(total("high"), total("low"), F.max("most").alias("most")).collect())
    if not got:
        return None
    got.sort(key=lambda r: r.pos)
    return Centre(int(got[0].high), [(int(r.high) << 26) + int(r.low) for r in got[1:]], int(got[0].most))


def _summed(rows: DataFrame, per_batch, length: int) -> np.ndarray:
    """Sum over all rows of what ``per_batch`` makes of a matrix of rows: one
    vector a task, summed by position."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(length)
        for batch in batches:
            if batch.num_rows:
                total += per_batch(_block(batch.column(0)))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["pos", "val"])
    got = (rows.select("x").mapInArrow(run, "pos int, val double")
           .groupBy("pos").agg(F.sum("val").alias("val")).collect())
    out = np.zeros(length)
    for r in got:
        out[r.pos] = r.val
    return out


def _fresh(basis: np.ndarray, seed: int) -> np.ndarray | None:
    """A unit vector orthogonal to the columns of ``basis``."""
    d = len(basis)
    rng = np.random.default_rng(seed)
    for _ in range(8):
        v = rng.standard_normal(d)
        for _ in range(3):
            v -= basis @ (basis.T @ v)
        size = np.linalg.norm(v)
        if size > 1e-8:
            return v / size
    return None


class Bidiagonal:
    """Right vectors ``v``, the combinations ``g`` with left vectors ``X g``, and
    the bidiagonal matrix of a run."""

    def __init__(self, d: int):
        self.d = d
        self.v, self.g = np.zeros((d, 0)), np.zeros((d, 0))
        self.alpha: list[float] = []
        self.beta: list[float] = []  # beta[k] joins steps k and k + 1
        self.back = np.zeros((d, 0))  # X' u of each step

    def matrix(self) -> np.ndarray:
        return np.diag(self.alpha) + np.diag(self.beta[:len(self.alpha) - 1], 1)

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Deviations times sqrt(n), falling; directions; residuals."""
        left, s, right = np.linalg.svd(self.matrix())
        directions = self.v @ right.T
        return s, directions, np.abs(self.beta[-1] * left[-1])


def bidiagonalise(rows: DataFrame, centre: Centre, wanted: int = COMPONENTS, seed: int = 13) -> tuple[Bidiagonal, float]:
    """Steps until the ``wanted`` largest pairs stand, and the trace of X' X.

    Where a run closes (its next vector vanishes) and when the wanted pairs
    stand, a fresh vector orthogonal to everything found opens another run, so
    that directions the first vector did not hold and equal eigenvalues are
    found; the end is d steps, or a run whose largest pair stands below the
    wanted ones.
    """
    d = len(centre.sums)
    run = Bidiagonal(d)
    v, trace, opened = _fresh(run.v, seed), 0.0, 0
    spark = rows.sparkSession
    while v is not None:
        k = len(run.alpha)
        joined = k > opened  # the step goes on from the one before
        h = v - run.beta[-1] * run.g[:, -1] if joined else v
        shared = spark.sparkContext.broadcast((centre, run.g, h))

        def step(x: np.ndarray, shared=shared) -> np.ndarray:
            middle, g, h = shared.value
            c = middle.rows(x)
            p = c @ h
            return np.concatenate([[p @ p, (c * c).sum()], (c @ g).T @ p, c.T @ p])
        got = _summed(rows, step, 2 + k + d)
        shared.destroy()
        size2, trace, along, z = got[0], got[1], got[2:2 + k], got[2 + k:]
        scale = max([*run.alpha, *run.beta, np.sqrt(size2)])
        h = h - run.g @ along                       # p orthogonal to every left vector
        z = z - run.back @ along
        alpha = float(np.sqrt(max(size2 - along @ along, 0.0)))
        run.v = np.column_stack([run.v, v])
        if scale == 0 or alpha <= 1e-13 * scale:    # X v lies in what is known: no left vector
            run.alpha.append(0.0)
            run.g = np.column_stack([run.g, np.zeros(d)])
            run.back = np.column_stack([run.back, np.zeros(d)])
            w = np.zeros(d)
        else:
            run.alpha.append(alpha)
            run.g = np.column_stack([run.g, h / alpha])
            run.back = np.column_stack([run.back, z / alpha])
            w = z / alpha - alpha * v
            for _ in range(2):
                w -= run.v @ (run.v.T @ w)
        beta = float(np.linalg.norm(w))
        run.beta.append(beta)
        if len(run.alpha) >= d:
            break
        closed = beta <= 1e-13 * max(scale, beta)
        s, _, left_over = run.pairs()
        standing = left_over <= SETTLED * s[0]
        if len(s) >= wanted and standing[:wanted].all():
            if opened and _largest_of(run, opened) < s[wanted - 1] * (1 - 1e-6):
                break
            closed = True
        if closed:
            run.beta[-1] = 0.0
            opened = len(run.alpha)
            v = _fresh(run.v, seed + opened)
        else:
            v = w / beta
    return run, trace


def _largest_of(run: Bidiagonal, opened: int) -> float:
    """Largest deviation of the run opened last, with its residual on top."""
    own = run.matrix()[opened:, opened:]
    left, s, _ = np.linalg.svd(own)
    return float(s[0] + abs(run.beta[-1] * left[-1, 0])) if len(s) else 0.0


def _whiten_fn(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        middle, axes, shares, error = shared.value
        k = axes.shape[1]
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                x = _block(part.column(1))
                m = len(x)
                white = middle.rows(x) @ axes
                each = pa.array(np.repeat(np.arange(m), k))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                     pa.array(np.full(m * k, middle.n)), pa.array(middle.deviations(x), pa.int64()).take(each),
                     pa.array(white.ravel()), pa.array(np.tile(shares, m)), pa.array(np.full(m * k, error))],
                    names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])
    return run


def whiten(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
           components: int = COMPONENTS) -> DataFrame:
    """One row per remaining vector and component: ``id_col``, component, n,
    deviation, whitened, explained, identity_error."""
    spark = vectors.sparkSession
    prepare(spark)
    kind = vectors.schema[id_col].dataType.simpleString()
    schema = "id " + kind + ", component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows, _ = materialize(clean(vectors, id_col, vec_col), "vectors")
    lengths = rows.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("k"))
    top = lengths.agg(F.max(F.struct("k", "d"))["d"]).first()[0]
    rows = rows.filter(F.size("x") == F.lit(top or 0))
    centre = _fit_list(rows)
    none = spark.createDataFrame([], schema).withColumnRenamed("id", id_col)
    if centre is None:
        return none
    found, trace = bidiagonalise(rows, centre, components)
    s, directions, _ = found.pairs()
    keep = [k for k in range(min(components, len(s))) if s[k] > RANK * s[0] and s[0] > 0]
    if not keep:
        return none
    e = s[keep] ** 2 / centre.n
    axes = directions[:, keep] / np.sqrt(e)
    k = len(keep)
    shared = spark.sparkContext.broadcast((centre, axes, e * centre.n / trace, 0.0))

    def products(x: np.ndarray) -> np.ndarray:
        middle, axes, _, _ = shared.value
        w = middle.rows(x) @ axes
        return np.concatenate([w.sum(0), (w.T @ w).ravel()])
    got = _summed(rows, products, k + k * k) / centre.n
    mean, cov = got[:k], got[k:].reshape(k, k)
    error = float(np.abs(cov - np.outer(mean, mean) - np.eye(k)).max())
    done = spark.sparkContext.broadcast((centre, axes, e * centre.n / trace, error))
    return rows.select("id", "x").mapInArrow(_whiten_fn(done), schema).withColumnRenamed("id", id_col)
