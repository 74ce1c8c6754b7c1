"""Lloyd's k-means starting from given assignments.

Observations are ``(id, cluster, features array)``; centres are
``(cluster, center array<double>)``.  Assignment is a narrow projection: the
centres are model parameters and reach the observations as broadcasts of at
most ``CENTRE_BYTES`` each.  A larger model is compared block after block: each
block is one pass that writes the nearest centre so far, and its broadcast is
dropped before the next, so neither a task nor the driver ever holds more of
the model than one block.

The rounds of ``kmeans`` carry two bounds per observation: the distance to its
own centre is at most ``upper``, to any other at least ``lower``.  When the centres
move, the bounds give way by as much (triangle inequality); where they still
stand apart, no distance is computed.

One set of rules for every model size: squared distances are summed position by
position from the first; ties go to the lowest cluster; a NULL vector, or one
with a NULL or NaN distance to every centre, gets a NULL cluster; a vector whose
length differs from the centres' is an error; observations without a start
cluster form no centre but are assigned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from quarry.functions.vector import as_double_vector
from quarry.plans.materialize import materialize, materialize_observed
from quarry.session import scratch_path, ship_package

CENTRE_BYTES = 32 << 20     # of one broadcast
DISTANCE_CELLS = 1 << 20    # of one rows x centres block in a task
#: bounds must stand apart by this share, far beyond the rounding of a distance
APART = 1e-9


def kmeans_update(obs: DataFrame, cluster: str = "cluster",
                  features: str = "features") -> DataFrame:
    """Mean vector per cluster: ``(cluster, center)``.

    Vectors are exploded to ``(cluster, position, value)`` inside the map
    stage and partially averaged there; a cluster holding a third of all rows
    still ships one partial row per position and task.  A cluster without
    observations has no centre.
    """
    cells = obs.where(F.col(cluster).isNotNull()).select(
        F.col(cluster).alias("cluster"),
        F.posexplode(as_double_vector(features)).alias("_j", "_x"))
    means = cells.groupBy("cluster", "_j").agg(F.avg("_x").alias("_m"))
    return means.groupBy("cluster").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("_j", "_m"))),
                    lambda s: s["_m"]).alias("center"))


def _vectors(column: pa.ListArray, d: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the vectors that are not NULL, and those as a matrix (NaN for a
    NULL entry)."""
    rows = np.flatnonzero(column.is_valid().to_numpy(zero_copy_only=False))
    sizes = column.value_lengths().drop_null().to_numpy()
    if (sizes != d).any():
        raise ValueError(f"a vector of length {sizes[sizes != d][0]} against centres of length {d}")
    return rows, column.flatten().to_numpy(zero_copy_only=False).astype(float, copy=False).reshape(len(rows), d)


def squared_distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Rows x centres, summed position by position; NaN counts as infinite."""
    sums = np.zeros((len(x), len(centres)))
    for j in range(centres.shape[1]):  # a fixed order of summation
        sums += (x[:, j, None] - centres[None, :, j]) ** 2
    sums[np.isnan(sums)] = np.inf
    return sums


def nearest_two(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place of the nearest centre (the first of equal ones; -1: none) and the
    squared distances to it and to the nearest other one."""
    n, k = len(x), len(centres)
    best, first, second = np.full(n, -1), np.full(n, np.inf), np.full(n, np.inf)
    step_k = max(1, min(k, DISTANCE_CELLS))
    step_n = max(1, DISTANCE_CELLS // step_k)
    for lo in range(0, n, step_n):
        part = slice(lo, lo + step_n)
        for c in range(0, k, step_k):
            sums = squared_distances(x[part], centres[c:c + step_k])
            at = sums.argmin(1)  # the first of equal ones
            rows = np.arange(len(sums))
            low = sums[rows, at]
            sums[rows, at] = np.inf
            closer = low < first[part]
            second[part] = np.minimum(np.where(closer, first[part], low), np.minimum(second[part], sums.min(1)))
            best[part] = np.where(closer, c + at, best[part])
            first[part] = np.where(closer, low, first[part])
    return best, first, second


def _centre_blocks(centers: DataFrame) -> Iterator[tuple[list, np.ndarray]]:
    """(ids, matrix) blocks of at most CENTRE_BYTES, by ascending cluster."""
    rows, size = [], 0
    for r in centers.where("cluster is not null").select("cluster", "center").orderBy("cluster").toLocalIterator():
        if rows and size + 8 * len(r["center"]) > CENTRE_BYTES:
            yield [x[0] for x in rows], np.array([x[1] for x in rows], dtype=float)
            rows, size = [], 0
        rows.append((r["cluster"], r["center"]))
        size += 8 * len(r["center"])
    if rows:
        yield [x[0] for x in rows], np.array([x[1] for x in rows], dtype=float)


def _with(schema: T.StructType, *extra: tuple[str, T.DataType]) -> T.StructType:
    names = {n for n, _ in extra}
    return T.StructType([f for f in schema.fields if f.name not in names] + [T.StructField(*e) for e in extra])


def _block_fn(shared, kind: pa.DataType, vector: str, rest: list[str]):
    """``mapInArrow`` body: the nearest centre of a block, where it is nearer than
    the one so far in ``_d``, ``_c`` (absent before the first block)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, centres = shared.value
        names = pa.array(ids, kind)
        for batch in batches:
            rows, x = _vectors(batch.column(vector), centres.shape[1])
            at, low = np.full(batch.num_rows, -1), np.full(batch.num_rows, np.inf)
            at[rows], low[rows], _ = nearest_two(x, centres)
            found = names.take(pa.array(at, mask=at < 0))
            if "_d" in batch.schema.names:
                before = batch.column("_d").to_numpy()
                keep = pa.array(low < before)    # an equal one of an earlier block stays
                found = pc.if_else(keep, found, batch.column("_c"))
                low = np.minimum(low, before)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in rest], pa.array(low), found], names=[*rest, "_d", "_c"])
    return run


def kmeans_assign(obs: DataFrame, centers: DataFrame, cluster: str = "cluster",
                  features: str = "features") -> DataFrame:
    """Set ``cluster`` of every observation to its nearest centre (squared
    Euclidean distance; ties go to the lowest cluster).

    The observations are only scanned and projected, never shuffled.  The
    centres come to the driver block by block (they are sorted by cluster); for
    every block but the last the running nearest is written to the checkpoint
    folder.
    """
    spark = obs.sparkSession
    ship_package(spark)
    kind = centers.schema["cluster"].dataType
    others = [c for c in obs.columns if c != cluster]
    rest = [*others, "_v"]
    now = obs.select(*others, as_double_vector(features).alias("_v"))
    last = None
    for ids, matrix in _centre_blocks(centers):
        if last is not None:
            now, _ = materialize(now, "kmeans-block")
            last.destroy()
        last = spark.sparkContext.broadcast((ids, matrix))
        schema = _with(now.select(*rest).schema, ("_d", T.DoubleType()), ("_c", kind))
        now = now.mapInArrow(_block_fn(last, to_arrow_type(kind), "_v", rest), schema)
    picked = F.lit(None).cast(kind) if last is None else F.col("_c")
    return now.select(*others, picked.alias(cluster))


def _bounded_fn(shared, kind: pa.DataType):
    """``mapInArrow`` body over (id, features, cluster, _upper, _lower): the same
    with new clusters and bounds, the previous cluster and the number of
    distances computed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, centres, moved = shared.value
        names = pa.array(ids, kind)
        if len(ids):
            order = np.argsort(-moved)
            furthest = np.full(len(ids), moved[order[0]])    # that any other centre has moved
            furthest[order[0]] = moved[order[1]] if len(ids) > 1 else 0.0
        for batch in batches:
            n, d = batch.num_rows, centres.shape[1]
            rows, x = _vectors(batch.column(1), d) if len(ids) else (np.zeros(0, int), np.zeros((0, d)))
            before = batch.column(2)
            own = pc.index_in(before, value_set=names).fill_null(-1).to_numpy()[rows]
            upper, lower = (batch.column(k).to_numpy(zero_copy_only=False)[rows] for k in (3, 4))
            known = (own >= 0) & np.isfinite(upper) & ~np.isnan(lower)
            upper = np.where(known, upper + moved[own], np.inf) if len(ids) else upper
            lower = np.where(known, lower - furthest[own], 0.0) if len(ids) else lower
            counted = np.zeros(n, np.int64)
            # first the bounds alone, then the distance to the own centre, then to all
            near = np.flatnonzero(known & ~(upper * (1 + APART) < lower))
            for at in range(0, len(near), DISTANCE_CELLS):
                part = near[at:at + DISTANCE_CELLS]
                own_sum = np.zeros(len(part))
                for j in range(d):
                    own_sum += (x[part, j] - centres[own[part], j]) ** 2
                upper[part] = np.sqrt(own_sum)
                counted[rows[part]] += 1
            open_ = np.flatnonzero(~(known & (upper * (1 + APART) < lower)))
            best, first, second = nearest_two(x[open_], centres)
            counted[rows[open_]] += len(ids)
            own[open_], upper[open_], lower[open_] = best, np.sqrt(first), np.sqrt(second)
            at, u, lo = np.full(n, -1), np.full(n, np.nan), np.full(n, np.nan)
            at[rows], u[rows], lo[rows] = own, upper, lower
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), names.take(pa.array(at, mask=at < 0)), pa.array(u), pa.array(lo),
                 before, pa.array(counted)], names=["id", "features", "cluster", "_upper", "_lower", "_prev", "_counted"])
    return run


def _movement(ids: list, matrix: np.ndarray, old: dict) -> np.ndarray:
    """How far each centre is from where it was (0 for a centre without a past: no
    observation has a bound to it)."""
    out = np.zeros(len(ids))
    for i, c in enumerate(ids):
        if c in old:
            out[i] = np.sqrt(((matrix[i] - old[c]) ** 2).sum()) * (1 + APART)
    return out


def kmeans(obs: DataFrame, max_rounds: int, id_col: str = "id",
           cluster: str = "cluster", features: str = "features",
           report: list | None = None) -> tuple[DataFrame, DataFrame]:
    """Update and assign from the given assignments, then up to ``max_rounds``
    further rounds while some observation still moves.

    Returns ``(assignments, centers)``: the final ``(id, cluster, features)``
    and the centres used by the last assignment.  A round writes the new
    assignment to the checkpoint folder and observes during that write how many
    observations kept their cluster.  While the centres fit one broadcast, the
    rounds carry distance bounds along; the result is that of comparing all.
    ``report`` receives a dict per round: ``rows``, ``unmoved`` and ``distances``,
    the number of distances computed (None without bounds).
    """
    spark = obs.sparkSession
    ship_package(spark)
    current = obs.select(id_col, cluster, features)
    kind = current.schema[cluster].dataType
    bounds: DataFrame | None = None
    old: dict = {}
    # Rounds alternate between two paths: round r overwrites round r-2,
    # which nothing reads any more, so storage stays at two rounds.
    base = scratch_path(spark, "kmeans")
    rounds = 0
    while True:
        centers = kmeans_update(current, cluster, features)
        blocks = _centre_blocks(centers)
        ids, matrix = next(blocks, ([], np.zeros((0, 0))))
        if next(blocks, None) is None:
            state = bounds if bounds is not None else current.select(
                F.col(id_col).alias("id"), F.col(features).alias("features"), F.col(cluster).alias("cluster"),
                F.lit(None).cast("double").alias("_upper"), F.lit(None).cast("double").alias("_lower"))
            shared = spark.sparkContext.broadcast((ids, matrix, _movement(ids, matrix, old)))
            schema = _with(state.schema, ("cluster", kind), ("_upper", T.DoubleType()), ("_lower", T.DoubleType()),
                           ("_prev", kind), ("_counted", T.LongType()))
            moved = state.mapInArrow(_bounded_fn(shared, to_arrow_type(kind)), schema)
            old = dict(zip(ids, matrix, strict=True))
            counted = F.sum("_counted")
        else:
            shared, old = None, {}
            moved = kmeans_assign(current.withColumn("_prev", F.col(cluster)), centers, cluster, features).select(
                F.col(id_col).alias("id"), F.col(features).alias("features"), F.col(cluster).alias("cluster"),
                F.lit(None).cast("double").alias("_upper"), F.lit(None).cast("double").alias("_lower"), "_prev",
                F.lit(None).cast("long").alias("_counted"))
            counted = F.max("_counted")
        nxt, _, m = materialize_observed(
            moved, "kmeans-assign", path=f"{base}/round-{rounds % 2}",
            unmoved=F.sum(F.col("cluster").eqNullSafe(F.col("_prev")).cast("long")), distances=counted)
        if shared is not None:
            shared.destroy()
        if report is not None:
            report.append({k: m[k] for k in ("rows", "unmoved", "distances")})
        bounds = nxt.drop("_prev", "_counted")
        current = nxt.select(F.col("id").alias(id_col), F.col("cluster").alias(cluster),
                             F.col("features").alias(features))
        if rounds >= max_rounds or (m["unmoved"] or 0) >= m["rows"]:
            break
        rounds += 1
    return current, centers
