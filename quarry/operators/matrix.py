"""Sparse-cell matrix algebra.

The core form of a matrix is a cell table ``(i, j, v)``; a dense row form
``(i, row array<double>)`` is converted with ``to_cells`` / ``to_rows``.  Cell
tables partition freely, so no operator needs a whole row or column in one
task except ``to_rows`` (one task per row, bounded by the row width).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from quarry.session import ship_package


def to_cells(rows: DataFrame, id_col: str = "i", vec_col: str = "row",
             base: int = 1) -> DataFrame:
    """Unpivot a row vector into cells; column positions start at ``base``."""
    return rows.select(F.col(id_col).alias("i"),
                       F.posexplode(vec_col).alias("_p", "_v")) \
               .select("i", (F.col("_p") + base).alias("j"),
                       F.col("_v").cast("double").alias("v"))


def to_rows(cells: DataFrame, base: int = 1, width: int | None = None) -> DataFrame:
    """Reassemble rows in column order: ``(i, row array<double>)``.

    Without ``width`` a row holds its present cells in ascending ``j``; with
    ``width`` it is dense, positions ``base .. base+width-1``, absent cells 0;
    a cell outside them is an error.
    """
    if width is not None:
        inside = F.col("j").between(base, base + width - 1)
        cells = cells.withColumn("j", F.when(inside, F.col("j")).otherwise(F.raise_error(F.concat(
            F.lit(f"cell outside {width} columns: "), F.concat_ws(",", F.col("i").cast("string"), F.col("j").cast("string"))))))
    entries = F.sort_array(F.collect_list(F.struct("j", "v")))
    grouped = cells.groupBy("i").agg(entries.alias("_e"))
    if width is None:
        row = F.transform("_e", lambda e: e["v"])
    else:
        lookup = F.map_from_entries("_e")
        row = F.transform(F.sequence(F.lit(base), F.lit(base + width - 1)),
                          lambda j: F.coalesce(F.element_at(lookup, j), F.lit(0.0)))
    return grouped.select("i", row.alias("row"))


def row_chunks(cells: DataFrame, chunk: int = 1 << 16, base: int = 1) -> DataFrame:
    """Rows of any width in pieces: ``(i, chunk, row)`` where ``row`` holds the
    present cells of columns ``base + chunk * size ..`` in ascending ``j``; any value
    type.  A group never exceeds ``chunk`` cells, so a row of millions of columns is
    dealt over many tasks.  ``orderBy("i", "chunk")`` gives the rows in reading
    order without gathering any."""
    grouped = cells.groupBy("i", F.floor((F.col("j") - base) / chunk).alias("chunk")).agg(
        F.sort_array(F.collect_list(F.struct("j", "v"))).alias("_e"))
    return grouped.select("i", "chunk", F.transform("_e", lambda e: e["v"]).alias("row"))


def transpose(cells: DataFrame) -> DataFrame:
    """Swap row and column index; any value type."""
    return cells.select(F.col("j").alias("i"), F.col("i").alias("j"), "v")


def scale(cells: DataFrame, s: float) -> DataFrame:
    """Multiply every cell by the scalar ``s``."""
    return cells.select("i", "j", (F.lit(float(s)) * F.col("v")).alias("v"))


def _named(cells: DataFrame, name: str | None) -> DataFrame:
    return cells if name is None else cells.select(F.lit(name).alias("matrix"), "i", "j", "v")


def _combine(a: DataFrame, b: DataFrame, sign: float) -> DataFrame:
    # A union followed by a grouped sum: one shuffle with map-side combining,
    # cheaper than a full outer join, and a cell missing on one side counts 0.
    both = a.select("i", "j", F.col("v").cast("double").alias("v")).unionByName(
        b.select("i", "j", (F.lit(sign) * F.col("v").cast("double")).alias("v")))
    return both.groupBy("i", "j").agg(F.sum("v").alias("v"))


def add(a: DataFrame, b: DataFrame, name: str | None = None) -> DataFrame:
    """Cell-wise ``A + B``; absent cells are 0.  With ``name``, the result
    carries a ``matrix`` column holding it."""
    return _named(_combine(a, b, 1.0), name)


def subtract(a: DataFrame, b: DataFrame, name: str | None = None) -> DataFrame:
    """Cell-wise ``A - B``; absent cells are 0.  With ``name``, the result
    carries a ``matrix`` column holding it."""
    return _named(_combine(a, b, -1.0), name)


def matmul(a: DataFrame, b: DataFrame, name: str | None = None) -> DataFrame:
    """Matrix product ``A * B`` of two cell tables.

    Joins A's column index with B's row index and sums the products per
    ``(i, k)``.  The products stream from the join straight into a partial
    aggregate, so they are never shuffled; AQE splits an inner index that
    holds a large share of both sides.  Result cells are ``(i, j, v)``
    (plus ``matrix`` = ``name`` if given).
    """
    left = a.select(F.col("i").alias("_i"), F.col("j").alias("_m"),
                    F.col("v").cast("double").alias("_a"))
    right = b.select(F.col("i").alias("_m"), F.col("j").alias("_k"),
                     F.col("v").cast("double").alias("_b"))
    product = left.join(right, "_m").groupBy("_i", "_k") \
                  .agg(F.sum(F.col("_a") * F.col("_b")).alias("v")) \
                  .select(F.col("_i").alias("i"), F.col("_k").alias("j"), "v")
    return _named(product, name)


_BLOCK_PRODUCT_SCHEMA = "i long, j long, v double"


def _block_products(batches):
    """mapInPandas body: for each pair of blocks (A block, B block sharing the
    inner block index) multiply them densely and emit, in global coordinates,
    the cells of the partial product that some pair of stored cells reaches."""
    import numpy as np
    import pandas as pd

    for pdf in batches:
        out_i, out_j, out_v = [], [], []
        for r in pdf.itertuples(index=False):
            ar, ac, av = np.asarray(r.a_r), np.asarray(r.a_c), np.asarray(r.a_v, dtype=float)
            br, bc, bv = np.asarray(r.b_r), np.asarray(r.b_c), np.asarray(r.b_v, dtype=float)
            rows, inner = int(ar.max()) + 1, max(int(ac.max()), int(br.max())) + 1
            cols = int(bc.max()) + 1
            # dense blocks; repeated cells add up, as in the cell-join product
            da = np.bincount(ar * inner + ac, weights=av,
                             minlength=rows * inner).reshape(rows, inner)
            db = np.bincount(br * cols + bc, weights=bv,
                             minlength=inner * cols).reshape(inner, cols)
            prod = da @ db
            ma, mb = np.zeros((rows, inner), np.float32), np.zeros((inner, cols), np.float32)
            ma[ar, ac], mb[br, bc] = 1, 1
            ii, kk = np.nonzero(ma @ mb)
            out_i.append(ii + r.bi * r.size + r.base_i)
            out_j.append(kk + r.bk * r.size + r.base_j)
            out_v.append(prod[ii, kk])
        if out_i:
            yield pd.DataFrame({"i": np.concatenate(out_i).astype("int64"),
                                "j": np.concatenate(out_j).astype("int64"),
                                "v": np.concatenate(out_v)})


def _blocks(cells: DataFrame, size: int, base: int) -> DataFrame:
    # Cells grouped into size x size blocks: at most size^2 entries a group.
    local = cells.select(
        F.floor((F.col("i") - base) / size).alias("br"),
        F.floor((F.col("j") - base) / size).alias("bc"),
        F.pmod(F.col("i") - base, F.lit(size)).cast("int").alias("r"),
        F.pmod(F.col("j") - base, F.lit(size)).cast("int").alias("c"),
        F.col("v").cast("double").alias("v"))
    grouped = local.groupBy("br", "bc").agg(
        F.collect_list(F.struct("r", "c", "v")).alias("_cells"))
    return grouped.select("br", "bc",
                          F.transform("_cells", lambda x: x["r"]).alias("rr"),
                          F.transform("_cells", lambda x: x["c"]).alias("cc"),
                          F.transform("_cells", lambda x: x["v"]).alias("vv"))


def matmul_blocked(a: DataFrame, b: DataFrame, block: int = 256, base: int = 1,
                   name: str | None = None) -> DataFrame:
    """Matrix product for large dense inputs: ``(i, j, v)`` like ``matmul``.

    Cells are grouped into ``block x block`` blocks (a group never exceeds
    ``block^2`` cells), A's blocks are joined with B's blocks on the inner
    block index, and each pair is multiplied densely with numpy in Arrow
    batches (``mapInPandas``).  Partial products are summed per cell with
    map-side combining.  Compared with ``matmul`` the join emits one row per
    block pair instead of one per scalar product, and the arithmetic runs in
    BLAS.  The result has the same cells as ``matmul``, exact zeros included.
    """
    ship_package(a.sparkSession)
    ab = _blocks(a, block, base)
    bb = _blocks(b, block, base)
    pairs = ab.join(bb.withColumnRenamed("br", "bc_inner").withColumnRenamed("bc", "bk")
                      .withColumnRenamed("rr", "b_r").withColumnRenamed("cc", "b_c")
                      .withColumnRenamed("vv", "b_v"),
                    F.col("bc") == F.col("bc_inner")) \
        .select(F.col("br").alias("bi"), "bk",
                F.col("rr").alias("a_r"), F.col("cc").alias("a_c"), F.col("vv").alias("a_v"),
                "b_r", "b_c", "b_v", F.lit(block).alias("size"),
                F.lit(base).alias("base_i"), F.lit(base).alias("base_j"))
    products = pairs.mapInPandas(_block_products, _BLOCK_PRODUCT_SCHEMA)
    return _named(products.groupBy("i", "j").agg(F.sum("v").alias("v")), name)
