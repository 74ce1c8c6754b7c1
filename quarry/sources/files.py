"""Results as one file, without one task for all of them.

The text is written in sorted parts by as many tasks as the data need, and the
parts are joined by the file system: with its own ``concat`` where it has one (no
byte is copied), else by copying part after part in pieces of a few megabytes.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quarry.operators.matrix import row_chunks
from quarry.session import scratch_path
from quarry.sources.tsv import to_tsv_line

_COPY_BYTES = 4 << 20


def concatenate(spark: SparkSession, folder: str, target: str, end: bytes = b"") -> None:
    """Join the part files of ``folder`` in the order of their numbers, and
    ``end``, to the one file ``target``, which appears when it is whole."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path
    goal = path(target)
    fs, source = goal.getFileSystem(conf), path(folder)
    parts = [s.getPath() for s in source.getFileSystem(conf).listStatus(source) if s.getPath().getName().startswith("part-")]
    parts.sort(key=lambda p: (int(re.match(r"part-(\d+)", p.getName())[1]), p.getName()))
    growing = path(goal.getParent(), f".{goal.getName()}-{uuid.uuid4().hex}")
    out = fs.create(growing, True)
    left = parts
    try:
        if parts and not _joined(spark, fs, growing, out, parts):
            for p in parts:
                read = p.getFileSystem(conf).open(p)
                jvm.org.apache.hadoop.io.IOUtils.copyBytes(read, out, _COPY_BYTES, False)
                read.close()
        else:
            left = []
            if parts:
                out = fs.append(growing)
        if end:
            out.write(end)
    finally:
        out.close()
    if fs.exists(goal):
        fs.delete(goal, False)
    if not fs.rename(growing, goal):
        raise OSError(f"could not name {target}")
    for p in left:
        p.getFileSystem(conf).delete(p, False)


def _joined(spark: SparkSession, fs, target, out, parts: list) -> bool:
    """Let the file system join the parts, if it can."""
    if fs.getScheme() not in ("hdfs", "webhdfs", "swebhdfs"):
        return False
    out.close()
    array = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Path, len(parts))
    for k, p in enumerate(parts):
        array[k] = p
    fs.concat(target, array)
    return True


def write_sorted_file(df: DataFrame, path: str, *order: Column | str) -> None:
    """Rows as one tab-separated file in a global order.

    The rows are range-partitioned by ``order``, each task sorts and writes its
    range, and the parts are joined; no task sees all rows.
    """
    spark = df.sparkSession
    parts = scratch_path(spark, "sorted-parts")
    df.orderBy(*order).select(to_tsv_line(df).alias("value")).write.text(parts)
    concatenate(spark, parts, path)


def write_wide_rows(cells: DataFrame, path: str, header: Column, chunk: int = 1 << 16, base: int = 1) -> None:
    """Matrix rows as lines of one file, ``header<TAB>v<TAB>v<TAB>..``, whatever their
    width; ``header`` is an expression over ``i``.

    Cells come in pieces of at most ``chunk`` columns, sorted over all tasks by row
    and piece, and every piece is written behind the one before: a row may begin in
    one task and end in another, and no task holds a row.  Absent cells are left out,
    NULL is empty, and every line ends in a tab (the readers here drop it).
    """
    spark = cells.sparkSession
    number = F.floor((F.col("j") - base) / chunk)
    first = cells.groupBy("i").agg(F.min(number).alias("chunk")).withColumn("_starts", F.lit(True))
    lowest = cells.agg(F.min("i")).scalar()
    pieces = row_chunks(cells, chunk, base).join(first, ["i", "chunk"], "left")
    start = F.concat(F.when(F.col("i") == lowest, F.lit("")).otherwise(F.lit("\n")), header.cast("string"), F.lit("\t"))
    values = F.array_join(F.transform("row", lambda v: v.cast("string")), "\t", "")
    text = F.concat(F.when(F.col("_starts"), start).otherwise(F.lit("")), values)
    parts = scratch_path(spark, "wide-rows")
    # each piece is followed by a tab, so pieces of one row run on
    pieces.select("i", "chunk", text.alias("value")).orderBy("i", "chunk").select("value").write.option("lineSep", "\t").text(parts)
    concatenate(spark, parts, path, end=b"\n")
