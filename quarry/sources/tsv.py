"""Tab-separated text: readers (plain, tagged, labelled matrix rows) and
writers (plain, one group per key value).

Files carry no header and no quoting; a field is everything between two tabs.
``on_error="fail"`` raises on a value that does not parse (ANSI ``cast``),
``on_error="null"`` turns it into NULL (``try_cast`` / permissive parsing).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from string import Formatter

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from quarry.session import scratch_path

_MODES = {"fail": "FAILFAST", "null": "PERMISSIVE"}

# Header dialects of labelled matrix rows: "A1", "A:1", "A1:4" (name, row
# number, optional size of the other operand).  Fixed format.
MATRIX_HEADER = r"^([A-Za-z]+):?(\d+)(?::(\d+))?$"


def _paths(paths) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def _schema(schema) -> T.StructType:
    return T._parse_datatype_string(schema) if isinstance(schema, str) else schema


def _cast(c: Column, dtype: T.DataType, on_error: str) -> Column:
    if isinstance(dtype, T.StringType):
        return c
    return c.try_cast(dtype) if on_error == "null" else c.cast(dtype)


def read_tsv(spark: SparkSession, paths, schema, on_error: str = "fail") -> DataFrame:
    """Scan one or many tab-separated paths with a positional schema.

    The CSV source with quoting off: splits are planned by file size, columns
    a query does not use are not converted.  Empty fields read as NULL.
    """
    return (spark.read.schema(_schema(schema))
            .option("sep", "\t").option("quote", "").option("header", "false")
            .option("mode", _MODES[on_error])
            .csv(_paths(paths)))


def _lines(spark: SparkSession, paths) -> DataFrame:
    # Blank lines carry no record; a carriage return ends a line.
    line = F.regexp_replace(F.col("value"), r"\r+$", "")
    return spark.read.text(_paths(paths)).select(line.alias("_l")).where(F.length("_l") > 0)


def _fields(spark: SparkSession, paths, trim: bool = False) -> DataFrame:
    # ``trim`` drops trailing tabs, as a plain field split does
    line = F.regexp_replace("_l", r"\t+$", "") if trim else F.col("_l")
    return _lines(spark, paths).select(F.split(line, "\t", -1).alias("f"))


def _value(k: int, dtype: T.DataType, on_error: str) -> Column:
    """Field ``k``: missing or empty is NULL."""
    return _cast(F.nullif(F.get("f", F.lit(k)), F.lit("")), dtype, on_error)


def read_tagged(spark: SparkSession, paths, schemas: Mapping[str, object],
                on_error: str = "fail") -> dict[str, DataFrame]:
    """Split a file that mixes record kinds, told apart by the first field,
    into one typed DataFrame per tag.

    ``schemas`` maps a tag to the schema of the fields after the tag; missing
    and empty fields are NULL.  A row of another tag is an error in
    ``on_error="fail"``; in ``"null"`` such rows come in the extra frame
    ``None`` as ``(tag, line)``, so that no row vanishes.  Each frame is its own
    filtered scan of the input (as one mapper per kind would be); nothing is
    cached.
    """
    fields = _fields(spark, paths)
    tag = F.col("f")[0]
    known = tag.isin(*schemas)
    frames: dict = {}
    for name, schema in schemas.items():
        wanted = tag == F.lit(name)
        if on_error == "fail":
            wanted = F.when(known, wanted).otherwise(F.raise_error(F.concat(F.lit("unknown tag: "), tag)))
        frames[name] = fields.where(wanted).select(
            *[_value(k + 1, fld.dataType, on_error).alias(fld.name)
              for k, fld in enumerate(_schema(schema).fields)])
    if on_error == "null":
        frames[None] = fields.where(~known).select(tag.alias("tag"), F.array_join("f", "\t").alias("line"))
    return frames


def read_vectors(spark: SparkSession, paths, lead: str = "", tail: str = "", prefix: str | None = None,
                 features: str = "features", value_type: str = "double", on_error: str = "fail",
                 trim: bool | None = None) -> DataFrame:
    """Rows of a vector of any width between leading and trailing fields.

    ``lead`` and ``tail`` are schemas of the fields before and after the vector
    (``lead="id string, cluster int"`` for observations with their cluster,
    ``tail="label string"`` for rows with the class last).  With ``prefix``, only
    rows whose first field starts with it are read (``"D"`` for data rows in a
    file that also holds a row of start weights).

    An empty field is NULL, inside the vector too.  Tabs at the end of a line are
    no fields (``trim``) unless there are trailing fields, which they would be;
    with ``trim=False`` a vector written with a NULL at its end comes back whole.
    """
    fields = _fields(spark, paths, trim=not tail if trim is None else trim)
    if prefix is not None:
        fields = fields.where(F.col("f")[0].startswith(prefix))
    first, last = _schema(lead or "struct<>").fields, _schema(tail or "struct<>").fields
    n, size = len(first), F.size("f")
    dtype = T._parse_datatype_string(value_type)
    body = F.transform(F.slice("f", n + 1, F.greatest(F.lit(0), size - n - len(last))),
                       lambda v: _cast(F.nullif(v, F.lit("")), dtype, on_error))
    ends = [_cast(F.nullif(F.get("f", size - len(last) + k), F.lit("")), fld.dataType, on_error).alias(fld.name)
            for k, fld in enumerate(last)]
    return fields.select(*[_value(k, fld.dataType, on_error).alias(fld.name) for k, fld in enumerate(first)],
                         body.alias(features), *ends)


def read_weights(spark: SparkSession, paths, name: str = "ALPHA", on_error: str = "fail") -> DataFrame:
    """The row ``name<TAB>w1<TAB>w2..`` as a weight table ``(j, w)``, 1-based."""
    fields = _fields(spark, paths, trim=True).where(F.col("f")[0] == F.lit(name))
    return (fields.select(F.posexplode(F.slice("f", 2, F.size("f"))).alias("_p", "_v"))
            .select((F.col("_p") + 1).alias("j"), _cast(F.col("_v"), T.DoubleType(), on_error).alias("w")))


def read_matrix(spark: SparkSession, paths, value_type: str = "double",
                on_error: str = "fail", base: int = 1) -> DataFrame:
    """Labelled matrix rows (``A1<TAB>v..``, ``A:1<TAB>v..``, ``A1:4<TAB>v..``)
    to cells ``(matrix, i, j, v)``; column numbers start at ``base``."""
    fields = _fields(spark, paths, trim=True)
    header = F.col("f")[0]
    name = F.regexp_extract(header, MATRIX_HEADER, 1)
    row = F.regexp_extract(header, MATRIX_HEADER, 2)
    bad = name == F.lit("")
    if on_error == "fail":
        name = F.when(bad, F.raise_error(F.concat(F.lit("bad matrix header: "), header))) \
                .otherwise(name)
    cells = fields.select(name.alias("matrix"), (row.try_cast("int") if on_error == "null" else row.cast("int")).alias("i"),
                          F.posexplode(F.slice("f", 2, F.size("f"))).alias("_p", "_v"))
    if on_error == "null":
        cells = cells.where((F.col("matrix") != F.lit("")) & F.col("i").isNotNull())
    dtype = T._parse_datatype_string(value_type)
    return cells.select("matrix", "i", (F.col("_p") + base).alias("j"),
                        _cast(F.col("_v"), dtype, on_error).alias("v"))


_BREAK = "[\t\n\r]"


def to_tsv_line(df: DataFrame, cols: Iterable[str] | None = None) -> Column:
    """One text line per row: fields joined by tabs, arrays spread over
    consecutive fields, NULL as an empty field.  A text with a tab or line end,
    alone or in an array, cannot be written so and is an error."""
    parts = []
    fields = {f.name: f.dataType for f in df.schema.fields}
    for name in (cols or df.columns):
        dtype = fields[name]
        bad = F.raise_error(F.lit(f"tab or line end in column {name}"))
        if isinstance(dtype, T.ArrayType):
            text = F.array_join(F.transform(name, lambda x: x.cast("string")), "\t", "")
            if isinstance(dtype.elementType, T.StringType):
                text = F.when(F.exists(name, lambda x: F.coalesce(x.rlike(_BREAK), F.lit(False))), bad).otherwise(text)
        else:
            text = F.col(name).cast("string")
        if isinstance(dtype, T.StringType):
            text = F.when(text.rlike(_BREAK), bad).otherwise(text)
        parts.append(F.coalesce(text, F.lit("")))
    return F.concat_ws("\t", *parts)


def write_tsv(df: DataFrame, path: str, single_file: bool = False,
              mode: str = "overwrite") -> None:
    """Write rows as tab-separated text, one file per task.

    ``single_file`` funnels everything through one task; meant for small
    final results only.
    """
    out = df.select(to_tsv_line(df).alias("value"))
    if single_file:
        out = out.coalesce(1)
    out.write.mode(mode).text(path)


def write_lines(df: DataFrame, path: str, template: str, single_file: bool = False, mode: str = "overwrite") -> None:
    """One formatted line per row: ``template`` is text with ``{column}`` places,
    for example ``"C{i}\\t{row}"`` or ``"mean = {mean}\\tvar = {var}"``; arrays are
    spread over tabs, NULL is empty."""
    parts = []
    for text, name, _, _ in Formatter().parse(template):
        parts.append(F.lit(text))
        if name:
            parts.append(to_tsv_line(df, [name]))
    out = df.select(F.concat(*parts).alias("value"))
    (out.coalesce(1) if single_file else out).write.mode(mode).text(path)


# names of the directories of special keys; texts that begin like one of them are
# written behind KEPT_KEY, so that they stay apart
EMPTY_KEY, KEPT_KEY, NULL_KEY = "__EMPTY__", "__KEY__", "__HIVE_DEFAULT_PARTITION__"


def _key_text(col: str) -> Column:
    text = F.col(col).cast("string")
    special = text.startswith(EMPTY_KEY) | text.startswith(KEPT_KEY) | text.startswith(NULL_KEY)
    return (F.when(text == "", F.lit(EMPTY_KEY)).when(special, F.concat(F.lit(KEPT_KEY), text))
            .otherwise(text).alias(col))


def read_by_value(spark: SparkSession, path: str, schema, col: str, key_type: str = "string",
                  on_error: str = "fail") -> DataFrame:
    """Read what ``write_by_value`` wrote as tab-separated text; the key comes
    back with its own type (``01`` stays ``01``, the empty text is not NULL, and
    neither is a text that looks like the name of NULL's directory)."""
    st = T.StructType([*_schema(schema).fields, T.StructField(col, T.StringType())])
    rows = read_tsv(spark, path, st, on_error)
    text = F.col(col)
    key = (F.when(text == EMPTY_KEY, F.lit("")).when(text.startswith(KEPT_KEY), F.substring(text, len(KEPT_KEY) + 1, 1 << 30))
           .otherwise(text))
    return rows.withColumn(col, _cast(key, T._parse_datatype_string(key_type), on_error))


def write_by_value(df: DataFrame, path: str, col: str, fmt: str = "tsv",
                   mode: str = "overwrite") -> None:
    """One output group (directory ``col=value``) per value of ``col``.

    Rows are rebalanced by ``col`` first, so a value's rows meet in few
    tasks; AQE splits a value that holds a large share of the data over
    several tasks (several files in its directory) and merges small ones.  An
    empty text key has a directory of its own, apart from NULL.
    """
    if isinstance(df.schema[col].dataType, T.StringType):
        df = df.withColumn(col, _key_text(col))
    balanced = df.hint("rebalance", col)
    if fmt == "tsv":
        rest = [c for c in df.columns if c != col]
        balanced.select(to_tsv_line(df, rest).alias("value"), col) \
                .write.mode(mode).partitionBy(col).text(path)
    else:
        balanced.write.mode(mode).partitionBy(col).format(fmt).save(path)


def write_parts(df: DataFrame, path: str, number: Column | str, files: int, mode: str = "overwrite") -> None:
    """Part file ``k`` holds exactly the rows whose ``number`` is ``k``.

    ``number`` is the caller's partition function, any integer expression over the
    row from 0 to ``files - 1``; another value or NULL is an error, so no row lands
    in a file by accident.  A file is one task's, however many rows its number
    has: that is what one file per value means (``write_by_value`` splits instead).
    """
    n = F.col(number) if isinstance(number, str) else number
    inside = n.between(0, files - 1)
    checked = F.when(inside, n.cast("int")).otherwise(F.raise_error(F.concat(
        F.lit(f"no file of {files} for number "), F.coalesce(n.cast("string"), F.lit("NULL")))))
    out = df.select(to_tsv_line(df).alias("value"), checked.alias("_n"))
    out.repartitionById(files, "_n").select("value").write.mode(mode).text(path)


def read_parts(spark: SparkSession, path: str, schema, number: str = "number", on_error: str = "fail") -> DataFrame:
    """The rows of ``write_parts`` with the number of the file they lie in."""
    rows = read_tsv(spark, path, schema, on_error)
    return rows.withColumn(number, F.regexp_extract(F.col("_metadata.file_name"), r"^part-(\d+)", 1).cast("int"))


@dataclass(frozen=True)
class Kind:
    """One kind of record in mixed input: its schema and how it is told -- by the
    first field (``tag``, which is no part of the schema), by how the first field
    begins (``prefix``) or by the file or folder it lies in (``path``); several must
    all hold.  One field of the schema may be an array: it takes the fields between
    those before and those behind it."""

    schema: str
    tag: str | None = None
    prefix: str | None = None
    path: str | None = None


def _file_uri(spark: SparkSession, path: str) -> str:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(p).toString()


def _typed(kind: Kind, on_error: str) -> Column:
    """The record of a line as a struct; ``f`` are its fields, ``g`` those without
    tabs at the end of the line."""
    fields = _schema(kind.schema).fields
    at = next((k for k, fld in enumerate(fields) if isinstance(fld.dataType, T.ArrayType)), None)
    shift = 0 if kind.tag is None else 1
    if at is None:
        return F.struct(*[_cast(F.nullif(F.get("f", F.lit(k + shift)), F.lit("")), fld.dataType, on_error).alias(fld.name)
                          for k, fld in enumerate(fields)])
    behind = len(fields) - at - 1
    line = F.col("f") if behind else F.col("g")
    out = []
    for k, fld in enumerate(fields):
        if k == at:
            item = fld.dataType.elementType
            body = F.slice(line, at + shift + 1, F.greatest(F.lit(0), F.size(line) - at - shift - behind))
            value = _items(body, item, on_error)
        else:
            place = F.lit(k + shift) if k < at else F.size(line) - (len(fields) - k)
            value = _cast(F.nullif(F.get(line, place), F.lit("")), fld.dataType, on_error)
        out.append(value.alias(fld.name))
    return F.struct(*out)


def _items(body: Column, item: T.DataType, on_error: str) -> Column:
    return F.transform(body, lambda v: _cast(F.nullif(v, F.lit("")), item, on_error))


def routed_lines(spark: SparkSession, paths, kinds: Mapping[str, Kind], on_error: str = "fail") -> DataFrame:
    """Every line of ``paths`` once, as ``kind`` and one struct column per kind, of
    which that of the line's own kind is set (the first kind that fits); one
    scan.  A line of no kind is an error or, with ``on_error="null"``, has a NULL
    kind and stands in ``line``."""
    lines = (spark.read.text(_paths(paths))
             .select(F.regexp_replace(F.col("value"), r"\r+$", "").alias("_l"), F.col("_metadata.file_path").alias("_path"))
             .where(F.length("_l") > 0))
    rows = lines.select("_l", "_path", F.split("_l", "\t", -1).alias("f"),
                        F.split(F.regexp_replace("_l", r"\t+$", ""), "\t", -1).alias("g"))
    told = None
    for name, kind in kinds.items():
        here = F.lit(True)
        if kind.tag is not None:
            here &= F.col("f")[0] == F.lit(kind.tag)
        if kind.prefix is not None:
            here &= F.col("f")[0].startswith(kind.prefix)
        if kind.path is not None:
            uri = _file_uri(spark, kind.path).rstrip("/")
            here &= (F.col("_path") == F.lit(uri)) | F.col("_path").startswith(uri + "/")
        told = F.when(here, F.lit(name)) if told is None else told.when(here, F.lit(name))
    if on_error == "fail":
        told = told.otherwise(F.raise_error(F.concat(F.lit("a line of no kind: "), F.left("_l", F.lit(100)))))
    rows = rows.withColumn("kind", told)
    records = [F.when(F.col("kind") == name, _typed(kind, on_error)).alias(f"r_{name}") for name, kind in kinds.items()]
    return rows.select("kind", *records, F.when(F.col("kind").isNull(), F.col("_l")).alias("line"))


def read_kinds(spark: SparkSession, paths, kinds: Mapping[str, Kind], on_error: str = "fail") -> dict:
    """Mixed input to one typed DataFrame per kind with a single scan of it.

    The lines are parsed once and written, one folder per kind, below the
    checkpoint folder; each frame reads its own folder and columns only.  With
    ``on_error="null"`` lines of no kind come in the extra frame ``None`` as
    ``(line,)``.
    """
    routed = routed_lines(spark, paths, kinds, on_error)
    path = scratch_path(spark, "kinds")
    routed.write.partitionBy("kind").parquet(path)
    written = spark.read.schema(routed.schema).parquet(path)
    frames: dict = {name: written.where(F.col("kind") == name).select(f"r_{name}.*") for name in kinds}
    if on_error == "null":
        frames[None] = written.where(F.col("kind").isNull()).select("line")
    return frames
