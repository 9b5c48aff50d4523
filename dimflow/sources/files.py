"""File sources of a batch folder: delimited dumps, ORC, listings, manifests
(S6, S7, S14, and the manifest side of M1).

A batch folder holds one directory per table (``<root>/<batch>/<table>/``)
with the dump's part files, the table's ``.schema`` sidecar and a manifest.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimflow.functions.typemap import spark_type

REASON = "_reject_reason"
RAW = "_raw"


def _schema(schema) -> T.StructType:
    if isinstance(schema, T.StructType):
        return schema
    fields = []
    for item in schema:
        name, typ = item if isinstance(item, (tuple, list)) else (item, "string")
        dt = typ if isinstance(typ, T.DataType) else spark_type(str(typ))
        fields.append(T.StructField(name, dt, True))
    return T.StructType(fields)


# What an escaped letter stands for in a delimited dump; any
# other escaped character stands for itself.
_UNESCAPES = [("\\n", "\n"), ("\\r", "\r"), ("\\t", "\t"), ("\\0", "\x00")]


def unescape(cell):
    """The cell that ``escape_cells`` wrote: pieces between escaped
    backslashes are restored one by one, then joined by a backslash."""
    def restore(x):
        for old, new in _UNESCAPES:
            x = F.replace(x, F.lit(old), F.lit(new))
        return F.regexp_replace(x, r"\\(.)", "$1")
    pieces = F.transform(F.split(cell, r"\\\\", -1), restore)
    return F.when(F.contains(cell, F.lit("\\")), F.array_join(pieces, "\\")).otherwise(cell)


def type_columns(df: DataFrame, schema) -> DataFrame:
    """Columns cast to the schema's types, with ``_raw`` and ``_reject_reason``
    as :func:`parse_delimited` gives them."""
    st = _schema(schema)
    reason = F.lit(None).cast("string")
    cols = []
    for f in st.fields:
        cell = F.col(f"`{f.name}`")
        typed = cell if df.schema[f.name].dataType == f.dataType else \
            cell.cast("string").try_cast(f.dataType)
        cols.append(typed.alias(f.name))
        reason = F.coalesce(reason, F.when(cell.isNotNull() & typed.isNull(),
                                           F.lit(f"bad value for {f.name}")))
    return df.select(*cols, F.to_json(F.struct(*df.columns)).alias(RAW), reason.alias(REASON))


def parse_delimited(lines: DataFrame, schema, sep: str = "|", value_col: str = "value",
                    null_if_empty: bool = True, escaped: bool = True,
                    keep: Sequence[str] = ()) -> DataFrame:
    """S6 core: split text lines into typed columns, marking rejects.

    Rules (the warehouse's ``COPY ... TRAILING NULLCOLS DELIMITER``; what
    counts as a reject beyond that is ours, stated here):
      * blank lines are dropped;
      * missing trailing fields are NULL (a short row is fine);
      * more fields than columns -> reject "too many fields";
      * a non-empty cell that does not cast to its column type -> reject
        "bad value for <column>";
      * an empty cell is NULL (the default NULL text is empty);
      * quotes are plain text; the separator is never escaped;
      * backslash escapes inside a cell are undone (``escaped=False`` leaves
        them), so cells come back as they were dumped.
    The result has the schema's columns plus ``_raw`` (the line) and
    ``_reject_reason`` (NULL for good rows), then the columns of ``lines`` named
    in ``keep``.  One pass, all expressions.
    """
    st = _schema(schema)
    parts = F.split(F.col(value_col), re.escape(sep), -1)
    n = len(st.fields)
    cols, bad = [], []
    src = lines.where(F.col(value_col) != "").select(F.col(value_col).alias(RAW), parts.alias("_p"),
                                                   *keep)
    for i, f in enumerate(st.fields):
        cell = F.when(F.size("_p") > i, F.col("_p")[i])
        if null_if_empty:
            cell = F.when(cell != "", cell)
        if escaped and isinstance(f.dataType, T.StringType):
            cell = unescape(cell)
        typed = cell if isinstance(f.dataType, T.StringType) else cell.try_cast(f.dataType)
        cols.append(typed.alias(f.name))
        bad.append(F.when(cell.isNotNull() & typed.isNull(), F.lit(f"bad value for {f.name}")))
    reason = F.when(F.size("_p") > n, F.lit("too many fields"))
    for b in bad:
        reason = F.coalesce(reason, b)
    return src.select(*cols, F.col(RAW), reason.alias(REASON), *keep)


def read_delimited(spark: SparkSession, path: str | Sequence[str], schema, sep: str = "|",
                   repartition: int | None = None) -> DataFrame:
    """Read a dump (plain or gzip text, one or many part files) and
    parse it with :func:`parse_delimited`.

    gzip is not splittable: each file is one task.  Dumps are written as many
    part files, and ``repartition`` spreads a few large files after parsing.
    """
    lines = spark.read.text(path)
    if repartition:
        lines = lines.repartition(repartition)
    return parse_delimited(lines, schema, sep)


def read_orc(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """An ORC batch; only the listed columns are read."""
    df = spark.read.orc(path)
    return df.select(*columns) if columns else df


def _parent(path_col):
    return F.regexp_replace(path_col, "/[^/]*$", "")


def list_batch(spark: SparkSession, path: str, recursive: bool = True) -> DataFrame:
    """The data files under ``path`` as ``(batch, name, path, length)``.

    Spark's own file listing (``binaryFile`` with the ``content`` column
    pruned, so no file is opened); listing runs in parallel across executors
    for large trees.  ``batch`` is the folder holding the file.  Hidden files
    (``_SUCCESS``, ``.crc``) are not listed -- see :func:`success_markers`.
    """
    df = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()) \
        .load(path).select("path", "length")
    return df.select(_parent(F.col("path")).alias("batch"),
                     F.element_at(F.split(F.col("path"), "/"), -1).alias("name"), "path", "length")


def success_markers(spark: SparkSession, batch_dirs) -> DataFrame:
    """Q3 input: ``(batch, has_success)`` for batch folders -- one
    ``exists`` call per folder on the driver (metadata only)."""
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    rows = []
    for d in batch_dirs:
        p = jvm.org.apache.hadoop.fs.Path(d.rstrip("/") + "/_SUCCESS")
        fs = p.getFileSystem(conf)
        rows.append((d.rstrip("/"), bool(fs.exists(p))))
    return spark.createDataFrame(rows, "batch string, has_success boolean")


def read_manifests(spark: SparkSession, path_glob: str):
    """M1 input: manifest documents -> ``(entries, batches)``.

    Each manifest is read whole (``wholetext``); ``batch`` is its folder.
    Entries may be bare names (``{"entries": ["a.gz"]}``, loader shape) or
    objects (``{"entries": [{"url": "s3://.../a.gz"}]}``, dumper shape); both
    become the file's base name (``url`` keeps the entry as written).
    ``batches(batch, valid)`` marks documents that did not parse as invalid
    (such a batch is never complete).
    """
    raw = spark.read.text(path_glob, wholetext=True) \
        .select(_parent(F.col("_metadata.file_path")).alias("batch"),
                F.from_json("value", "entries array<string>").alias("_doc"))
    batches = raw.select("batch", F.col("_doc.entries").isNotNull().alias("valid"))
    items = raw.where(F.col("_doc.entries").isNotNull()) \
        .select("batch", F.explode("_doc.entries").alias("_e"))
    url = F.when(F.col("_e").startswith("{"), F.get_json_object("_e", "$.url")).otherwise(F.col("_e"))
    entries = items.select("batch", F.element_at(F.split(url, "/"), -1).alias("name"), url.alias("url"))
    return entries, batches
