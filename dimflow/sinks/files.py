"""Batch-folder writers: dumps, sidecars, manifests, schema doc (K1-K5).

Every writer is a distributed ``DataFrameWriter`` call into a batch-named
folder with ``mode("overwrite")``, so a replayed run rewrites the same folder
instead of adding a second copy.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimflow.functions.cleanse import to_delimited
from dimflow.sinks import fs

# The text escaping a MySQL batch client applies to cells, so
# that one row stays one line (backslash first).
_ESCAPES = [("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t"), ("\x00", "\\0")]


def escape_cells(df: DataFrame, chars: str = "\\\n") -> DataFrame:
    """Escape line breaks (and backslashes) inside string cells, so each row
    is one line of the dump."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.StringType):
            for old, new in _ESCAPES:
                if old in chars:
                    c = F.replace(c, F.lit(old), F.lit(new))
        out.append(c.alias(f.name))
    return df.select(*out)


def dump_path(root: str, batch: str, table: str) -> str:
    """K1 location: ``<root>/<batch>/<table>/``."""
    return f"{root.rstrip('/')}/{batch}/{table}"


def write_dump(df: DataFrame, root: str, batch: str, table: str, sep: str = "|",
               compression: str = "gzip", escape: bool = True,
               partitions: int | None = None, level: str | None = "BEST_SPEED") -> str:
    """K1: the table as headerless delimited text (gzip part files).

    Cells are text-converted like C4 (NULL -> empty in every profile); line
    breaks, tabs, NUL characters and backslashes inside cells are escaped and
    come back as they were (S6).  Many part files keep the later (unsplittable gzip)
    read parallel: ``partitions`` deals the rows evenly, and a part larger than
    AQE's advisory size is split, so that neither a writing nor a reading task
    grows with the table.  gzip runs at its fastest
    level by default (``gzip --fast``: ~20% quicker, ~20% larger files).
    """
    path = dump_path(root, batch, table)
    data = escape_cells(df, "\\\n\r\t\x00") if escape else df
    lines = to_delimited(data, sep)
    if partitions:
        shuffled = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        lines = lines.hint("rebalance", max(partitions, shuffled))
    w = lines.write.mode("overwrite").option("compression", compression)
    if level and compression == "gzip":
        w = w.option("zlib.compress.level", level)
    w.text(path)
    return path


def write_schema_sidecar(lines: DataFrame, path: str) -> str:
    """K2: one table's ``<table>.schema`` sidecar file: header first, then
    the columns in ordinal order (``lines`` is P8's output for the table)."""
    return fs.write_single_file(lines.orderBy("ordinal").select("line"), path)


def write_schema_sidecars(lines: DataFrame, root: str) -> str:
    """K2 for many tables in one job: ``<root>/table_name=<t>/part-*``, each
    table's lines sorted by ordinal within its own file."""
    lines.repartition("table_name").sortWithinPartitions("table_name", "ordinal") \
        .select("table_name", "line").write.mode("overwrite").partitionBy("table_name").text(root)
    return root


def _document(items: DataFrame, key: str, item: str, order: Column, head: str) -> DataFrame:
    """The lines of a JSON document ``{"head": [item, ...]}`` in order: a head
    line, one line an item (``item``: its JSON text, ``key``: unique), a tail
    line.  No row holds more than one item."""
    first = items.agg(F.max_by(key, order)).scalar() if head == "tables" else \
        items.agg(F.min_by(key, order)).scalar()
    line = F.concat(F.when(F.col(key) == first, F.lit("")).otherwise(F.lit(",")), F.col(item))
    body = items.select(F.lit(1).alias("part"), order.alias("o"), line.alias("value"))
    ends = items.sparkSession.createDataFrame(
        [(0, f'{{"{head}":['), (2, "]}")], "part int, value string")
    ends = ends.select("part", F.lit(None).cast(body.schema["o"].dataType).alias("o"), "value")
    by = F.col("o").desc() if head == "tables" else F.col("o").asc()
    return ends.unionByName(body).orderBy("part", by).select("value")


def manifest_json(files: DataFrame, shape: str = "url") -> DataFrame:
    """K3 content: the lines of a JSON document listing every file of the
    batch, by name.

    ``files(url)``; ``shape='url'`` gives ``{"entries":[{"url":..}]}`` (dump
    side), ``'name'`` gives ``{"entries":["name",..]}`` (load side).
    """
    name = F.element_at(F.split(F.col("url"), "/"), -1)
    # a JSON string of the bare name: its object form without the key
    bare = F.regexp_extract(F.to_json(F.struct(name.alias("n"))), r'^\{"n":(.*)\}$', 1)
    item = F.to_json(F.struct("url")) if shape == "url" else bare
    # equal entries are told apart by their count, so that each has its line
    rows = files.groupBy("url").count().select(
        "url", F.explode(F.sequence(F.lit(1), F.col("count"))).alias("i"))
    rows = rows.select(F.concat_ws("#", "url", "i").alias("key"), F.struct("url", "i").alias("at"),
                       item.alias("item"))
    return _document(rows, "key", "item", F.col("at"), "entries")


def write_manifest(files: DataFrame, path: str, failed: DataFrame | None = None,
                   shape: str = "url", version: str = "other") -> bool:
    """K3: write the manifest file only when no table failed (and never for
    the primary version, which loads without one).  Returns whether written.
    The document is built and written by Spark; nothing passes through the
    driver."""
    if version == "test_mysql":
        return False
    if failed is not None and not failed.isEmpty():
        return False
    fs.write_single_file(manifest_json(files, shape), path)
    return True


def schema_doc_json(rows: DataFrame) -> DataFrame:
    """K4 content: the lines of schema document A -- ``{"tables": [{name,
    keys[], metrics, db_name}, ...]}`` from U1's rows, in U1's order (name
    descending)."""
    t = F.struct(F.col("table_name").alias("name"), F.split(F.col("stats_keys"), ",").alias("keys"),
                 F.col("measures").alias("metrics"), F.col("database_name").alias("db_name"))
    items = rows.select(F.to_json(t).alias("item"),
                        F.struct("table_name", "stats_keys", "measures").alias("at"))
    return _document(items.distinct(), "item", "item", F.col("at"), "tables")


def write_schema_doc(rows: DataFrame, path: str) -> str:
    """K4: write schema document A (one registry-sized JSON text file)."""
    return fs.write_single_file(schema_doc_json(rows), path)


def write_max_hour(spark: SparkSession, path: str, hour: int) -> str:
    """K5: the ``data_max_utc_hour`` one-value file."""
    return fs.write_text_file(spark, path, str(int(hour)))
