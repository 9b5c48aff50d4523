"""Column lists and schema lines.

All work on *column metadata as DataFrames* -- one row per (table, column) --
so a registry of thousands of dimensions is handled in one distributed pass;
only per-table groups (a table's own columns) are ever gathered together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimflow.functions.typemap import normalise_type

SIDECAR_END = " - \"ends '\\001'\""


def column_list(entries: Column, is_sql: Column, sql_entries: Column | None = None):
    """P2/P3 on one table's entries: ``(columns text, n_dropped)``.

    ``entries`` is an array of ``struct(p, t, n)`` -- position, field type,
    output name.  Non-SQL: all KEYs, then all METRICs, each in position order
    (``keys + ',' + metrics`` when there are metrics, as the source joined
    them); other types are dropped and counted.  SQL (``is_sql``): the
    entries of ``sql_entries`` (default all) in order, nothing dropped.
    Array functions only: no join, no second aggregate.
    """
    e = F.array_sort(entries)
    sql_e = e if sql_entries is None else F.array_sort(sql_entries)

    def names(arr):
        return F.array_join(F.transform(arr, lambda x: x["n"]), ",")

    keys = names(F.filter(e, lambda x: x["t"] == "KEY"))
    metrics = names(F.filter(e, lambda x: x["t"] == "METRIC"))
    non_sql = F.when(metrics != "", F.concat_ws(",", keys, metrics)).otherwise(keys)
    sql = F.coalesce(is_sql, F.lit(False))
    dropped = F.size(F.filter(e, lambda x: ~x["t"].isin("KEY", "METRIC")))
    return (F.when(sql, names(sql_e)).otherwise(non_sql),
            F.when(sql, F.lit(0)).otherwise(dropped).cast("bigint"))


def spec_columns(spec_cols: DataFrame, sql_tables: DataFrame | None = None) -> DataFrame:
    """The load column list of each table spec.

    ``spec_cols(table_name, pos, field_type, output_name)`` are the entries of
    a table's ``columns`` array.  A non-SQL spec lists all KEY columns, then
    all METRIC columns, each in entry order; other field types are dropped
    (and counted in ``n_dropped``).  A SQL spec -- table present in
    ``sql_tables(table_name)`` -- keeps every entry in order.  The text join
    follows the source: ``keys + ',' + metrics`` when there are metrics.
    """
    df = spec_cols
    if sql_tables is not None:
        flag = sql_tables.select(F.col("table_name").alias("_st")).distinct() \
            .withColumn("_is_sql", F.lit(True))
        df = df.join(flag, F.col("table_name") == F.col("_st"), "left").drop("_st")
    else:
        df = df.withColumn("_is_sql", F.lit(None).cast("boolean"))
    # one list of entries per table (a table's own columns), then array views of it
    entry = F.struct(F.col("pos").alias("p"), F.col("field_type").alias("t"), F.col("output_name").alias("n"))
    g = df.groupBy("table_name").agg(F.max("_is_sql").alias("_is_sql"),
                                     F.collect_list(entry).alias("_e"))
    columns, dropped = column_list(F.col("_e"), F.col("_is_sql"))
    return g.select("table_name", F.coalesce(F.col("_is_sql"), F.lit(False)).alias("is_sql"),
                    columns.alias("columns"), dropped.alias("n_dropped"))


def column_dictionary(dictionary: DataFrame, wanted: DataFrame) -> DataFrame:
    """Dictionary rows ``(table_name, column_name, data_type)`` of the
    wanted columns, ``ordinal`` = their position in the requested list
    (``field()``/``decode()`` ordering as a join on the list)."""
    w = wanted.select(F.col("table_name").alias("_wt"), F.col("column_name").alias("_wc"),
                      F.col("pos").alias("ordinal"))
    d = dictionary.select("table_name", "column_name", "data_type")
    j = d.join(w, (F.col("table_name") == F.col("_wt")) & (F.col("column_name") == F.col("_wc")))
    return j.select("table_name", "column_name", "data_type", "ordinal")


def order_by_list(df: DataFrame, col: str, names: Sequence[str], rank_col: str = "list_rank") -> DataFrame:
    """Rank rows by the position of ``col`` in an explicit list (1-based,
    0 when absent) and sort by it.  Ties are broken by the value and then
    every other column: a rank shared by a third of the rows would otherwise
    fall into a single range partition of the sort."""
    rank = F.array_position(F.array(*[F.lit(n) for n in names]), F.col(col))
    others = [c for c in df.columns if c != col]
    return df.withColumn(rank_col, rank).orderBy(rank_col, col, *others)


def schema_lines(dictionary: DataFrame, views: DataFrame | None = None) -> DataFrame:
    """P8 (+K2 content): ``.schema`` sidecar lines per table.

    ``dictionary(table_name, column_name, data_type, ordinal)`` as read from
    the source (table_name may be a view).  ``views(table_name, view_name)``
    maps a view back to its table; as in the source, every occurrence of the
    view name in a line is replaced by the table name.  Line 0 is the header
    ``<table> - - - - - - format - -``; column lines carry the normalised type.
    """
    d = dictionary
    if views is not None:
        v = views.where(F.col("view_name") != "").select(
            F.col("view_name").alias("_v"), F.col("table_name").alias("_t"))
        d = d.join(v, F.col("table_name") == F.col("_v"), "left")
    else:
        d = d.withColumn("_t", F.lit(None).cast("string"))
    target = F.coalesce(F.col("_t"), F.col("table_name"))
    raw = F.concat(F.col("table_name"), F.lit(" "), F.col("column_name"), F.lit(" - - - - - "),
                   normalise_type(F.col("data_type")), F.lit(SIDECAR_END))
    lines = d.select(target.alias("table_name"), F.col("ordinal").cast("bigint").alias("ordinal"),
                     F.replace(raw, F.col("table_name"), target).alias("line"))
    headers = lines.select("table_name").distinct().select(
        "table_name", F.lit(0).cast("bigint").alias("ordinal"),
        F.concat(F.col("table_name"), F.lit(" - - - - - - format - -")).alias("line"))
    return headers.unionByName(lines)
