"""Dimension registry: work lists, extract modes and the schema document.

The registry (``dimensions_load_table``) has one row per dimension table:
``table_name, database_name, mysql_db, is_delta, reload_table,
always_reload, view_name ('' = none), is_loading_enabled, status,
mysql_keys, stats_keys, measures, latest_loaded_date``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PRIMARY_VERSION = "test_mysql"
WORK_COLUMNS = ["table_name", "mysql_db", "is_delta", "reload_table", "view_name", "always_reload"]


def enabled_tables(registry: DataFrame, version: str = PRIMARY_VERSION) -> DataFrame:
    """The dump work list.  Primary version: ``is_loading_enabled = 1``;
    any other version: ``status = 'LIVE'``; both only ``database_name =
    'dimensions'``."""
    on = (F.col("is_loading_enabled") == 1) if version == PRIMARY_VERSION \
        else (F.col("status") == "LIVE")
    return registry.where((F.col("database_name") == "dimensions") & on).select(*WORK_COLUMNS)


def table_options(registry: DataFrame, table: str) -> DataFrame:
    """The options of one table."""
    return registry.where(F.col("table_name") == table).select(*WORK_COLUMNS[1:])


def tables_from_config(sections: DataFrame, database: str, single_table: str | None = None,
                       retry: bool = False) -> DataFrame:
    """Tables named by a schema ini file as the work list, fixed options.

    ``sections(table_name)``.  All: delta 0, reload 1, always 1, no view; a
    single command-line table is dumped as delta 1 (the retry pass uses 0).
    """
    df = sections.select("table_name")
    delta = 0
    if single_table is not None:
        df = df.where(F.col("table_name") == single_table)
        delta = 0 if retry else 1
    return df.select(
        "table_name", F.lit(database).alias("mysql_db"), F.lit(delta).alias("is_delta"),
        F.lit(1).alias("reload_table"), F.lit("").alias("view_name"),
        F.lit(1).alias("always_reload"))


def tables_from_ini(spark, path: str) -> DataFrame:
    """S15 input: the sections of an ini schema file as ``(table_name,
    columns)`` -- the ``columns_mysql`` option when present, else
    ``columns``.  A config file is driver-side metadata; it is read through
    the cluster's filesystem and parsed with the standard library."""
    import configparser

    from dimflow.sinks.fs import read_text_file
    cp = configparser.ConfigParser()
    cp.read_string(read_text_file(spark, path))
    rows = []
    for sec in cp.sections():
        opt = "columns_mysql" if cp.has_option(sec, "columns_mysql") else "columns"
        rows.append((sec, cp.get(sec, opt) if cp.has_option(sec, opt) else None))
    return spark.createDataFrame(rows, "table_name string, columns string")


def retry_tables(work: DataFrame, errors: DataFrame) -> DataFrame:
    """only the tables of the error list, with their registry options."""
    return work.join(errors.select("table_name").distinct(), "table_name", "left_semi")


def only_table(work: DataFrame, table: str) -> DataFrame:
    """a single table from the command line."""
    return work.where(F.col("table_name") == table)


def extract_mode(work: DataFrame, watermarks: DataFrame | None, force_full: bool = False,
                 version: str = PRIMARY_VERSION) -> DataFrame:
    """Per table, dump the whole table or only the rows after its watermark.

    ``is_delta = 0`` -> full.  Otherwise the watermark (last successful dump,
    L16) is looked up -- only the primary version keeps one -- and no
    watermark -> full; a forced full run, ``reload_table = 1`` or
    ``always_reload = 1`` -> full; else delta.  Also gives the object to read
    (the view if one is named), whether a 'downloaded' marker must be written
    before the scan (delta tables of the primary version), and the reload
    flag handed to the loader.
    """
    primary = version == PRIMARY_VERSION
    df = work
    if watermarks is not None and primary:
        wm = watermarks.select(F.col("table_name").alias("_wt"), F.col("watermark").alias("_wm"))
        df = df.join(wm, F.col("table_name") == F.col("_wt"), "left").drop("_wt")
    else:
        df = df.withColumn("_wm", F.lit(None).cast("timestamp_ntz"))
    delta = F.col("is_delta") != 0
    wmk = F.when(delta, F.col("_wm"))
    mode = (F.when(~delta, "full")
            .when(wmk.isNull(), "full")
            .when(F.lit(force_full) | (F.col("reload_table") == 1) | (F.col("always_reload") == 1), "full")
            .otherwise("delta"))
    return df.select(
        *WORK_COLUMNS, wmk.alias("watermark"), mode.alias("mode"),
        F.when(F.col("view_name") != "", F.col("view_name")).otherwise(F.col("table_name"))
        .alias("source_name"),
        (delta & F.lit(primary)).alias("needs_marker"),
        F.when(F.col("always_reload") == 1, F.lit(1)).otherwise(F.col("reload_table"))
        .alias("reload_flag"))


def extract_columns(registry: DataFrame) -> DataFrame:
    """The dump column list per table, ``mysql_keys`` else ``stats_keys``,
    one row per column ``(table_name, pos, column_name)``."""
    text = F.coalesce(F.col("mysql_keys"), F.col("stats_keys"))
    return registry.select("table_name", F.posexplode(F.split(text, ",")).alias("pos", "column_name"))


def explode_list(df: DataFrame, col: str, item: str = "item",
                 keep: list[str] | None = None) -> DataFrame:
    """One row per comma-separated item (``n`` from 1), however long the
    list -- no number table and no cross join, just ``explode``."""
    parts = F.split(F.col(col), ",")
    return df.select(*(keep if keep is not None else [col]),
                     F.posexplode(parts).alias("n", item)) \
        .withColumn("n", F.col("n") + 1)


def distinct_items(registry: DataFrame, cols: str | list[str],
                   enabled_only: bool = True) -> DataFrame:
    """A1 as rows: the distinct ``(list_name, item)`` of every enabled table's
    lists; deduplicated map-side, no row holds more than one item."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    src = registry.where(F.col("is_loading_enabled") == 1) if enabled_only else registry
    legs = None
    for c in cols:
        leg = explode_list(src.select(c).distinct(), c, "item", keep=[]) \
            .select(F.lit(c).alias("list_name"), "item")
        legs = leg if legs is None else legs.unionByName(leg)
    return legs.distinct()


def distinct_items_df(registry: DataFrame, cols: str | list[str],
                      enabled_only: bool = True) -> DataFrame:
    """A1: ``GROUP_CONCAT(DISTINCT item)`` over every enabled table's list, one
    output column per input column, in a single one-row aggregate.

    Items are joined in sorted order (the source gave no order); NULL when a
    column has no items.  The distinct step runs distributed and map-side, so
    only the distinct vocabulary (column names used by all dimensions)
    reaches the final one-row aggregate.
    """
    cols = [cols] if isinstance(cols, str) else list(cols)
    items = distinct_items(registry, cols, enabled_only)
    aggs = [F.sort_array(F.collect_list(F.when(F.col("list_name") == c, F.col("item")))).alias(c)
            for c in cols]
    return items.agg(*aggs).select(*[F.when(F.size(c) > 0, F.array_join(c, ",")).alias(c)
                                     for c in cols])


def all_keys_row(registry: DataFrame) -> DataFrame:
    """A2: the ``all_keys_and_measures`` row: all distinct keys, all distinct
    measures; the un-grouped ``database_name`` of the source resolves to ''
    (its smallest candidate), stated here as the rule."""
    both = distinct_items_df(registry, ["stats_keys", "measures"])
    return both.select(
        F.lit("all_keys_and_measures").alias("table_name"),
        F.coalesce(F.col("stats_keys"), F.lit("")).alias("stats_keys"),
        F.coalesce(F.col("measures"), F.lit("")).alias("measures"),
        F.lit("").alias("database_name"))


def distinct_registry(registry: DataFrame, cols=("table_name", "stats_keys", "measures",
                                                   "database_name")) -> DataFrame:
    """A4: ``SELECT DISTINCT`` of enabled registry rows."""
    return registry.where(F.col("is_loading_enabled") == 1).select(*cols).distinct()


def schema_doc_rows(registry: DataFrame) -> DataFrame:
    """U1 (+T2): rows of schema document A -- the summary row, then one row
    per enabled table; NULL measures become ''; sorted by name descending."""
    tables = distinct_registry(registry)
    rows = all_keys_row(registry).unionByName(tables).distinct()
    return rows.select("table_name", "stats_keys",
                       F.coalesce(F.col("measures"), F.lit("")).alias("measures"),
                       "database_name").orderBy(F.col("table_name").desc())
