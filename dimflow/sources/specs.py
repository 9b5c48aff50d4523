"""Table-spec documents (schema.json) read as DataFrames.

Version B documents (``groups[].tables[].columns[]``) become two frames:
``specs`` -- one row per table with every option of the table spec (§1.4 of
the survey) -- and ``spec_cols`` -- one row per column entry.  A table named
in several groups accumulates columns across them while the last occurrence's
options win, as the source's loop (which never breaks) did.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimflow.operators.projection import column_list
from dimflow.sinks import fs

_S = T.StringType()

COLUMN = T.StructType([T.StructField("field_type", _S), T.StructField("output_name", _S)])
TABLE_B = T.StructType([
    T.StructField("name", _S), T.StructField("delimiter", _S), T.StructField("file_format", _S),
    T.StructField("compression", _S), T.StructField("sql", _S),
    T.StructField("columns", T.ArrayType(COLUMN)), T.StructField("db_name", _S),
    T.StructField("db_name_stg", _S), T.StructField("staging_table", _S), T.StructField("load_table", _S),
    T.StructField("dimension", T.StructType([
        T.StructField("operation", _S), T.StructField("operation_column", _S),
        T.StructField("identity_column", _S), T.StructField("truncate_before_load", _S),
        T.StructField("order_column", _S)])),
    T.StructField("custom_insert_sql", T.StructType([
        T.StructField("replace_keys", T.StructType([
            T.StructField("unwanted_key", _S), T.StructField("wanted_key", _S)])),
        T.StructField("join_table", _S), T.StructField("join_key", _S)])),
    # typed load options (replacing free-form COPY text)
    T.StructField("reject_max", T.LongType()), T.StructField("write_rejects", T.BooleanType()),
])
DOC_B = T.StructType([T.StructField("version", _S),
                      T.StructField("groups", T.ArrayType(T.StructType([
                          T.StructField("tables", T.ArrayType(TABLE_B))])))])
TABLE_A = T.StructType([T.StructField("name", _S), T.StructField("keys", T.ArrayType(_S)),
                        T.StructField("metrics", _S), T.StructField("db_name", _S)])
DOC_A = T.StructType([T.StructField("tables", T.ArrayType(TABLE_A))])


def read_table_specs_a(spark: SparkSession, path: str) -> DataFrame:
    """Schema document A as ``(name, keys, metrics, db_name)`` rows; for
    a repeated name the last entry wins."""
    doc = spark.read.schema(DOC_A).option("multiLine", "true").json(path)
    return last_entries(doc.select(F.posexplode("tables").alias("_i", "_t")))


def last_entries(t: DataFrame) -> DataFrame:
    """S12's rows of entries ``_t`` at places ``_i``: the last of each name."""
    best = t.groupBy(F.col("_t.name").alias("name")).agg(F.max_by("_t", "_i").alias("_t"))
    return best.select("name", "_t.keys", "_t.metrics", "_t.db_name")


def _occurrences(spark: SparkSession, path: str) -> DataFrame:
    doc = spark.read.schema(DOC_B).option("multiLine", "true").json(path)
    g = doc.select("version", F.posexplode("groups").alias("_gi", "_g"))
    return g.select("version", "_gi", F.posexplode("_g.tables").alias("_ti", "t"))


def read_spec_columns(spark: SparkSession, path: str) -> DataFrame:
    """S13 (columns): ``(table_name, pos, field_type, output_name, is_sql_entry)``
    with ``pos`` (a struct of group, table and column index) ordering entries
    across groups, then within the table."""
    return spec_columns_of(_occurrences(spark, path))


def spec_columns_of(occ: DataFrame) -> DataFrame:
    """S13's column rows of occurrences (version, _gi, _ti, t)."""
    c = occ.select(F.col("t.name").alias("table_name"), "_gi", "_ti", F.col("t.sql").isNotNull().alias("_sql"),
                   F.posexplode("t.columns").alias("_ci", "c"))
    pos = F.struct("_gi", "_ti", "_ci")
    return c.select("table_name", pos.alias("pos"), F.col("c.field_type").alias("field_type"),
                    F.col("c.output_name").alias("output_name"), F.col("_sql").alias("is_sql_entry"))


def read_table_specs(spark: SparkSession, path: str,
                     with_columns: bool = True) -> tuple[DataFrame, DataFrame | None]:
    """``(specs, spec_cols)`` from a version B document (``spec_cols``
    is None when ``with_columns`` is off).

    ``specs`` columns: name, version, delimiter ('|' default), file_format,
    compression ('' -> NULL), is_sql, columns (P2/P3 list text),
    column_string_with_identity, db_name, db_name_stg, staging_table,
    load_table, is_dimension, operation (Insert|Merge|NULL),
    operation_column ('' -> NULL), identity_column, order_column (of a Merge,
    'updated_at' by default), truncate_before_load,
    unwanted_key, wanted_key, join_table, join_key, insert_columns (the
    table-qualified list with the unwanted key swapped), reject_max,
    write_rejects.
    """
    occ = _occurrences(spark, path)
    cols = read_spec_columns(spark, path).drop("is_sql_entry") if with_columns else None
    return table_specs_of(occ), cols


def table_specs_of(occ: DataFrame) -> DataFrame:
    """S13's spec rows of occurrences (version, _gi, _ti, t)."""
    order = F.struct("_gi", "_ti")
    is_sql_occ = F.col("t.sql").isNotNull()
    entries = F.transform("t.columns", lambda c, i: F.struct(
        F.struct(F.col("_gi").alias("g"), F.col("_ti").alias("t"), i.alias("c")).alias("p"), c["field_type"].alias("t"), c["output_name"].alias("n"), is_sql_occ.alias("s")))
    # One aggregate per table: the last occurrence's options, whether any
    # occurrence is SQL, and every occurrence's column entries in order.
    last = occ.groupBy(F.col("t.name").alias("name")).agg(
        F.max_by(F.struct("version", "t"), order).alias("_l"),
        F.max(is_sql_occ).alias("is_sql"),
        F.flatten(F.collect_list(entries)).alias("_e"))
    # A SQL spec keeps the entries of its SQL occurrences; a non-SQL spec
    # groups KEYs then METRICs over all occurrences.
    cols_text, _ = column_list(F.col("_e"), F.col("is_sql"), F.filter("_e", lambda x: x["s"]))
    last = last.withColumn("columns", cols_text)
    t = F.col("_l.t")
    dim = t["dimension"]
    op = F.when(dim["operation"].isin("Insert", "Merge"), dim["operation"])
    op_col = F.when(dim["operation_column"] != "", dim["operation_column"])
    ins = F.struct(F.col("name").alias("n"), F.col("columns").alias("c"))
    return last.select(
        "name", F.col("_l.version").alias("version"),
        F.coalesce(t["delimiter"], F.lit("|")).alias("delimiter"),
        t["file_format"].alias("file_format"),
        F.when(t["compression"] != "", t["compression"]).alias("compression"),
        "is_sql",
        F.when(F.col("columns") != "", F.col("columns")).alias("columns"),
        F.when(dim["identity_column"].isNotNull(),
               F.concat_ws(",", F.col("columns"), dim["identity_column"])).alias("column_string_with_identity"),
        t["db_name"].alias("db_name"), t["db_name_stg"].alias("db_name_stg"),
        t["staging_table"].alias("staging_table"), t["load_table"].alias("load_table"),
        dim.isNotNull().alias("is_dimension"), op.alias("operation"), op_col.alias("operation_column"),
        dim["identity_column"].alias("identity_column"),
        F.coalesce(dim["order_column"], F.lit("updated_at")).alias("order_column"),
        F.coalesce(dim["truncate_before_load"] == "true", F.lit(False)).alias("truncate_before_load"),
        t["custom_insert_sql"]["replace_keys"]["unwanted_key"].alias("unwanted_key"),
        t["custom_insert_sql"]["replace_keys"]["wanted_key"].alias("wanted_key"),
        t["custom_insert_sql"]["join_table"].alias("join_table"),
        t["custom_insert_sql"]["join_key"].alias("join_key"),
        F.when(t["custom_insert_sql"]["join_table"].isNotNull(),
               F.transform(F.split(ins["c"], ","),
                           lambda c: F.when(F.concat(ins["n"], F.lit("."), c) ==
                                            t["custom_insert_sql"]["replace_keys"]["unwanted_key"],
                                            t["custom_insert_sql"]["replace_keys"]["wanted_key"])
                           .otherwise(F.concat(ins["n"], F.lit("."), c)))).alias("insert_columns"),
        t["reject_max"].alias("reject_max"),
        F.coalesce(t["write_rejects"], F.lit(False)).alias("write_rejects"))


def resolve_spec(spark: SparkSession, batch_path: str, local_path: str,
                 prefer_local: bool = False) -> str:
    """Which spec document a load uses: the local copy when asked, else
    the copy shipped in the batch folder, else (missing there) the local
    copy."""
    if prefer_local:
        return local_path
    return batch_path if fs.exists(spark, batch_path) else local_path
