"""Table specs as lines of JSON, read as VARIANT.

A schema document of many tables is a folder of text files, each line one table:

    {"version": "1", "group": 0, "index": 12, "table": {"name": ..., ...}}

``group`` and ``index`` give its place in the document.  Lines are written and
read in as many parts as there is work; nothing is gathered into one row.  The
typed fields are taken from the VARIANT one by one, so a field of a wrong type is
NULL and leaves the others as they are, and options that no typed field names are
kept (``other_options``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimflow.sources.specs import TABLE_A, TABLE_B, last_entries, spec_columns_of, table_specs_of


def write_spec_lines(specs: DataFrame, path: str, version: str = "1") -> str:
    """Write (group, index, spec) rows, ``spec`` the JSON text of a table, to the
    folder ``path``.  Texts that are not JSON are written as they are and come
    back as bad lines.  An empty frame gives an empty document."""
    head = F.to_json(F.struct(F.lit(version).alias("version"), "group", "index"))
    line = F.concat(F.rtrim(head, F.lit("}")), F.lit(',"table":'), "spec", F.lit("}"))
    specs.select(F.translate(line, "\r\n", "  ").alias("value")).write.mode("overwrite").text(path)
    return path


def write_registry_lines(rows: DataFrame, path: str) -> str:
    """K4 over lines: schema document A from U1's rows (distinct, so that their
    order decides nothing; ``index`` is 0)."""
    t = F.struct(F.col("table_name").alias("name"), F.split("stats_keys", ",").alias("keys"),
                 F.col("measures").alias("metrics"), F.col("database_name").alias("db_name"))
    return write_spec_lines(rows.select(F.lit(0).alias("group"), F.lit(0).alias("index"),
                                        F.to_json(t).alias("spec")).distinct(), path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line, doc): every line and its VARIANT, NULL if it is not JSON."""
    return spark.read.text(path).select(F.col("value").alias("line"),
                                        F.try_parse_json("value").alias("doc"))


def _get(path: str, kind: str) -> F.Column:
    return F.try_variant_get("doc", path, kind)


def _name() -> F.Column:
    return _get("$.table.name", "string")


def _tables(lines: DataFrame, fields: T.StructType) -> DataFrame:
    """(version, _gi, _ti, t): the good lines, ``t`` with the typed fields."""
    typed = F.struct(*[_get(f"$.table.{f.name}", f.dataType.simpleString()).alias(f.name)
                       for f in fields])
    return lines.where(_name().isNotNull()).select(
        _get("$.version", "string").alias("version"), _get("$.group", "bigint").alias("_gi"),
        _get("$.index", "bigint").alias("_ti"), typed.alias("t"))


def bad_lines(lines: DataFrame) -> DataFrame:
    """(line, has_json): lines that are not JSON or name no table; empty lines
    are none."""
    return lines.where(_name().isNull() & (F.trim("line") != "")).select(
        "line", F.col("doc").isNotNull().alias("has_json"))


def table_specs(lines: DataFrame) -> DataFrame:
    """S13 over lines: the rows of ``specs.read_table_specs``."""
    return table_specs_of(_tables(lines, TABLE_B))


def spec_columns(lines: DataFrame) -> DataFrame:
    """S13 over lines: the rows of ``specs.read_spec_columns``."""
    return spec_columns_of(_tables(lines, TABLE_B))


def registry_specs(lines: DataFrame) -> DataFrame:
    """S12 over lines: the rows of ``specs.read_table_specs_a``."""
    return last_entries(_tables(lines, TABLE_A).select(
        F.struct("_gi", "_ti").alias("_i"), F.col("t").alias("_t")))


def other_options(lines: DataFrame) -> DataFrame:
    """(name, group, index, option, value): the options of each table that have
    no typed field, their values as VARIANT; JSON nulls are left out."""
    known = [f.name for f in TABLE_B]
    tables = lines.where(_name().isNotNull()).select(
        _name().alias("name"), _get("$.group", "bigint").alias("group"),
        _get("$.index", "bigint").alias("index"), _get("$.table", "variant").alias("t"))
    each = lines.sparkSession.tvf.variant_explode(F.col("t").outer())
    return (tables.lateralJoin(each).where(~F.col("key").isin(known) & ~F.is_variant_null("value"))
            .select("name", "group", "index", F.col("key").alias("option"), "value"))
