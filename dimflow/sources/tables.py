"""Table scans: full, through a view, delta since a watermark.

A *source* is anything Spark can read as a DataFrame: a catalog table or view,
a parquet/ORC path, or a JDBC table (see ``dimflow.sources.jdbc``).  Scans only
declare a projection and a predicate; Catalyst prunes columns and pushes the
watermark predicate into the parquet reader or the JDBC ``WHERE`` clause.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dimflow.functions.timeutil import ntz


def _read(spark: SparkSession, src: str | DataFrame) -> DataFrame:
    if isinstance(src, DataFrame):
        return src
    if "/" in src or src.endswith(".parquet"):
        return spark.read.parquet(src)
    return spark.table(src)


def _cols(columns: str | Sequence[str] | None) -> list[str] | None:
    if columns is None:
        return None
    if isinstance(columns, str):
        return [c.strip() for c in columns.split(",") if c.strip()]
    return list(columns)


def scan_full(spark: SparkSession, src: str | DataFrame,
              columns: str | Sequence[str] | None = None,
              view: str | DataFrame | None = None) -> DataFrame:
    """The chosen columns of a table, or of ``view`` when one is given.

    The view substitutes for the table (same column names); the caller keeps
    naming the output after the table.  An empty-string view means none.
    """
    source = view if (view is not None and not (isinstance(view, str) and view == "")) else src
    df = _read(spark, source)
    cols = _cols(columns)
    return df.select(*[F.col(f"`{c}`") for c in cols]) if cols else df


def _as_watermark(watermark) -> Column:
    if isinstance(watermark, Column):
        return watermark
    if isinstance(watermark, datetime):
        return ntz(watermark.strftime("%Y-%m-%d %H:%M:%S.%f"))
    return ntz(str(watermark))


def scan_delta(df: DataFrame, watermark, ts_col: str = "updated_at") -> DataFrame:
    """S3/F1: rows changed strictly after the watermark (``ts_col > wm``).

    ``watermark`` may be a Python datetime / text (pushed into the scan as a
    literal) or a Column.  ``None`` means no successful dump yet: every row.
    """
    if watermark is None:
        return df
    return df.where(F.col(ts_col) > _as_watermark(watermark))


def scan_delta_by_table(df: DataFrame, watermarks: DataFrame, table_col: str,
                        ts_col: str = "updated_at") -> DataFrame:
    """S3 for many tables in one pass: ``df`` holds rows of several source
    tables (``table_col``); each keeps rows newer than its own watermark from
    ``watermarks(table_name, watermark)``; a table without one keeps all.

    ``watermarks`` has one row per table.  No broadcast hint: AQE broadcasts it
    from its measured runtime size, else plans a shuffle join.
    """
    wm = watermarks.select(F.col("table_name").alias("_wm_table"),
                           F.col("watermark").alias("_wm"))
    joined = df.join(wm, F.col(table_col) == F.col("_wm_table"), "left")
    return (joined.where(F.col("_wm").isNull() | (F.col(ts_col) > F.col("_wm")))
            .drop("_wm_table", "_wm"))


def row_count(df: DataFrame, alias: str = "row_count") -> DataFrame:
    """``count(*)`` as a one-row DataFrame (partial counts per task)."""
    return df.agg(F.count(F.lit(1)).alias(alias))
