"""Operational databases over JDBC (S1/S2/S3 on JDBC, S5, S8, S9).

The source piped a client's whole result into memory; here the read is a
Spark JDBC scan: ``fetchsize`` batches rows (100,000 as the source did),
``partitionColumn``/``numPartitions`` or explicit ``predicates`` split one
table across tasks, and the delta predicate and column list are pushed into
the database's own ``SELECT``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FETCH_SIZE = 100_000


def scan_jdbc(spark: SparkSession, url: str, table: str, columns: Sequence[str] | None = None,
              properties: dict | None = None, fetchsize: int = FETCH_SIZE,
              partition_column: str | None = None, lower_bound=None, upper_bound=None,
              num_partitions: int | None = None, predicates: Sequence[str] | None = None) -> DataFrame:
    """S5 (and S1/S2 against a database): a table or view over JDBC.

    With ``partition_column`` and bounds, Spark issues ``num_partitions``
    range queries in parallel; ``predicates`` gives one task per predicate.
    """
    props = dict(properties or {})
    props["fetchsize"] = str(fetchsize)
    if predicates:
        df = spark.read.jdbc(url, table, predicates=list(predicates), properties=props)
    else:
        reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
        for k, v in props.items():
            reader = reader.option(k, v)
        if partition_column is not None:
            reader = (reader.option("partitionColumn", partition_column)
                      .option("lowerBound", str(lower_bound)).option("upperBound", str(upper_bound))
                      .option("numPartitions", str(num_partitions or 8)))
        df = reader.load()
    return df.select(*columns) if columns else df


# The dictionary query of each source database.  ``{table}`` and
# ``{columns}`` (a quoted, comma-separated list) are filled in.
DICTIONARY_SQL = {
    "mysql": ("select table_name, column_name, data_type from information_schema.columns "
              "where table_name = '{table}' and column_name in ({columns})"),
    "oracle": ("select table_name, column_name, data_type from all_tab_columns "
               "where table_name = '{table}' and column_name in ({columns})"),
}


def column_dictionary_jdbc(spark: SparkSession, url: str, table: str, columns: Sequence[str],
                           flavor: str = "mysql", properties: dict | None = None) -> DataFrame:
    """``(table_name, column_name, data_type, ordinal)`` of the listed
    columns from the database dictionary, ``ordinal`` = list position (the
    source's ``field()`` / ``decode()`` ordering)."""
    quoted = ",".join("'" + c.strip() + "'" for c in columns)
    sql = DICTIONARY_SQL[flavor].format(table=table, columns=quoted)
    reader = spark.read.format("jdbc").option("url", url).option("query", sql)
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    d = reader.load().toDF("table_name", "column_name", "data_type")
    order = F.array(*[F.lit(c.strip()) for c in columns])
    return d.select("table_name", "column_name", "data_type",
                    F.array_position(order, F.col("column_name")).alias("ordinal"))


def dictionary_from_schema(spark: SparkSession, df: DataFrame, table: str,
                           columns: Sequence[str] | None = None) -> DataFrame:
    """S8 without a dictionary query: the columns of ``df``'s schema (what
    the JDBC driver reported) as dictionary rows, in list order."""
    names = list(columns) if columns else df.columns
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    rows = [(table, n, types[n], i + 1) for i, n in enumerate(names) if n in types]
    return spark.createDataFrame(rows, "table_name string, column_name string, data_type string, ordinal int")


def jdbc_reader(spark: SparkSession, url_of_db, properties: dict | None = None,
                fetchsize: int = FETCH_SIZE, partitioning: dict | None = None):
    """A ``read_source`` for the extract job: ``(source_name, database) ->
    DataFrame`` over JDBC.  ``url_of_db`` maps the registry's database name
    (``mysql_db``) to a JDBC URL (a dict or a callable); ``partitioning``
    optionally gives per-source ``(column, lower, upper, n)`` so large tables
    are read by several tasks."""
    def read(source_name: str, database: str | None = None) -> DataFrame:
        url = url_of_db(database) if callable(url_of_db) else url_of_db[database]
        part = (partitioning or {}).get(source_name)
        if part:
            col, lo, hi, n = part
            return scan_jdbc(spark, url, source_name, properties=properties, fetchsize=fetchsize,
                             partition_column=col, lower_bound=lo, upper_bound=hi, num_partitions=n)
        return scan_jdbc(spark, url, source_name, properties=properties, fetchsize=fetchsize)
    return read
