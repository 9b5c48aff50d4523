"""Tables partitioned by batch, bucketed by key, or written in even parts.

All of it is Spark's own writer: dynamic partition overwrite for replays,
``bucketBy`` for keys that are joined again and again, the ``rebalance`` hint
for files of one size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimflow.operators.load import insert_new
from dimflow.sinks import fs


def load_partitions(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Replace, in the table at ``path``, the partitions that ``df``
    has rows for; all others stay as they are.

    Tasks write beside the table and the partitions are switched when the whole
    job has succeeded: a replay that fails leaves the old ones, a replay that
    runs twice gives the same rows.  Rows are dealt by partition value; AQE
    splits a partition that is much larger than others.  A partition without
    rows in ``df`` is not touched (``clear_partition`` empties one).
    """
    (df.hint("rebalance", *[F.col(c) for c in by]).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path))


def clear_partition(spark: SparkSession, path: str, value: dict, schema: T.StructType) -> None:
    """Empty one partition, ``value`` naming its columns: it is overwritten by
    no rows, readers see either all of it or nothing."""
    rest = [f for f in schema.fields if f.name not in value]
    folder = fs.partition_folder(spark, value)
    spark.createDataFrame([], T.StructType(rest)).write.mode("overwrite").parquet(f"{path}/{folder}")


def read_partitions(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table at ``path`` with its declared types (folder values are not
    guessed at); filters on partition columns prune folders."""
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def save_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int,
                  mode: str = "overwrite") -> None:
    """A catalog table over ``path``, hashed into ``buckets`` by ``key`` and
    sorted by it in each file.  Rows are dealt to their buckets first, so that a
    bucket is one file a write."""
    (df.repartition(buckets, key).write.mode(mode).bucketBy(buckets, key).sortBy(key)
     .option("path", path).saveAsTable(name))


def insert_new_bucketed(stg: DataFrame, name: str, key: str) -> DataFrame:
    """J1 against a bucketed production table: only staging is shuffled, into
    production's buckets; production is read in place."""
    prod = stg.sparkSession.table(name).select(key).hint("merge")
    return insert_new(stg, prod, key)


def append_new_bucketed(stg: DataFrame, name: str, path: str, key: str, buckets: int) -> None:
    """Insert-if-absent of ``stg`` into the bucketed table."""
    new = insert_new_bucketed(stg, name, key).select(*stg.sparkSession.table(name).columns)
    save_bucketed(new, name, path, key, buckets, mode="append")


def write_even(df: DataFrame, path: str, near: Sequence[str], max_rows: int) -> None:
    """K1: a dump in parts of near equal size, rows of equal ``near`` columns
    together as far as that allows: AQE joins small groups and splits hot ones,
    and no file holds more than ``max_rows``."""
    (df.hint("rebalance", *[F.col(c) for c in near]).write.mode("overwrite")
     .option("maxRecordsPerFile", max_rows).parquet(path))
