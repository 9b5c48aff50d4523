"""The load log as a kept roll-up.

Every load-log question starts from the hourly grain (``runlog.hourly_grain``):
one row per table, process, status and hour with the latest minute stamp.  That
aggregate is kept, partitioned by day, and new events are merged into the days
they touch; the old log is never read again.  Merging takes maxima, so events
that arrive twice, or a run that is repeated, change nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimflow.operators.runlog import DB_T, HOUR, hourly_grain
from dimflow.session import ensure_checkpoint_dir
from dimflow.sinks import fs
from dimflow.sinks.partitioned import load_partitions, read_partitions

GRAIN = [*DB_T, "process_name", "status", HOUR]
SCHEMA = T.StructType([
    *[T.StructField(c, T.StringType()) for c in (*DB_T, "process_name", "status")],
    T.StructField(HOUR, T.LongType()), T.StructField("max_minute", T.LongType()),
    T.StructField("day", T.LongType())])


def merge(old: DataFrame, new: DataFrame) -> DataFrame:
    """Two grains as one."""
    return old.unionByName(new).groupBy(*GRAIN, "day").agg(F.max("max_minute").alias("max_minute"))


def advance(spark: SparkSession, path: str, events: DataFrame) -> None:
    """Merge the grain of ``events`` into the roll-up at ``path``.

    The events are reduced once and kept; only days among them are read from
    the roll-up (partitions, found by a join on the day) and written back, each
    replaced as a whole when the job succeeds."""
    ensure_checkpoint_dir(spark)
    new = hourly_grain(events).withColumn("day", F.expr(f"{HOUR} div 24")).select(
        *SCHEMA.names).checkpoint(eager=True)
    if fs.exists(spark, path):
        days = new.select(F.col("day").alias("_day")).distinct()
        old = state(spark, path).join(days, F.col("day") == F.col("_day"), "left_semi")
        new = merge(old, new).select(*SCHEMA.names)
    load_partitions(new, path, ["day"])


def state(spark: SparkSession, path: str) -> DataFrame:
    return read_partitions(spark, path, SCHEMA)


def as_log(spark: SparkSession, path: str) -> DataFrame:
    """The roll-up in the shape of the load log: what the operators of
    ``runlog`` that start from the hourly grain answer from it is what they
    answer from the whole log."""
    return state(spark, path).select(
        *GRAIN, F.lpad(F.col("max_minute").cast("string"), 12, "0").alias("process_minute"))
