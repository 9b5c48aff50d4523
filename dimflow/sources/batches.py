"""Batch trees as a partitioned source.

Hourly dumps lie in ``date=YYYY-MM-DD/hour=HH`` folders.  Spark discovers them
as partitions, so a window of hours becomes a partition filter: only the files
of those hours are listed into tasks and read.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimflow.sources.files import REASON, parse_delimited

FILE, LINE = "_file", "_line"


def write_tree(lines: DataFrame, root: str, ts: str) -> None:
    """Text lines (column ``value``) into the hour folders of their ``ts``;
    hours that are written again are replaced, others stay."""
    hour = F.col(ts)
    (lines.select("value", F.date_format(hour, "yyyy-MM-dd").alias("date"),
                  F.date_format(hour, "HH").alias("hour"))
     .hint("rebalance", F.col("date"), F.col("hour"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("date", "hour").text(root))


def read_tree(spark: SparkSession, root: str) -> DataFrame:
    """(value, date, hour) of all lines; no task reads before a filter is known."""
    return spark.read.schema("value string, date string, hour string").text(root)


def in_window(start: dt.datetime, end: dt.datetime) -> F.Column:
    """The hours from ``start`` up to but not including ``end``, as a condition
    on the partition columns alone."""
    first, last = start.replace(minute=0, second=0, microsecond=0), end
    if last <= first:
        return F.lit(False)
    final = (last - dt.timedelta(microseconds=1)).replace(minute=0, second=0, microsecond=0)
    date, hour = F.col("date"), F.col("hour")
    day = "%Y-%m-%d"
    after = (date > first.strftime(day)) | ((date == first.strftime(day))
                                            & (hour >= first.strftime("%H")))
    before = (date < final.strftime(day)) | ((date == final.strftime(day))
                                             & (hour <= final.strftime("%H")))
    return date.between(first.strftime(day), final.strftime(day)) & after & before


def read_window(spark: SparkSession, root: str, start: dt.datetime, end: dt.datetime,
                schema: T.StructType, sep: str = "|") -> DataFrame:
    """S6 over a window of hours: the parsed columns, ``_raw`` and
    ``_reject_reason`` of every line, and ``date``, ``hour``."""
    lines = read_tree(spark, root).where(in_window(start, end))
    return parse_delimited(lines, schema, sep, keep=["date", "hour"])


def rejects_in_window(spark: SparkSession, root: str, start: dt.datetime, end: dt.datetime,
                      schema: T.StructType, sep: str = "|") -> DataFrame:
    """The rejected lines of a window, with the file and the line in it
    (``_file``, ``_line`` from 1; blank lines count).

    A file may be read in several splits.  Row ids grow within a split, so a
    line's number is its place in its split plus the lines of the file's earlier
    splits; only one row a split is aggregated and joined back to the rejects.
    """
    lines = read_tree(spark, root).where(in_window(start, end)).select(
        "value", "date", "hour", F.col("_metadata.file_path").alias(FILE),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_id"))
    splits = lines.groupBy(FILE, "_block").agg(F.min("_id").alias("_first"),
                                               F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(FILE).orderBy("_block").rowsBetween(
        Window.unboundedPreceding, -1)
    splits = splits.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    bad = parse_delimited(lines, schema, sep, keep=["date", "hour", FILE, "_block", "_id"]).where(
        F.col(REASON).isNotNull())
    return (bad.join(splits, [FILE, "_block"])
            .withColumn(LINE, F.col("_before") + F.col("_id") - F.col("_first") + 1)
            .drop("_block", "_id", "_first", "_n", "_before"))
