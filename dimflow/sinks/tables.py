"""Warehouse-style tables on plain parquet with atomic publish.

Layout of a table at ``<path>``::

    <path>/v=<n>/_COMMITTED          version n is visible once this exists
    <path>/v=<n>/batch_id=<b>/...    data written by Spark tasks

* a *snapshot publish* (full refresh K9, upsert X1, any ``old -> new``
  update of §2.8) writes ``v=<n+1>/batch_id=snapshot`` and then its marker: readers
  keep seeing version n until the marker lands, and a failed job or gate
  leaves no visible trace (the source's ``DELETE; COPY NO COMMIT; COMMIT``);
* an *append* (K7, K10, log events L15) writes ``batch_id=<b>`` into the
  current version by dynamic partition overwrite, so replaying a batch replaces
  it rather than doubling it, and a failed replay leaves it as it was;
* *truncate* (K11) publishes an empty version.

Overwriting the parquet path being read fails in Spark, which is why new
data always goes to a new folder.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimflow.sinks import fs

_V = re.compile(r"^v=(\d+)$")
MARKER = "_COMMITTED"
SNAPSHOT = "snapshot"


def _versions(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(m.group(1)) for n in fs.list_names(spark, path) if (m := _V.match(n)))


def current_version(spark: SparkSession, path: str) -> int | None:
    """Greatest committed version, or None for a table never published."""
    for v in reversed(_versions(spark, path)):
        if fs.exists(spark, f"{path}/v={v}/{MARKER}"):
            return v
    return None


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None,
               without_batch: str | None = None) -> DataFrame:
    """The current version's rows (``batch_id`` dropped).  A table never
    published reads as empty with ``schema`` when one is given.
    ``without_batch`` leaves out one batch's folder: what the table holds apart
    from a batch that is about to be written (again)."""
    v = current_version(spark, path)
    if v is None:
        if schema is None:
            raise FileNotFoundError(f"no committed version under {path}")
        return spark.createDataFrame([], schema)
    reader = spark.read.option("basePath", f"{path}/v={v}")
    if schema is not None:
        reader = reader.schema(T.StructType(schema.fields + [T.StructField("batch_id", T.StringType())]))
    # the folder name is text, also where all of them look like numbers
    df = reader.parquet(f"{path}/v={v}").withColumn("batch_id", F.col("batch_id").cast("string"))
    if without_batch is not None:
        df = df.where(F.col("batch_id") != without_batch)
    return df.drop("batch_id")


def _claim_version(spark: SparkSession, path: str) -> int:
    """The next version number, claimed by creating ``v=<n>/_CLAIMED`` only
    if absent: two publishers never write into the same version."""
    known = _versions(spark, path)
    v = (max(known) + 1) if known else 1
    while not fs.create_new(spark, f"{path}/v={v}/_CLAIMED"):
        v += 1
    return v


def publish(df: DataFrame, path: str) -> int:
    """K9 (and every snapshot transform): write a new version, then commit.
    Returns the new version number."""
    spark = df.sparkSession
    v = _claim_version(spark, path)
    df.write.mode("overwrite").parquet(f"{path}/v={v}/batch_id={SNAPSHOT}")
    fs.write_text_file(spark, f"{path}/v={v}/{MARKER}", "")
    return v


full_refresh = publish


def append(df: DataFrame, path: str, batch_id: str | int) -> int:
    """Add a batch to the current version (creating version 1
    for a new table).  Idempotent per ``batch_id``: a replay replaces the batch
    by dynamic partition overwrite, once its whole job has succeeded; until
    then, and when it fails, readers see the old rows."""
    spark = df.sparkSession
    folder = fs.partition_folder(spark, {"batch_id": batch_id})
    v = current_version(spark, path)
    if v is None:
        v = _claim_version(spark, path)
        df.write.mode("overwrite").parquet(f"{path}/v={v}/{folder}")
        fs.write_text_file(spark, f"{path}/v={v}/{MARKER}", "")
        return v
    seen = Observation()
    (df.observe(seen, F.count(F.lit(1)).alias("n")).withColumn("batch_id", F.lit(str(batch_id)))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("batch_id").parquet(f"{path}/v={v}"))
    if seen.get["n"] == 0:                               # no rows, so no partition was switched
        df.limit(0).write.mode("overwrite").parquet(f"{path}/v={v}/{folder}")
    return v


def compact(spark: SparkSession, path: str, partitions: int | None = None) -> int:
    """Fold the current version's batch folders (hourly appends accumulate
    many small ones) into one snapshot of a new version; readers switch at
    the commit marker.  ``partitions`` sets the output file count."""
    df = read_table(spark, path)
    if partitions:
        df = df.repartition(partitions)
    return publish(df, path)


def truncate(spark: SparkSession, path: str, schema: T.StructType) -> int:
    """Empty the table (publish an empty version)."""
    return publish(spark.createDataFrame([], schema), path)


def load_staging(df: DataFrame, stg_path: str, columns=None, batch_id: str | int = 0) -> int:
    """K6: load rows into an (empty) staging table with an explicit column
    list.  Q4: a staging table holding rows is an error."""
    from dimflow.operators.quality import assert_empty
    spark = df.sparkSession
    if current_version(spark, stg_path) is not None:
        assert_empty(read_table(spark, stg_path), f"staging table {stg_path}")
    data = df.select(*columns) if columns else df
    return publish(data, stg_path)


def load_direct(df: DataFrame, target_path: str, batch_id: str | int) -> int:
    """K7: skip staging, append straight into production (K10: several
    sources may route into the same target path)."""
    return append(df, target_path, batch_id)


def append_event(spark: SparkSession, path: str, row: dict, schema: T.StructType,
                 batch_id: str) -> int:
    """Append one status event to a log table with a fixed schema
    (missing fields NULL).  ``batch_id`` names the event so a replay
    rewrites it instead of adding a duplicate."""
    values = [row.get(f.name) for f in schema.fields]
    df = spark.createDataFrame([values], schema)
    return append(df, path, batch_id)


# Fixed schemas of the log tables events are appended to.
TRF_LOG_SCHEMA = T.StructType([
    T.StructField("database_name", T.StringType()), T.StructField("table_name", T.StringType()),
    T.StructField("process_name", T.StringType()), T.StructField("processed_utc_hour", T.LongType()),
    T.StructField("status", T.StringType()), T.StructField("platform", T.StringType()),
    T.StructField("process_minute", T.StringType())])
AGG_LOG_SCHEMA = T.StructType([
    T.StructField("host_name", T.StringType()), T.StructField("job_id", T.IntegerType()),
    T.StructField("processed_utc_hour", T.LongType()), T.StructField("status", T.StringType()),
    T.StructField("inserted_at", T.TimestampNTZType()), T.StructField("updated_at", T.TimestampNTZType()),
    T.StructField("platform", T.StringType())])
RUN_LOG_SCHEMA = T.StructType([
    T.StructField("run_id", T.LongType()), T.StructField("job_id", T.IntegerType()),
    T.StructField("process_id", T.LongType()), T.StructField("create_date", T.TimestampNTZType()),
    T.StructField("run_date", T.TimestampNTZType()), T.StructField("file_name", T.StringType()),
    T.StructField("server_name", T.StringType()), T.StructField("status", T.StringType()),
    T.StructField("error_message", T.StringType()), T.StructField("loaded_records", T.LongType()),
    T.StructField("lines_in_file", T.LongType())])



def append_events(events: DataFrame, path: str, run: str, schema: T.StructType) -> int:
    """L15 for many events: one batch folder for all events of a run (missing
    fields NULL), so a log grows by runs, not by events.  The same run again
    rewrites its events."""
    names = set(events.columns)
    return append(events.select(*[
        (F.col(f.name) if f.name in names else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields]), path, f"run-{run}")


def append_load_event(spark: SparkSession, path: str, database: str, table: str, process: str,
                      hour: int, status: str, platform: str, minute: str | None = None) -> int:
    """A load-log event (optional minute stamp) -- one per (platform,
    database, table, process, batch, status), so a replay rewrites it and no
    other event does."""
    return append_event(spark, path, dict(database_name=database, table_name=table, process_name=process,
                                          processed_utc_hour=int(hour), status=status, platform=platform,
                                          process_minute=minute),
                        TRF_LOG_SCHEMA,
                        f"{platform}-{database}-{table}-{process}-{minute or hour}-{status}")


def append_agg_event(spark: SparkSession, path: str, host: str, job_id: int, hour: int, status: str,
                     platform: str | None = None, at=None) -> int:
    """An aggregate-run-log event (all seven columns)."""
    import datetime as _dt
    at = at or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    return append_event(spark, path, dict(host_name=host, job_id=int(job_id), processed_utc_hour=int(hour),
                                          status=status, inserted_at=at, updated_at=at, platform=platform),
                        AGG_LOG_SCHEMA, f"{platform}-{host}-{job_id}-{hour}-{status}")


def append_run_event(spark: SparkSession, path: str, job_id: int, process_id: int, status: str,
                     row_count: int = 0, file_name: str = "", lines: int = 0, error: str = "",
                     server: str | None = None, at=None) -> int:
    """A run-log event -- plain, with a loaded-row count, or with a file
    name and its line count."""
    import datetime as _dt
    import socket
    at = at or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    return append_event(spark, path, dict(job_id=int(job_id), process_id=int(process_id), create_date=at,
                                          run_date=at, file_name=file_name, server_name=server or socket.gethostname(),
                                          status=status, error_message=error, loaded_records=int(row_count),
                                          lines_in_file=int(lines)),
                        RUN_LOG_SCHEMA, f"{job_id}-{process_id}-{at:%Y%m%d%H%M%S%f}-{status}")
