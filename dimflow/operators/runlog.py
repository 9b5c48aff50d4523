"""Load-log analytics: what to run next, what failed, high-water marks.

The source asked one scalar SQL question per (database, table).  Here each
question is a set-based pass over the whole log that answers it for every
table at once, so one scan serves all tables and nothing loops on the driver.

Skew: a log may hold a third of its rows for one table.  Every query first
reduces the log to *hourly grain* -- ``groupBy(db, table, process, status,
hour)``, an aggregate that combines map-side -- so later joins and per-table
steps see at most one row per table-hour, however hot the table.

Log schemas (FIXTURES.md §1):
  trf log:   database_name, table_name, process_name, processed_utc_hour,
             status, platform, process_minute
  agg log:   host_name, job_id, processed_utc_hour, status
  run log:   run_id, job_id, run_date, status, ...
  uploads:   load_hour, status, is_forced
  update log: table_name, update_date, uploaded_to_vertica
  dim load log: run_time, status, platform
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dimflow.functions.timeutil import (batch_path, hour_ts, ntz, parse_minute, minute_string,
                                        truncate_to_second, utc_hour)

DB_T = ["database_name", "table_name"]
HOUR = "processed_utc_hour"


def hourly_grain(log: DataFrame) -> DataFrame:
    """The trf log reduced to one row per (db, table, process, status, hour),
    keeping the latest ``process_minute`` of each, as a number (a hash
    aggregate; stamps of twelve digits keep their order)."""
    return log.groupBy(*DB_T, "process_name", "status", HOUR) \
        .agg(F.max(F.col("process_minute").cast("bigint")).alias("max_minute"))


def _minute_text(c: Column) -> Column:
    return F.lpad(c.cast("string"), 12, "0")


def _hour_minute(done: Column) -> Column:
    """The greatest (hour, minute) of the ``done`` rows in one number: the hour
    times 10**12 plus the minute stamp plus one (0: no stamp)."""
    return F.max(F.when(done, F.col(HOUR) * F.lit(10 ** 12)
                        + F.coalesce(F.col("max_minute") + 1, F.lit(0))))


def next_after(probes: DataFrame, values: DataFrame, group: list[str], probe_col: str,
               value_col: str, out: str) -> DataFrame:
    """For every probe row, the smallest value of its group strictly
    greater than ``probe_col`` (NULL when none or when the probe is NULL).

    The successor search of the source's ``x > (select max ...)`` subqueries,
    done without pairing every probe with every value: probes and values are
    unioned and one running ``min`` over the group, sorted descending, hands
    each probe the smallest value seen above it -- linear in the group, one
    sort.  Probes and values are reduced to distinct ones first, so a group
    holds hours only, however many probe rows share it; the answers are joined
    back to the rows.
    """
    p = probes.select(*group, F.col(probe_col).alias("_x")).distinct().withColumn("_k", F.lit(0))
    v = values.select(*group, F.col(value_col).alias("_x")).distinct().withColumn("_k", F.lit(1))
    w = (Window.partitionBy(*group).orderBy(F.col("_x").desc_nulls_last(), F.col("_k").asc())
         .rowsBetween(Window.unboundedPreceding, -1))
    nxt = F.min(F.when(F.col("_k") == 1, F.col("_x"))).over(w)
    u = p.unionByName(v).withColumn(out, F.when(F.col("_x").isNotNull(), nxt))
    found = u.where((F.col("_k") == 0) & F.col(out).isNotNull()).select(
        *[F.col(c).alias(f"_g{i}") for i, c in enumerate(group)], "_x", out)
    same = F.col(probe_col) == F.col("_x")
    for i, c in enumerate(group):
        same = same & (F.col(c) == F.col(f"_g{i}"))
    return probes.join(found, same, "left").select(*probes.columns, out)


def _is(process: str, *statuses: str) -> Column:
    return (F.col("process_name") == process) & F.col("status").isin(*statuses)


# ---------------------------------------------------------------- trf log ----

def last_load_hour(log: DataFrame, process: str = "LOAD") -> DataFrame:
    """Last COMPLETED load hour per table, 0 when none
    (``COALESCE(MAX(...), 0)``)."""
    g = hourly_grain(log)
    return g.groupBy(*DB_T).agg(
        F.coalesce(F.max(F.when(_is(process, "COMPLETED"), F.col(HOUR))), F.lit(0))
        .cast("bigint").alias("last_load_hour"))


def last_load_minute(log: DataFrame, hour: int | None = None, process: str = "LOAD") -> DataFrame:
    """Latest loaded minute stamp within an hour (NULL when none).

    ``hour=None`` uses each table's own last loaded hour (L9), which is how the
    minute-interval loader asks; the result also carries that hour.
    """
    g = hourly_grain(log)
    done = _is(process, "COMPLETED")
    if hour is None:
        minute = F.expr("_b % 1000000000000")
        return g.groupBy(*DB_T).agg(_hour_minute(done).alias("_b")).select(
            *DB_T, F.coalesce(F.expr("_b div 1000000000000"), F.lit(0)).cast("bigint")
            .alias("last_load_hour"),
            F.when(minute > 0, _minute_text(minute - 1)).alias("last_load_minute"))
    return g.groupBy(*DB_T).agg(
        F.lit(hour).cast("bigint").alias("last_load_hour"),
        F.max(F.when(done & (F.col(HOUR) == hour), F.col("max_minute"))).alias("_m")) \
        .select(*DB_T, "last_load_hour", _minute_text(F.col("_m")).alias("last_load_minute"))


def next_load_hour(log: DataFrame) -> DataFrame:
    """First COMPLETED TRANSFER hour after the last COMPLETED LOAD hour
    (0 stands for "no load yet"), 0 when there is none."""
    return table_status(log).select(*DB_T, "next_load_hour")


def next_realtime_hour(log: DataFrame) -> DataFrame:
    """First S3Sync hour (COMPLETED or STARTED) after the table's last
    COMPLETED TRANSFER hour; that maximum is taken over the table name in any
    database, with no fallback, so a table never transferred gets 0."""
    return table_status(log).select(*DB_T, "next_realtime_hour")


def table_status(log: DataFrame) -> DataFrame:
    """L6/L7/L9/L10/L14 in one pass: per (database, table) the last loaded
    hour and minute, the next hour to load, the next real-time hour and the
    greatest sync hour.

    The log is reduced to hourly grain once; one shuffle by ``table_name``
    then serves both windows -- per table name (L7's TRANSFER maximum, taken
    over every database) and per (database, table), whose clustering the
    same partitioning satisfies -- and the final per-table aggregate.  Every
    group holds hourly-grain rows only, however hot the table.
    """
    g = hourly_grain(log)
    by_t = Window.partitionBy("table_name")
    by_dt = Window.partitionBy(*DB_T)
    load_done = _is("LOAD", "COMPLETED")
    # the coarser window first: its hash(table_name) partitioning also
    # clusters (database, table), so neither the second window nor the
    # final aggregate shuffles again
    g = (g.withColumn("_trf", F.max(F.when(_is("TRANSFER", "COMPLETED"), F.col(HOUR))).over(by_t))
          .withColumn("_last", F.max(F.when(load_done, F.col(HOUR))).over(by_dt)))
    last = F.coalesce(F.col("_last"), F.lit(0))
    nxt_load = F.min(F.when(_is("TRANSFER", "COMPLETED") & (F.col(HOUR) > last), F.col(HOUR)))
    nxt_rt = F.min(F.when(_is("S3Sync", "COMPLETED", "STARTED") & (F.col(HOUR) > F.col("_trf")), F.col(HOUR)))
    minute = F.expr("_b % 1000000000000")
    return g.groupBy(*DB_T).agg(
        F.coalesce(F.max(F.when(load_done, F.col(HOUR))), F.lit(0)).cast("bigint").alias("last_load_hour"),
        _hour_minute(load_done).alias("_b"),
        F.coalesce(nxt_load, F.lit(0)).cast("bigint").alias("next_load_hour"),
        F.coalesce(nxt_rt, F.lit(0)).cast("bigint").alias("next_realtime_hour"),
        F.max(F.when(F.col("process_name") == "S3Sync", F.col(HOUR))).alias("max_sync_hour")) \
        .select(*DB_T, "last_load_hour",
                F.when(minute > 0, _minute_text(minute - 1)).alias("last_load_minute"),
                "next_load_hour", "next_realtime_hour", "max_sync_hour")


def sync_completed(log: DataFrame, hour: int | Column) -> DataFrame:
    """Whether S3Sync is COMPLETED for ``hour``, per table."""
    h = hour if isinstance(hour, Column) else F.lit(hour)
    g = hourly_grain(log)
    hit = _is("S3Sync", "COMPLETED") & (F.col(HOUR) == h)
    return g.groupBy(*DB_T).agg(F.coalesce(F.max(hit), F.lit(False)).alias("sync_completed"))


def current_sync_hour(log: DataFrame) -> DataFrame:
    """Hour being synced (a STARTED S3Sync) per table name.  The
    source took an unordered first row; the smallest hour is the documented
    pick."""
    g = hourly_grain(log)
    return g.where(_is("S3Sync", "STARTED")).groupBy("table_name") \
        .agg(F.min(HOUR).alias("current_sync_hour"))


def max_sync_hour(log: DataFrame) -> DataFrame:
    """Greatest S3Sync hour of any status, per table."""
    g = hourly_grain(log)
    return g.where(F.col("process_name") == "S3Sync").groupBy(*DB_T) \
        .agg(F.max(HOUR).alias("max_sync_hour"))


def hours_to_sync(uploads: DataFrame, log: DataFrame, database: str, table: str,
                  lookback_hours: int = 1) -> DataFrame:
    """Upload hours of the last ``lookback_hours`` (``load_hour > max -
    lookback``) with no COMPLETED S3Sync of the table: an anti join on the
    hour timestamp.  The max is a scalar subquery evaluated once."""
    mx = uploads.agg(F.max("load_hour")).scalar()
    recent = uploads.where(F.col("load_hour") > F.timestamp_add("HOUR", F.lit(-lookback_hours), mx)) \
        .select("load_hour").distinct()
    synced = log.where(_is("S3Sync", "COMPLETED") & (F.col("database_name") == database)
                       & (F.col("table_name") == table)) \
        .select(hour_ts(F.col(HOUR)).alias("_sync_ts")).distinct()
    todo = recent.join(synced, F.col("load_hour") == F.col("_sync_ts"), "left_anti")
    return todo.select(utc_hour("load_hour").alias(HOUR)).distinct()


# ---------------------------------------------------------------- agg log ----

def next_aggregate_hour(agg_log: DataFrame, pairs: DataFrame) -> DataFrame:
    """L3: for each ``(job_id, upstream_job_id)``: the smallest upstream hour
    (COMPLETED or RUNNING) above the job's own last COMPLETED hour (0 if none);
    NULL when there is none."""
    up_hours = agg_log.where(F.col("status").isin("COMPLETED", "RUNNING")) \
        .select(F.col("job_id").alias("upstream_job_id"), F.col(HOUR).alias("_h")).distinct()
    done = agg_log.where(F.col("status") == "COMPLETED").groupBy("job_id") \
        .agg(F.max(HOUR).alias("_done"))
    p = pairs.select("job_id", "upstream_job_id").distinct().join(done, "job_id", "left") \
        .select("upstream_job_id", "job_id", F.coalesce(F.col("_done"), F.lit(0)).alias("_thr"))
    r = next_after(p, up_hours, ["upstream_job_id"], "_thr", "_h", "next_hour")
    return r.select("job_id", "upstream_job_id", F.col("next_hour").cast("bigint").alias("next_hour"))


def next_transfer_hour(agg_log: DataFrame, log: DataFrame, targets: DataFrame) -> DataFrame:
    """For each ``(database_name, table_name, upstream_job_id)``: the
    smallest upstream hour (COMPLETED or RUNNING) above the table's last
    COMPLETED TRANSFER hour, or -- when it was never transferred -- above the
    upstream's greatest hour minus one; NULL when none."""
    ok = agg_log.where(F.col("status").isin("COMPLETED", "RUNNING"))
    up_hours = ok.select(F.col("job_id").alias("upstream_job_id"), F.col(HOUR).alias("_h")).distinct()
    up_prev = ok.groupBy(F.col("job_id").alias("_upm")).agg((F.max(HOUR) - 1).alias("_prev"))
    g = hourly_grain(log)
    trf = g.where(_is("TRANSFER", "COMPLETED")).groupBy(*DB_T).agg(F.max(HOUR).alias("_trf"))
    t = (targets.select(*DB_T, "upstream_job_id").distinct()
         .join(trf, DB_T, "left")
         .join(up_prev, F.col("upstream_job_id") == F.col("_upm"), "left")
         .select("upstream_job_id", *DB_T, F.coalesce(F.col("_trf"), F.col("_prev")).alias("_thr")))
    r = next_after(t, up_hours, ["upstream_job_id"], "_thr", "_h", "next_transfer_hour")
    return r.select(*DB_T, "upstream_job_id",
                    F.col("next_transfer_hour").cast("bigint").alias("next_transfer_hour"))


# ---------------------------------------------------------------- uploads ----

def processing_count(uploads: DataFrame) -> DataFrame:
    """Unforced PROCESSING uploads per load hour."""
    return uploads.groupBy("load_hour").agg(
        F.count_if((F.col("status") == "PROCESSING") & (F.col("is_forced") == 0))
        .alias("n_processing"))


def latest_processing_hour(uploads: DataFrame) -> DataFrame:
    """The latest PROCESSING load hour (one row, NULL when none)."""
    return uploads.agg(F.max(F.when(F.col("status") == "PROCESSING", F.col("load_hour")))
                       .alias("latest_processing_hour"))


def next_contiguous_hour(uploads: DataFrame, current) -> DataFrame:
    """Next hour to sync / transfer: the smallest load hour that is
    COMPLETED or forced, after ``current`` and before the first unforced
    PROCESSING hour.  With no PROCESSING row the bound is NULL and there is no
    hour (kept as the source had it).  The bound is a scalar subquery."""
    bound = uploads.where((F.col("status") == "PROCESSING") & (F.col("is_forced") == 0)) \
        .agg(F.min("load_hour")).scalar()
    cur = current if isinstance(current, Column) else ntz(str(current))
    ok = (F.col("status") == "COMPLETED") | (F.col("is_forced") == 1)
    return uploads.where(ok & (F.col("load_hour") < bound) & (F.col("load_hour") > cur)) \
        .agg(F.min("load_hour").alias("next_hour"))


# ---------------------------------------------------------------- run log ----

def prev_status(run_log: DataFrame, mode: str | int = "today", today: str | None = None) -> DataFrame:
    """L1: status of each job's latest run (greatest ``run_id``), trimmed;
    ``'completed'`` when the job has no run in the window.

    ``mode='today'``: runs dated ``today``; ``-1``: any time; ``n >= 1``: the
    source's predicate ``date(run_date) >= run_date - n days`` kept literally
    (it compares a run with itself, so it keeps every run).  ``0`` is
    "today": the source tested the interval for truthiness, and 0 is false.
    """
    if mode == "today" or mode == 0 or mode is None:
        window = F.to_date("run_date") == F.to_date(F.lit(today))
    elif mode == -1 or mode == "any":
        window = F.lit(True)
    else:
        n = int(mode)
        window = F.to_timestamp_ntz(F.to_date("run_date").cast("string")) >= \
            F.timestamp_add("DAY", F.lit(-n), F.col("run_date"))
    latest = run_log.groupBy("job_id").agg(
        F.max(F.when(window, F.struct("run_id", "status"))).alias("_l"))
    return latest.select(
        "job_id", F.coalesce(F.trim(F.col("_l.status")), F.lit("completed")).alias("status"))


def last_completed_date(run_log: DataFrame) -> DataFrame:
    """L2: date of each job's latest completed run (NULL when none)."""
    return run_log.groupBy("job_id").agg(
        F.to_date(F.max(F.when(F.col("status") == "completed", F.col("run_date"))))
        .alias("last_completed_date"))


def run_summary(table_runs: DataFrame) -> DataFrame:
    """Per outcome of a run: tables, runs, total and longest minutes.

    ``table_runs(table_name, status, start_time, end_time)``.  The per-table
    list stays a DataFrame (``table_minutes``); nothing is gathered on the
    driver.
    """
    secs = F.timestamp_diff("SECOND", F.col("start_time"), F.col("end_time"))
    return table_runs.groupBy("status").agg(
        F.count_distinct("table_name").alias("n_tables"),
        F.count(F.lit(1)).alias("n_runs"),
        F.sum(secs).cast("bigint").alias("total_seconds"),
        (F.max(secs) / 60.0).alias("max_minutes"))


def table_minutes(table_runs: DataFrame) -> DataFrame:
    """Minutes each table took, with its outcome."""
    return table_runs.select("table_name", "status", (
        F.timestamp_diff("SECOND", F.col("start_time"), F.col("end_time")) / 60.0).alias("minutes"))


# ------------------------------------------------------------ update logs ----

def watermarks(update_log: DataFrame) -> DataFrame:
    """Each table's last successful dump time (latest ``complete``
    marker), cut to whole seconds and kept as TIMESTAMP_NTZ."""
    return update_log.where(F.col("uploaded_to_vertica") == "complete") \
        .groupBy("table_name").agg(F.max("update_date").alias("_m")) \
        .select("table_name", truncate_to_second("_m").alias("watermark"))


def failed_runs(load_log: DataFrame, now: int, lag: int = 15, platform: str | None = None,
                true_time: bool = False, hourly: bool = False) -> DataFrame:
    """F2/T4: runs to retry -- status FAILED or STARTED and older than ``now -
    lag``, per platform; the pick is the smallest such run (the source took
    an unordered first row).

    Literal rule (default): ``run_time < now - lag`` as plain numbers on the
    ``yyyyMMddHHmm`` stamp (202401010105 - 15 = 202401010090).  With
    ``true_time`` the lag is real minutes (hours when ``hourly``).
    """
    if true_time:
        fmt = "yyyyMMddHH" if hourly else "yyyyMMddHHmm"
        unit = "HOUR" if hourly else "MINUTE"
        now_ts = F.to_timestamp_ntz(F.lit(str(now)), F.lit(fmt))
        bound = F.date_format(F.timestamp_add(unit, F.lit(-lag), now_ts), fmt).cast("bigint")
    else:
        bound = F.lit(int(now) - int(lag)).cast("bigint")
    df = load_log.where(F.col("status").isin("FAILED", "STARTED") & (F.col("run_time") < bound))
    if platform is not None:
        df = df.where(F.col("platform") == platform)
    return df.groupBy("platform").agg(F.min("run_time").alias("failed_run_time"),
                                      F.count(F.lit(1)).alias("n_failed"))


def epoch_count(df: DataFrame, epoch_col: str = "load_epoch_ts") -> DataFrame:
    """Rows per load epoch (the source counted one epoch at a time)."""
    return df.groupBy(epoch_col).agg(F.count(F.lit(1)).alias("row_count"))


# ------------------------------------------------------------ intervals ----

def next_interval(log: DataFrame, interval: str = "hourly", step: int = 1,
                  carry: str = "literal", staging: bool = False) -> DataFrame:
    """H4/H5 + K12: the next batch to load for every table.

    hourly: last loaded hour (L9) + ``step``; batch folder ``yyyyMMddHH``
    (``yyyyMMddHH00`` in staging).  daily: last loaded hour + ``step``
    hours (24 for a day); batch folder ``date=yyyy-MM-dd``.  minutes: last loaded minute (L10) +
    ``step`` minutes; the hour moves on by one only when the new minute is
    ``00`` (``carry='literal'``: a step jumping past ``00`` leaves it stale) or
    is derived from the new minute (``carry='true'``); a table with no loaded
    minute has nothing to do.  H5: hour 0 means nothing to load -> dropped.
    """
    if interval not in ("hourly", "daily", "minutes"):
        raise ValueError(f"unknown interval {interval!r}")
    if interval == "daily":
        last = last_load_hour(log).withColumn("next_hour", F.col("last_load_hour") + step)
        out = last.select(*DB_T, "last_load_hour", F.lit(None).cast("string").alias("last_load_minute"),
                          "next_hour", F.lit(None).cast("string").alias("next_minute"),
                          F.date_format(hour_ts("next_hour"), "'date='yyyy-MM-dd").alias("batch"))
    elif interval == "hourly":
        last = last_load_hour(log)
        nxt = last.withColumn("next_hour", F.col("last_load_hour") + step)
        out = nxt.select(*DB_T, "last_load_hour", F.lit(None).cast("string").alias("last_load_minute"),
                         "next_hour", F.lit(None).cast("string").alias("next_minute"),
                         batch_path("next_hour", "hour00" if staging else "hour").alias("batch"))
    else:
        last = last_load_minute(log).where(F.col("last_load_minute").isNotNull())
        nts = F.timestamp_add("MINUTE", F.lit(step), parse_minute(F.col("last_load_minute")))
        if carry == "literal":
            hour = F.when(F.date_format(nts, "mm") == "00", F.col("last_load_hour") + 1) \
                .otherwise(F.col("last_load_hour"))
        else:
            hour = utc_hour(nts)
        out = last.select(*DB_T, "last_load_hour", "last_load_minute",
                          hour.cast("bigint").alias("next_hour"),
                          minute_string(nts).alias("next_minute"),
                          minute_string(nts).alias("batch"))
    return out.where(F.col("next_hour") != 0)
