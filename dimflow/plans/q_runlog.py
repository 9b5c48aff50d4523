"""Queries for the load-log analytics.

The oracles state each rule as grouped aggregates and joins over the whole
fixture log, for every table at once.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from dimflow.functions.timeutil import utc_hour
from dimflow.operators import runlog as RL
from dimflow.plans.catalog import register
from dimflow.plans.fixtures import fixture, table, with_fixtures
from dimflow.sources.tables import scan_delta_by_table


def _hour(y, m, d, h=0) -> int:
    return int(dt.datetime(y, m, d, h, tzinfo=dt.timezone.utc).timestamp() // 3600)


SYNC_HOUR = _hour(2024, 1, 15, 10)


def _log(spark, sf):
    return fixture(spark, sf, "fx_load_log")


@register("last_load_hour", with_fixtures("""
select database_name, table_name,
 cast(coalesce(max(case when process_name = 'LOAD' and status = 'COMPLETED' then processed_utc_hour end), 0) as bigint) as last_load_hour
 from fx_load_log group by database_name, table_name""", "fx_load_log"))
def q_last_load_hour(spark, sf):
    """Last loaded hour, 0 when none."""
    return RL.last_load_hour(_log(spark, sf))


# Hours of each table by what happened in them: loaded, transferred, synced.
HOURS = """
hours as (
 select database_name, table_name, processed_utc_hour as h, process_minute as m,
  process_name = 'LOAD' and status = 'COMPLETED' as loaded,
  process_name = 'TRANSFER' and status = 'COMPLETED' as transferred,
  process_name = 'S3Sync' and status in ('COMPLETED', 'STARTED') as syncing,
  process_name = 'S3Sync' as sync
 from fx_load_log),
done as (
 select database_name, table_name, cast(coalesce(max(h) filter (where loaded), 0) as bigint) as last_load_hour,
  max(h) filter (where sync) as max_sync_hour
 from hours group by all)"""

LAST_MINUTE = f"""
with {HOURS}
select d.database_name, d.table_name, d.last_load_hour, max(x.m) as last_load_minute
 from done d left join hours x on x.database_name = d.database_name and x.table_name = d.table_name
  and x.loaded and x.h = d.last_load_hour
 group by all"""

NEXT_LOAD = f"""
with {HOURS}
select d.database_name, d.table_name, cast(coalesce(min(x.h), 0) as bigint) as next_load_hour
 from done d left join hours x on x.database_name = d.database_name and x.table_name = d.table_name
  and x.transferred and x.h > d.last_load_hour
 group by all"""

NEXT_REALTIME = f"""
with {HOURS},
sent as (select table_name, max(h) as sent_hour from hours where transferred group by all)
select d.database_name, d.table_name, cast(coalesce(min(x.h), 0) as bigint) as next_realtime_hour
 from done d left join sent on sent.table_name = d.table_name
 left join hours x on x.database_name = d.database_name and x.table_name = d.table_name
  and x.syncing and x.h > sent.sent_hour
 group by all"""


@register("last_load_minute", with_fixtures(LAST_MINUTE, "fx_load_log"))
def q_last_load_minute(spark, sf):
    """L10 (within each table's last loaded hour)."""
    return RL.last_load_minute(_log(spark, sf))


@register("last_load_minute_at_hour", with_fixtures(f"""
with {HOURS}
select database_name, table_name, cast({SYNC_HOUR} as bigint) as last_load_hour,
 max(m) filter (where loaded and h = {SYNC_HOUR}) as last_load_minute from hours group by all""", "fx_load_log"))
def q_last_load_minute_at_hour(spark, sf):
    """L10 for a given hour."""
    return RL.last_load_minute(_log(spark, sf), hour=SYNC_HOUR)


@register("next_load_hour", with_fixtures(NEXT_LOAD, "fx_load_log"))
def q_next_load_hour(spark, sf):
    """L6."""
    return RL.next_load_hour(_log(spark, sf))


@register("next_realtime_hour", with_fixtures(NEXT_REALTIME, "fx_load_log"))
def q_next_realtime_hour(spark, sf):
    """L7."""
    return RL.next_realtime_hour(_log(spark, sf))


@register("sync_completed", with_fixtures(f"""
select database_name, table_name,
 bool_or(process_name = 'S3Sync' and status = 'COMPLETED' and processed_utc_hour = {SYNC_HOUR}) as sync_completed
 from fx_load_log group by all""", "fx_load_log"))
def q_sync_completed(spark, sf):
    """L8 for 2024-01-15 10:00 UTC."""
    return RL.sync_completed(_log(spark, sf), SYNC_HOUR)


@register("current_sync_hour", with_fixtures("""
select table_name, min(processed_utc_hour) as current_sync_hour from fx_load_log
 where process_name = 'S3Sync' and status = 'STARTED' group by table_name""", "fx_load_log"))
def q_current_sync_hour(spark, sf):
    """Hour now being synced (smallest as the pick)."""
    return RL.current_sync_hour(_log(spark, sf))


@register("max_sync_hour", with_fixtures("""
select database_name, table_name, max(processed_utc_hour) as max_sync_hour from fx_load_log
 where process_name = 'S3Sync' group by database_name, table_name""", "fx_load_log"))
def q_max_sync_hour(spark, sf):
    """L14."""
    return RL.max_sync_hour(_log(spark, sf))


@register("hours_to_sync", with_fixtures("""
with recent as (
 select load_hour, max(load_hour) over () as newest from fx_uploads)
select cast(floor(epoch(load_hour) / 3600) as bigint) as processed_utc_hour from recent
 where load_hour > newest - interval 1 hour
except
select processed_utc_hour from fx_load_log
 where process_name = 'S3Sync' and status = 'COMPLETED' and table_name = 'click' and database_name = 'db0'""",
                                         "fx_uploads", "fx_load_log"))
def q_hours_to_sync(spark, sf):
    """Recent upload hours not yet synced for db0.click."""
    return RL.hours_to_sync(fixture(spark, sf, "fx_uploads"), _log(spark, sf), "db0", "click")


@register("next_aggregate_hour", with_fixtures("""
with own as (
 select job_id, 3 - job_id as upstream_job_id,
  coalesce(max(processed_utc_hour) filter (where status = 'COMPLETED'), 0) as reached
 from fx_agg_log group by all)
select own.job_id, own.upstream_job_id, cast(min(up.processed_utc_hour) as bigint) as next_hour
 from own left join fx_agg_log up on up.job_id = own.upstream_job_id
  and up.status in ('COMPLETED', 'RUNNING') and up.processed_utc_hour > own.reached
 group by all""", "fx_agg_log"))
def q_next_aggregate_hour(spark, sf):
    """Each job against the other job as its upstream."""
    agg = fixture(spark, sf, "fx_agg_log")
    pairs = agg.select("job_id", (F.lit(3) - F.col("job_id")).alias("upstream_job_id"))
    return RL.next_aggregate_hour(agg, pairs)


@register("next_transfer_hour", with_fixtures("""
with targets as (
 select database_name, table_name, if(database_name = 'db0', 1, 2) as upstream_job_id,
  max(processed_utc_hour) filter (where process_name = 'TRANSFER' and status = 'COMPLETED') as sent
 from fx_load_log group by all),
upstream as (
 select job_id, processed_utc_hour as h, max(processed_utc_hour) over (partition by job_id) as newest
 from fx_agg_log where status in ('COMPLETED', 'RUNNING'))
select t.database_name, t.table_name, t.upstream_job_id, cast(min(u.h) as bigint) as next_transfer_hour
 from targets t left join upstream u on u.job_id = t.upstream_job_id and u.h > coalesce(t.sent, u.newest - 1)
 group by all""",
                                              "fx_load_log", "fx_agg_log"))
def q_next_transfer_hour(spark, sf):
    """Every table of the trf log; db0 tables are fed by aggregation job 1,
    the others by job 2."""
    log = _log(spark, sf)
    up = F.when(F.col("database_name") == "db0", F.lit(1)).otherwise(F.lit(2))
    targets = log.select("database_name", "table_name", up.alias("upstream_job_id"))
    return RL.next_transfer_hour(fixture(spark, sf, "fx_agg_log"), log, targets)


@register("processing_count", with_fixtures("""
select load_hour, count(case when status = 'PROCESSING' and is_forced = 0 then 1 end) as n_processing
 from fx_uploads group by load_hour""", "fx_uploads"))
def q_processing_count(spark, sf):
    """L5."""
    return RL.processing_count(fixture(spark, sf, "fx_uploads"))


@register("latest_processing_hour", with_fixtures("""
select max(case when status = 'PROCESSING' then load_hour end) as latest_processing_hour from fx_uploads""",
                                                  "fx_uploads"))
def q_latest_processing_hour(spark, sf):
    """L12."""
    return RL.latest_processing_hour(fixture(spark, sf, "fx_uploads"))


@register("next_contiguous_hour", with_fixtures("""
with bounds as (
 select min(load_hour) filter (where status = 'PROCESSING' and is_forced = 0) as stop from fx_uploads)
select min(load_hour) as next_hour from fx_uploads join bounds
  on load_hour > TIMESTAMP '2024-01-20 00:00:00' and load_hour < stop
 where status = 'COMPLETED' or is_forced = 1""", "fx_uploads"))
def q_next_contiguous_hour(spark, sf):
    """Next hour to sync after 2024-01-20 00:00."""
    return RL.next_contiguous_hour(fixture(spark, sf, "fx_uploads"), "2024-01-20 00:00:00")


PREV = """
select job_id, coalesce(trim(arg_max(status, run_id) filter (where {cond})), 'completed') as status
 from fx_run_log group by job_id"""


@register("prev_status_today", with_fixtures(
    PREV.format(cond="cast(run_date as date) = DATE '2024-01-15'"), "fx_run_log"))
def q_prev_status_today(spark, sf):
    """L1, today's runs only (today = 2024-01-15)."""
    return RL.prev_status(fixture(spark, sf, "fx_run_log"), "today", "2024-01-15")


@register("prev_status_any", with_fixtures(PREV.format(cond="true"), "fx_run_log"))
def q_prev_status_any(spark, sf):
    """L1, any time (-1)."""
    return RL.prev_status(fixture(spark, sf, "fx_run_log"), -1)


@register("prev_status_days", with_fixtures(PREV.format(
    cond="cast(cast(run_date as date) as timestamp) >= run_date - interval 3 day"), "fx_run_log"))
def q_prev_status_days(spark, sf):
    """L1, n-day mode with n = 3 (the literal self-comparison)."""
    return RL.prev_status(fixture(spark, sf, "fx_run_log"), 3)


@register("last_completed_date", with_fixtures("""
select job_id, cast(max(case when status = 'completed' then run_date end) as date) as last_completed_date
 from fx_run_log group by job_id""", "fx_run_log"))
def q_last_completed_date(spark, sf):
    """L2."""
    return RL.last_completed_date(fixture(spark, sf, "fx_run_log"))


@register("run_summary", with_fixtures("""
select status, count(distinct table_name) as n_tables, count(*) as n_runs,
 cast(sum(date_diff('second', start_time, end_time)) as bigint) as total_seconds,
 max(date_diff('second', start_time, end_time)) / 60.0 as max_minutes
 from fx_table_runs group by status""", "fx_table_runs"))
def q_run_summary(spark, sf):
    """Outcome summary of the per-table runs."""
    return RL.run_summary(fixture(spark, sf, "fx_table_runs"))


@register("table_minutes", with_fixtures("""
select table_name, status, date_diff('second', start_time, end_time) / 60.0 as minutes from fx_table_runs""",
                                         "fx_table_runs"))
def q_table_minutes(spark, sf):
    """Minutes per table run."""
    return RL.table_minutes(fixture(spark, sf, "fx_table_runs"))


@register("watermarks_events", with_fixtures("""
select table_name, date_trunc('second', max(update_date)) as watermark from fx_update_log
 where uploaded_to_vertica = 'complete' group by table_name""", "fx_update_log"))
def q_watermarks_events(spark, sf):
    """L16 over the events-derived update log."""
    return RL.watermarks(fixture(spark, sf, "fx_update_log"))


@register("scan_delta", with_fixtures("""
select e.* from events e left join (select table_name, date_trunc('second', max(update_date)) as watermark
   from fx_update_log where uploaded_to_vertica = 'complete' group by table_name) w on w.table_name = e.event_type
 where w.watermark is null or e.ts > w.watermark""", "fx_update_log"))
def q_scan_delta(spark, sf):
    """S3/F1: each source table's rows after its own watermark, in one pass."""
    wm = RL.watermarks(fixture(spark, sf, "fx_update_log"))
    return scan_delta_by_table(table(spark, sf, "events"), wm, "event_type", "ts")


@register("failed_runs", with_fixtures("""
select platform, min(run_time) as failed_run_time, count(*) as n_failed from fx_dim_load_log
 where status in ('FAILED', 'STARTED') and run_time < (202401150000 - 15) group by platform""", "fx_dim_load_log"))
def q_failed_runs(spark, sf):
    """F2/T4: literal decimal subtraction on the minute stamp."""
    return RL.failed_runs(fixture(spark, sf, "fx_dim_load_log"), 202401150000, 15)


@register("failed_runs_true_time", with_fixtures("""
select platform, min(run_time) as failed_run_time, count(*) as n_failed from fx_dim_load_log
 where status in ('FAILED', 'STARTED') and run_time < 202401142345 group by platform""",
                                                 "fx_dim_load_log"))
def q_failed_runs_true_time(spark, sf):
    """F2 with real minutes, every platform."""
    return RL.failed_runs(fixture(spark, sf, "fx_dim_load_log"), 202401150000, 15, true_time=True)


@register("epoch_count", """
select cast(floor(epoch(ts) / 3600) as bigint) as load_epoch_ts, count(*) as row_count from events group by 1""")
def q_epoch_count(spark, sf):
    """Rows per load epoch (events, epoch = UTC hour)."""
    ev = table(spark, sf, "events").select(utc_hour("ts").alias("load_epoch_ts"))
    return RL.epoch_count(ev)


@register("next_interval_hourly", with_fixtures("""
select database_name, table_name, last_load_hour, cast(null as varchar) as last_load_minute,
 last_load_hour + 1 as next_hour, cast(null as varchar) as next_minute,
 strftime(make_timestamp((last_load_hour + 1) * 3600 * 1000000), '%Y%m%d%H') as batch from (
 select database_name, table_name,
  cast(coalesce(max(case when process_name = 'LOAD' and status = 'COMPLETED' then processed_utc_hour end), 0) as bigint)
    as last_load_hour from fx_load_log group by database_name, table_name) t
 where last_load_hour + 1 <> 0""", "fx_load_log"))
def q_next_interval_hourly(spark, sf):
    """Next hourly batch per table."""
    return RL.next_interval(_log(spark, sf), "hourly", 1)


@register("next_interval_daily", with_fixtures(f"""
with {HOURS}
select database_name, table_name, last_load_hour, cast(null as varchar) as last_load_minute,
 last_load_hour + 24 as next_hour, cast(null as varchar) as next_minute,
 strftime(make_timestamp((last_load_hour + 24) * 3600 * 1000000), 'date=%Y-%m-%d') as batch from done""",
                                               "fx_load_log"))
def q_next_interval_daily(spark, sf):
    """Next daily batch per table."""
    return RL.next_interval(_log(spark, sf), "daily", 24)


@register("next_interval_minutes", with_fixtures(f"""
select database_name, table_name, last_load_hour, last_load_minute,
 cast(case when strftime(strptime(last_load_minute, '%Y%m%d%H%M') + interval 15 minute, '%M') = '00'
      then last_load_hour + 1 else last_load_hour end as bigint) as next_hour,
 strftime(strptime(last_load_minute, '%Y%m%d%H%M') + interval 15 minute, '%Y%m%d%H%M') as next_minute,
 strftime(strptime(last_load_minute, '%Y%m%d%H%M') + interval 15 minute, '%Y%m%d%H%M') as batch
 from ({LAST_MINUTE}) m where last_load_minute is not null""", "fx_load_log"))
def q_next_interval_minutes(spark, sf):
    """H4/H5: next 15-minute batch per table, literal hour carry."""
    return RL.next_interval(_log(spark, sf), "minutes", 15)


@register("table_status", with_fixtures(f"""
with {HOURS}
select d.database_name, d.table_name, d.last_load_hour, m.last_load_minute, n.next_load_hour,
 r.next_realtime_hour, d.max_sync_hour
 from done d join ({LAST_MINUTE}) m using (database_name, table_name)
 join ({NEXT_LOAD}) n using (database_name, table_name)
 join ({NEXT_REALTIME}) r using (database_name, table_name)""", "fx_load_log"))
def q_table_status(spark, sf):
    """Every table's load status from one pass over the log."""
    return RL.table_status(_log(spark, sf))
