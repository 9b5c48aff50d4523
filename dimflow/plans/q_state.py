"""Queries for control-table updates (M2-M6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from dimflow.operators import registry as R
from dimflow.operators import state as S
from dimflow.plans.catalog import register
from dimflow.plans.fixtures import fixture, with_fixtures

REG_COLS = ("table_name, database_name, mysql_db, is_delta, {reload} as reload_table, always_reload, view_name, "
            "is_loading_enabled, status, mysql_keys, stats_keys, measures")


@register("mark_complete", with_fixtures("""
select log_id, table_name, update_date,
 case when rn = 1 then 'complete' else uploaded_to_vertica end as uploaded_to_vertica
 from (select *, case when uploaded_to_vertica = 'downloaded' then row_number() over
        (partition by table_name, uploaded_to_vertica order by update_date desc, log_id desc) end as rn
       from fx_update_log) t""", "fx_update_log"))
def q_mark_complete(spark, sf):
    """M2: each table's newest 'downloaded' marker becomes 'complete'."""
    return S.mark_complete(fixture(spark, sf, "fx_update_log"))


@register("mark_downloaded", with_fixtures("""
select table_name, update_date, uploaded_to_vertica, log_id from fx_dim_update_log
union all
select table_name, TIMESTAMP '2024-02-01 00:00:00', 'downloaded', cast(null as bigint) from fx_registry
 where database_name = 'dimensions' and is_loading_enabled = 1 and is_delta <> 0""",
                                           "fx_dim_update_log", "fx_registry"))
def q_mark_downloaded(spark, sf):
    """M3: markers for every delta table before its scan."""
    plan = R.extract_mode(R.enabled_tables(fixture(spark, sf, "fx_registry")), None)
    tables = plan.where("needs_marker").select("table_name")
    return S.mark_downloaded(fixture(spark, sf, "fx_dim_update_log"), tables, "2024-02-01 00:00:00")


_P1_FAILED = "(select min(run_time) from fx_dim_load_log where platform = 'p1' and status = 'FAILED')"


@register("set_load_status", with_fixtures(f"""
select run_time, case when run_time = {_P1_FAILED} and platform = 'p1' then 'COMPLETED' else status end as status,
 platform from fx_dim_load_log""", "fx_dim_load_log"))
def q_set_load_status(spark, sf):
    """M4 (update): the retried run of p1 is marked COMPLETED."""
    log = fixture(spark, sf, "fx_dim_load_log")
    rt = log.where((F.col("platform") == "p1") & (F.col("status") == "FAILED")).agg(F.min("run_time")).scalar()
    return S.set_load_status(log, rt, "p1", "COMPLETED")


@register("set_load_status_insert", with_fixtures("""
select run_time, status, platform from fx_dim_load_log
union all select cast(202402010000 as bigint), 'STARTED', 'p9'""", "fx_dim_load_log"))
def q_set_load_status_insert(spark, sf):
    """M4 (insert): a new run is logged as STARTED."""
    return S.set_load_status(fixture(spark, sf, "fx_dim_load_log"), 202402010000, "p9", "STARTED",
                             insert=True)


@register("mark_loaded", with_fixtures("""
select table_name, database_name, mysql_db, is_delta,
 case when hit then 0 else reload_table end as reload_table, always_reload, view_name, is_loading_enabled, status,
 mysql_keys, stats_keys, measures,
 case when hit then TIMESTAMP '2024-02-01 00:00:00' else cast(null as timestamp) end as latest_loaded_date
from (select r.*, r.table_name in (select table_name from fx_registry where database_name = 'dimensions'
        and is_loading_enabled = 1 and reload_table = 1) as hit from fx_registry r) t""", "fx_registry"))
def q_mark_loaded(spark, sf):
    """M5: reloaded tables get latest_loaded_date = now and reload_table = 0."""
    reg = fixture(spark, sf, "fx_registry")
    loaded = R.enabled_tables(reg).where(F.col("reload_table") == 1)
    return S.mark_loaded(reg, loaded, "2024-02-01 00:00:00")


@register("request_reload", with_fixtures("""
select table_name, database_name, mysql_db, is_delta,
 case when table_name in (select table_name from fx_errors) then 1 else reload_table end as reload_table,
 always_reload, view_name, is_loading_enabled, status, mysql_keys, stats_keys, measures from fx_registry""",
                                          "fx_registry", "fx_errors"))
def q_request_reload(spark, sf):
    """M6: failed tables are flagged for a full reload."""
    return S.request_reload(fixture(spark, sf, "fx_registry"), fixture(spark, sf, "fx_errors"))
