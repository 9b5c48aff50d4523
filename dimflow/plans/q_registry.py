"""Queries for the registry / schema-document operators (S4, S10, S11, S15,
P1, J5, A1, A2, A4, U1, F3, F4, L16)."""

from __future__ import annotations

from pyspark.sql import functions as F

from dimflow.operators import registry as R
from dimflow.operators import runlog as RL
from dimflow.plans.catalog import register
from dimflow.plans.fixtures import fixture, with_fixtures

WORK = "table_name, mysql_db, is_delta, reload_table, view_name, always_reload"
ENABLED = f"select {WORK} from fx_registry where database_name = 'dimensions' and is_loading_enabled = 1"


def _reg(spark, sf):
    return fixture(spark, sf, "fx_registry")


@register("enabled_tables", with_fixtures(ENABLED, "fx_registry"))
def q_enabled_tables(spark, sf):
    """Primary-version work list."""
    return R.enabled_tables(_reg(spark, sf))


@register("enabled_tables_live", with_fixtures(
    f"select {WORK} from fx_registry where database_name = 'dimensions' and status = 'LIVE'", "fx_registry"))
def q_enabled_tables_live(spark, sf):
    """Other versions' work list (status LIVE)."""
    return R.enabled_tables(_reg(spark, sf), version="other")


@register("table_options", with_fixtures(
    "select mysql_db, is_delta, reload_table, view_name, always_reload from fx_registry where table_name = 'dim_42'",
    "fx_registry"))
def q_table_options(spark, sf):
    """One table's options."""
    return R.table_options(_reg(spark, sf), "dim_42")


@register("tables_from_config", with_fixtures("""
select table_name, 'config' as mysql_db, 0 as is_delta, 1 as reload_table, '' as view_name, 1 as always_reload
 from fx_registry where database_name = 'billing'""", "fx_registry"))
def q_tables_from_config(spark, sf):
    """The tables of an ini schema file (here: the billing tables) as the work list."""
    sections = _reg(spark, sf).where(F.col("database_name") == "billing").select("table_name")
    return R.tables_from_config(sections, "config")


@register("retry_tables", with_fixtures(
    f"select * from ({ENABLED}) w where table_name in (select table_name from fx_errors)",
    "fx_registry", "fx_errors"))
def q_retry_tables(spark, sf):
    """the second pass only re-runs the failed tables."""
    return R.retry_tables(R.enabled_tables(_reg(spark, sf)), fixture(spark, sf, "fx_errors"))


@register("only_table", with_fixtures(f"select * from ({ENABLED}) w where table_name = 'dim_14'",
                                      "fx_registry"))
def q_only_table(spark, sf):
    """one table named on the command line."""
    return R.only_table(R.enabled_tables(_reg(spark, sf)), "dim_14")


@register("extract_columns", with_fixtures("""
select table_name, unnest(generate_series(0, len(string_split(coalesce(mysql_keys, stats_keys), ',')) - 1)) as pos,
 unnest(string_split(coalesce(mysql_keys, stats_keys), ',')) as column_name from fx_registry""", "fx_registry"))
def q_extract_columns(spark, sf):
    """Dump column list per table, mysql_keys else stats_keys."""
    return R.extract_columns(_reg(spark, sf)).withColumn("pos", F.col("pos").cast("bigint"))


@register("explode_list", with_fixtures("""
select stats_keys, cast(unnest(generate_series(1, len(string_split(stats_keys, ',')))) as bigint) as n,
 unnest(string_split(stats_keys, ',')) as item
 from (select distinct stats_keys from fx_registry where is_loading_enabled = 1) t""", "fx_registry"))
def q_explode_list(spark, sf):
    """Comma lists split into numbered items (no number-table cross join)."""
    src = _reg(spark, sf).where(F.col("is_loading_enabled") == 1).select("stats_keys").distinct()
    return R.explode_list(src, "stats_keys").withColumn("n", F.col("n").cast("bigint"))


_ITEMS = """(select string_agg(distinct item, ',' order by item) from (
   select unnest(string_split({c}, ',')) as item from (select distinct {c} from fx_registry where is_loading_enabled = 1) t) u)"""


@register("distinct_items", with_fixtures(
    f"select {_ITEMS.format(c='stats_keys')} as stats_keys, {_ITEMS.format(c='measures')} as measures",
    "fx_registry"))
def q_distinct_items(spark, sf):
    """A1: GROUP_CONCAT(DISTINCT item) of keys and of measures."""
    return R.distinct_items_df(_reg(spark, sf), ["stats_keys", "measures"])


_ALL_KEYS = f"""select 'all_keys_and_measures' as table_name, coalesce({_ITEMS.format(c='stats_keys')}, '') as stats_keys,
 coalesce({_ITEMS.format(c='measures')}, '') as measures, '' as database_name"""


@register("all_keys_row", with_fixtures(_ALL_KEYS, "fx_registry"))
def q_all_keys_row(spark, sf):
    """A2: the all_keys_and_measures summary row."""
    return R.all_keys_row(_reg(spark, sf))


@register("distinct_registry", with_fixtures("""
select distinct table_name, stats_keys, measures, database_name from fx_registry where is_loading_enabled = 1""",
                                             "fx_registry"))
def q_distinct_registry(spark, sf):
    """A4: SELECT DISTINCT of enabled registry rows."""
    return R.distinct_registry(_reg(spark, sf))


@register("schema_doc_rows", with_fixtures(f"""
select table_name, stats_keys, coalesce(measures, '') as measures, database_name from (
  {_ALL_KEYS}
  union
  select distinct table_name, stats_keys, measures, database_name from fx_registry where is_loading_enabled = 1) a
 order by table_name desc""", "fx_registry"))
def q_schema_doc_rows(spark, sf):
    """U1 + T2: rows of schema document A."""
    return R.schema_doc_rows(_reg(spark, sf))


WATERMARKS = """select table_name, date_trunc('second', max(update_date)) as watermark
 from fx_dim_update_log where uploaded_to_vertica = 'complete' group by table_name"""


@register("watermarks", with_fixtures(WATERMARKS, "fx_dim_update_log"))
def q_watermarks(spark, sf):
    """Last successful dump per table, cut to seconds."""
    return RL.watermarks(fixture(spark, sf, "fx_dim_update_log"))


@register("extract_mode", with_fixtures(f"""
select r.table_name, r.mysql_db, r.is_delta, r.reload_table, r.view_name, r.always_reload,
 case when r.is_delta <> 0 then wm.watermark end as watermark,
 case when r.is_delta = 0 then 'full' when wm.watermark is null then 'full'
      when r.reload_table = 1 or r.always_reload = 1 then 'full' else 'delta' end as mode,
 case when r.view_name <> '' then r.view_name else r.table_name end as source_name,
 r.is_delta <> 0 as needs_marker,
 case when r.always_reload = 1 then 1 else r.reload_table end as reload_flag
 from ({ENABLED}) r left join ({WATERMARKS}) wm on wm.table_name = r.table_name""",
                                        "fx_registry", "fx_dim_update_log"))
def q_extract_mode(spark, sf):
    """Full or delta dump per enabled table, from its watermark and flags."""
    work = R.enabled_tables(_reg(spark, sf))
    return R.extract_mode(work, RL.watermarks(fixture(spark, sf, "fx_dim_update_log")))
