"""Control-table fixtures derived from the TESTDATA tables (FIXTURES.md §3).

The reference ships no data, so its control tables (load logs, registry,
manifests ...) are *derived* from the given tables by SQL, the same text for
Spark and for the DuckDB oracle after four macros are expanded.  Each fixture
is a full-table derivation: it grows with the input.

Template syntax: ``@T(name)`` is a base table; ``@TS'x'``, ``@HOUR(x)``,
``@HTS(h)``, ``@MIN(x)`` are the time macros of FIXTURES.md.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

FIXTURE_SQL: dict[str, str] = {
    "fx_load_log": """
select event_id as log_id, concat('db', cast(user_id % 2 as string)) as database_name, event_type as table_name,
 case when event_id % 3 = 1 and ts < @TS'2024-01-25 00:00:00' then 'LOAD'
      when event_id % 3 = 0 and ts < @TS'2024-01-28 00:00:00' then 'TRANSFER' else 'S3Sync' end as process_name,
 @HOUR(ts) as processed_utc_hour,
 case cast(floor(event_id / 3) as bigint) % 5 when 0 then 'STARTED' when 1 then 'FAILED' else 'COMPLETED' end as status,
 'test' as platform, @MIN(ts) as process_minute from @T(events)""",
    "fx_uploads": """
select @HTS(@HOUR(ts)) as load_hour,
 case when event_id % 97 = 0 and ts > @TS'2024-01-26 00:00:00' then 'PROCESSING' else 'COMPLETED' end as status,
 case when event_id % 11 = 0 then 1 else 0 end as is_forced from @T(events)""",
    "fx_agg_log": """
select concat('host', cast(user_id % 3 as string)) as host_name, case when user_id % 2 = 0 and ts < @TS'2024-01-20 00:00:00' then 1 else 2 end as job_id,
 @HOUR(ts) as processed_utc_hour, case event_id % 7 when 0 then 'RUNNING' when 1 then 'FAILED' else 'COMPLETED' end as status from @T(events)""",
    "fx_run_log": """
select event_id as run_id, cast(user_id % 10 as int) as job_id, ts as run_date,
 case event_id % 4 when 0 then 'started' when 1 then 'error' else 'completed' end as status, '' as error_message from @T(events)""",
    "fx_update_log": """
select event_id as log_id, event_type as table_name, ts as update_date,
 case when event_id % 4 = 0 then 'downloaded' else 'complete' end as uploaded_to_vertica from @T(events)""",
    "fx_dim_load_log": """
select cast(@MIN(ts) as bigint) as run_time, case event_id % 5 when 0 then 'FAILED' when 1 then 'STARTED' else 'COMPLETED' end as status,
 concat('p', cast(user_id % 3 as string)) as platform from @T(events)""",
    "fx_registry": """
select concat('dim_', cast(p_partkey as string)) as table_name, case when p_partkey % 11 = 0 then 'billing' else 'dimensions' end as database_name,
 case when p_partkey % 2 = 0 then 'config' else 'test_b' end as mysql_db, cast(p_partkey % 2 as int) as is_delta,
 case when p_partkey % 5 = 0 then 1 else 0 end as reload_table, case when p_partkey % 7 = 0 then 1 else 0 end as always_reload,
 case when p_partkey % 3 = 0 then concat('vw_dim_', cast(p_partkey as string)) else '' end as view_name,
 case when p_partkey % 13 = 0 then 0 else 1 end as is_loading_enabled, case when p_partkey % 4 = 1 then 'OFF' else 'LIVE' end as status,
 case when p_partkey % 4 = 0 then null else 'id,name,updated_at' end as mysql_keys,
 concat(p_brand, ',', p_type) as stats_keys, case when p_partkey % 6 = 0 then null else 'clicks,cost' end as measures from @T(part)""",
    # two thirds of the customers are in production; all of them are staged
    "fx_cust_prod": """
select * from @T(customer) where c_custkey % 3 <> 0""",
    "fx_cust_stg": """
select c_custkey, c_name, c_nationkey, c_acctbal + 100 as c_acctbal, c_mktsegment from @T(customer)""",
    # staging with several rows for every third key, told apart by updated_at
    "fx_cust_versions": """
select c_custkey, concat(c_name, '-old') as c_name, c_nationkey, c_acctbal, c_mktsegment, @TS'2024-01-01 00:00:00' as updated_at from @T(customer) where c_custkey % 3 = 0
union all
select c_custkey, c_name, c_nationkey, c_acctbal + 1, c_mktsegment, @TS'2024-06-01 00:00:00' as updated_at from @T(customer)""",
    # documents whose cells hold every pattern that cleansing rewrites
    "fx_cells": """
select doc_id, case when doc_id % 5 = 0 then concat(text, '|0000-00-00 00:00:00|') when doc_id % 5 = 1 then concat('NULL', chr(9), text, 'ANNULLED')
  when doc_id % 5 = 2 then concat(text, chr(13), '14294967295', chr(9)) else text end as text,
 case when doc_id % 4 = 0 then concat(lang, '|', chr(9)) else lang end as lang,
 case when doc_id % 6 = 0 then concat(source, chr(13)) else source end as source,
 case when doc_id % 7 = 0 then 4294967295 else n_chars end as n_chars from @T(documents)""",
    "fx_files": """
select distinct cast(event_id % 40 as int) as batch, concat('part-', cast(user_id % 50 as string), '.gz') as name from @T(events)""",
    "fx_manifest": """
select distinct cast(event_id % 40 as int) as batch, concat('part-', cast(case when event_id % 40 = 7 then user_id % 50 + 1 else user_id % 50 end as string), '.gz') as name
 from @T(events) where not (event_id % 40 = 3 and user_id % 5 = 0)""",
    "fx_servers": """
select n_nationkey as id, concat('host', cast(n_regionkey as string)) as host_name from @T(nation)""",
    "fx_summary": """
select s_name as table_name, s_nationkey as reporting_database_server_id,
 case when s_suppkey % 3 = 0 then null when s_suppkey % 3 = 1 then @TS'2024-01-10 00:00:00' else @TS'2024-02-10 00:00:00' end as latest_loaded_date from @T(supplier)""",
    # ---- extra fixtures (ours), all derived from the given tables ----
    # Dump-marker log keyed like fx_registry (dim_<partkey>), so the registry's
    # tables have watermarks: ship date as update time, returned lines
    # marked 'downloaded' (dump taken, load not finished).
    "fx_dim_update_log": """
select concat('dim_', cast(l_partkey as string)) as table_name, l_shipdate as update_date,
 case when l_returnflag = 'R' then 'downloaded' else 'complete' end as uploaded_to_vertica,
 l_orderkey * 8 + l_linenumber as log_id from @T(lineitem)""",
    # Tables whose dump failed in the first pass (retry list).
    "fx_errors": """
select distinct concat('dim_', cast(l_partkey as string)) as table_name from @T(lineitem)
 where l_returnflag = 'A' and l_quantity > 45""",
    # Source database dictionary: 50 views (vw_dim_<size>), a column per part,
    # type names cycling through the source type vocabulary.
    "fx_part_dictionary": """
select concat('vw_dim_', cast(p_size as string)) as table_name, concat('c', cast(p_partkey as string)) as column_name,
 element_at(array('bigint','varchar','enum','decimal','double','tinyint','int','datetime','NUMBER','VARCHAR2','time'),
            cast(p_partkey % 11 + 1 as int)) as data_type, p_partkey as ordinal from @T(part)""",
    # Columns a dump asks for, per table, in the requested order.
    "fx_wanted_columns": """
select concat('vw_dim_', cast(p_size as string)) as table_name, concat('c', cast(p_partkey as string)) as column_name,
 cast(round(p_retailprice * 100) as bigint) * 10000 + p_partkey as pos from @T(part)""",
    # Table-spec column entries (schema document B, flattened): KEY entries from
    # stats_keys, METRIC entries from measures, an OTHER entry per table;
    # positions interleave so that KEY-before-METRIC ordering matters.
    "fx_part_spec_columns": """
select table_name, 2 * k + 1 as pos, 'KEY' as field_type, item as output_name from (
  select concat('dim_', cast(p_partkey as string)) as table_name, 0 as k, p_brand as item from @T(part)
  union all select concat('dim_', cast(p_partkey as string)), 1, p_type from @T(part)) s
union all
select concat('dim_', cast(p_partkey as string)), 0, 'METRIC', 'clicks' from @T(part) where p_partkey % 6 <> 0
union all
select concat('dim_', cast(p_partkey as string)), 2, 'METRIC', 'cost' from @T(part) where p_partkey % 6 <> 0
union all
select concat('dim_', cast(p_partkey as string)), 4, 'OTHER', concat('junk', cast(p_size as string)) from @T(part)""",
    # Per-table dump runs of one wrapper run: start/end and outcome.
    "fx_table_runs": """
select concat(event_type, '_', cast(user_id as string)) as table_name,
 case when user_id % 9 = 0 then 'failed' else 'success' end as status,
 ts as start_time, ts + cast(floor(value * 10) as bigint) * INTERVAL 1 SECOND as end_time from @T(events)""",
    # Dependent batch of each batch (the dimension a fact batch needs first).
    "fx_batch_deps": """
select distinct cast(event_id % 40 as int) as batch, cast((event_id + 1) % 40 as int) as dep_batch from @T(events)""",
}

BASE_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "documents", "embeddings", "pages", "benchmark", "labels",
               "conversations"]


# @HTS(...) with one level of nested parentheses inside (e.g. @HTS(@HOUR(ts))).
_HTS = r"@HTS\(((?:[^()]|\([^()]*\))*)\)"


def _macros(sql: str, dialect: str) -> str:
    if dialect == "spark":
        sql = re.sub(r"@TS'([^']*)'", r"TIMESTAMP_NTZ'\1'", sql)
        sql = re.sub(_HTS, r"timestampadd(HOUR, cast(\1 as int), TIMESTAMP_NTZ'1970-01-01 00:00:00')", sql)
        sql = re.sub(r"@HOUR\(([^()]*)\)",
                     r"timestampdiff(HOUR, TIMESTAMP_NTZ'1970-01-01 00:00:00', \1)", sql)
        sql = re.sub(r"@MIN\(([^()]*)\)", r"date_format(\1,'yyyyMMddHHmm')", sql)
        sql = sql.replace("* INTERVAL 1 SECOND", "* INTERVAL '1' SECOND")
    else:
        sql = re.sub(r"@TS'([^']*)'", r"TIMESTAMP'\1'", sql)
        sql = re.sub(_HTS, r"make_timestamp((\1)*3600*1000000)", sql)
        sql = re.sub(r"@HOUR\(([^()]*)\)", r"cast(floor(epoch(\1)/3600) as bigint)", sql)
        sql = re.sub(r"@MIN\(([^()]*)\)", r"strftime(\1,'%Y%m%d%H%M')", sql)
        sql = sql.replace("element_at(array(", "list_extract(list_value(")
    return sql


def render(name: str, dialect: str, sf_dir: str | None = None) -> str:
    """Fixture SQL for ``spark`` (tables read by path) or ``duckdb`` (views)."""
    sql = _macros(FIXTURE_SQL[name], dialect)
    if dialect == "spark":
        return re.sub(r"@T\((\w+)\)", lambda m: f"parquet.`{sf_dir}/{m.group(1)}.parquet`", sql)
    return re.sub(r"@T\((\w+)\)", r"\1", sql)


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A fixture as a lazy DataFrame over the parquet tables in ``sf_dir``."""
    return spark.sql(render(name, "spark", sf_dir))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A base TESTDATA table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_fixtures(sql: str, *names: str) -> str:
    """DuckDB oracle text: ``WITH`` the named fixtures, then ``sql``."""
    if not names:
        return sql
    ctes = ",\n".join(f"{n} AS ({render(n, 'duckdb')})" for n in names)
    body = sql.lstrip()
    if body[:5].lower() == "with ":
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{sql}"
