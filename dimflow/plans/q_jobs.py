"""Queries through whole jobs and documents.

Each writes through the job or sink and returns what a reader finds.
"""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from dimflow.functions import timeutil
from dimflow.operators import quality as Q
from dimflow.operators import registry as R
from dimflow.operators import state as ST
from dimflow.operators.load import assign_identity
from dimflow.plans import jobs as J
from dimflow.plans.catalog import register
from dimflow.plans.fixtures import fixture, table, with_fixtures
from dimflow.plans.q_load import CUST_COLS
from dimflow.session import scratch_path
from dimflow.sinks import files as K
from dimflow.sinks import fs
from dimflow.sinks import tables as TB
from dimflow.sources import files as S
from dimflow.sources import spec_lines as SL
from dimflow.sources import specs as SP

HOUR = 473352
CUSTOMER = CUST_COLS.split(", ")


def _spec(spark, base, *tables) -> str:
    return fs.write_text_file(spark, f"{base}/schema.json", json.dumps(
        {"version": "1", "groups": [{"tables": list(tables)}]}))


def _entry(name, columns, **more) -> dict:
    return {"name": name, "db_name": "dim", "sql": "select", **more,
            "columns": [{"field_type": "KEY", "output_name": c} for c in columns]}


def _customer(operation="Insert", **dimension) -> dict:
    return {"db_name_stg": "stg", "dimension": {
        "operation": operation, "operation_column": "c_custkey", **dimension}}


INSERTED = f"""
select {CUST_COLS} from fx_cust_prod
union all
select {CUST_COLS} from fx_cust_stg s
 where not exists (select 1 from fx_cust_prod p where p.c_custkey = s.c_custkey)"""


@register("load_job_replay", with_fixtures(INSERTED, "fx_cust_prod", "fx_cust_stg"))
def q_load_job_replay(spark, sf):
    """Two dumps of one hour, each loaded twice in turn, give what one
    insert of all rows gives."""
    base = scratch_path(spark, "replay")
    prod = f"{base}/wh/customer"
    TB.publish(fixture(spark, sf, "fx_cust_prod"), prod)
    stg = fixture(spark, sf, "fx_cust_stg")
    spec = _spec(spark, base, _entry("customer", CUSTOMER, **_customer()))
    dumps = [K.write_dump(stg.where(F.col("c_custkey") % 2 == k), f"{base}/dumps/{k}", "2024010100",
                          "customer", partitions=2) for k in (0, 1)]
    for d in (dumps[0], dumps[0], dumps[1], dumps[0]):
        J.load(spark, "customer", d, spec, prod, stg_path=f"{base}/wh/stg/customer", hour=HOUR)
    return TB.read_table(spark, prod)


@register("load_job_two_sources", """
select c_custkey, c_name, c_nationkey from customer
union all
select s_suppkey, s_name, s_nationkey from supplier""")
def q_load_job_two_sources(spark, sf):
    """Two sources routed into one table in one hour, one of them twice."""
    base = scratch_path(spark, "sources")
    cols = ["c_custkey", "c_name", "c_nationkey"]
    sources = {"customer": table(spark, sf, "customer").select(*cols),
               "supplier": table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey")
               .toDF(*cols)}
    TB.publish(sources["customer"].where("false"), f"{base}/wh/partner")
    spec = _spec(spark, base, *[_entry(n, cols, load_table="partner") for n in sources])
    for n in ("customer", "supplier", "customer"):
        d = f"{base}/dumps/2024010100/{n}"
        if not fs.exists(spark, d):
            K.write_dump(sources[n], f"{base}/dumps", "2024010100", n, partitions=2)
        J.load(spark, n, d, spec, f"{base}/wh/{n}", hour=HOUR, platform="warehouse")
    return TB.read_table(spark, f"{base}/wh/partner")


@register("load_job_minutes", "select event_id, user_id, event_type from events")
def q_load_job_minutes(spark, sf):
    """Q8 by minute: four minute batches of one hour all load, once each."""
    base = scratch_path(spark, "minutes")
    cols = ["event_id", "user_id", "event_type"]
    ev = table(spark, sf, "events").select(*cols)
    TB.publish(ev.where("false"), f"{base}/wh/events")
    spec = _spec(spark, base, _entry("events", cols))
    for k in (0, 1, 2, 3, 3, 0):
        minute = f"2024010100{15 * k:02d}"
        d = f"{base}/dumps/{minute}/events"
        if not fs.exists(spark, d):
            K.write_dump(ev.where(F.col("event_id") % 4 == k), f"{base}/dumps", minute, "events",
                         partitions=2)
        J.load(spark, "events", d, spec, f"{base}/wh/events", log_path=f"{base}/log", hour=HOUR,
               minute=minute, platform="warehouse")
    return TB.read_table(spark, f"{base}/wh/events")


@register("event_log", with_fixtures("""
select database_name, table_name, process_name, processed_utc_hour, status, platform, process_minute
 from fx_load_log""", "fx_load_log"))
def q_event_log(spark, sf):
    """Every event of the log appended, a batch of events a process, the
    last one replayed."""
    path = f"{scratch_path(spark, 'events')}/log"
    log = fixture(spark, sf, "fx_load_log")
    for p in ("LOAD", "TRANSFER", "S3Sync", "S3Sync"):
        TB.append_events(log.where(F.col("process_name") == p), path, p, TB.TRF_LOG_SCHEMA)
    return TB.read_table(spark, path, TB.TRF_LOG_SCHEMA)


@register("load_job_merge_duplicates", """
select c_custkey, c_name, c_nationkey, c_acctbal + 1 as c_acctbal, c_mktsegment,
 TIMESTAMP '2024-06-01 00:00:00' as updated_at from customer""")
def q_load_job_merge_duplicates(spark, sf):
    """X1 in E2: several staging rows a key, the one updated last wins."""
    base = scratch_path(spark, "merge")
    prod = f"{base}/wh/customer"
    rows = fixture(spark, sf, "fx_cust_versions")
    TB.publish(fixture(spark, sf, "fx_cust_prod").withColumn(
        "updated_at", F.expr("TIMESTAMP_NTZ'2023-01-01 00:00:00'")), prod)
    d = K.write_dump(rows, f"{base}/dumps", "2024010100", "customer", partitions=4)
    spec = _spec(spark, base, _entry("customer", [*CUSTOMER, "updated_at"], **_customer("Merge")))
    J.load(spark, "customer", d, spec, prod, stg_path=f"{base}/wh/stg/customer", hour=HOUR)
    return TB.read_table(spark, prod)


def _typed(spark, sf):
    base = scratch_path(spark, "typed")
    prod = f"{base}/wh/customer"
    stg = fixture(spark, sf, "fx_cust_stg")
    TB.publish(fixture(spark, sf, "fx_cust_prod"), prod)
    bad = F.when(F.col("c_custkey") % 10 == 0, F.concat(F.lit("n"), "c_nationkey"))
    rows = stg.withColumn("c_nationkey", F.coalesce(bad, F.col("c_nationkey").cast("string")))
    d = K.write_dump(rows, f"{base}/dumps", "2024010100", "customer", partitions=2)
    spec = _spec(spark, base, _entry("customer", CUSTOMER, write_rejects=True, **_customer()))
    J.load(spark, "customer", d, spec, prod, stg_path=f"{base}/wh/stg/customer",
           reject_path=f"{base}/rejects", hour=HOUR)
    return prod, f"{base}/rejects"


@register("load_job_typed", with_fixtures(f"""
select {CUST_COLS} from fx_cust_prod
union all
select {CUST_COLS} from fx_cust_stg s where c_custkey % 10 <> 0
 and not exists (select 1 from fx_cust_prod p where p.c_custkey = s.c_custkey)""",
                                          "fx_cust_prod", "fx_cust_stg"))
def q_load_job_typed(spark, sf):
    """E2 without a sidecar into a typed table: cells take the table's types."""
    return TB.read_table(spark, _typed(spark, sf)[0])


@register("load_job_rejects", with_fixtures("""
select 'bad value for c_nationkey' as rejected_reason, count(*) as n from fx_cust_stg
 where c_custkey % 10 = 0""", "fx_cust_stg"))
def q_load_job_rejects(spark, sf):
    """K8: rows whose cells do not cast to the table's types, by reason."""
    return TB.read_table(spark, _typed(spark, sf)[1]).groupBy("rejected_reason").agg(
        F.count("*").alias("n"))


@register("documents_round_trip", "select * from documents")
def q_documents_round_trip(spark, sf):
    """K1 -> S6 over whole documents: line breaks, tabs and backslashes come
    back as they were."""
    docs = table(spark, sf, "documents")
    path = K.write_dump(docs, scratch_path(spark, "docs"), "b", "documents", sep="\x01", partitions=8)
    return Q.split_rejects(S.read_delimited(spark, path, docs.schema, "\x01"))[0]


@register("assign_identity_orders", """
select o_orderkey, row_number() over (order by o_orderkey) as dim_id from orders""")
def q_assign_identity_orders(spark, sf):
    """P5 over all orders, whatever exchanges are reused."""
    return assign_identity(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", "dim_id")


def _lists(spark, sf):
    """Comma-separated lists of 2,000 order keys."""
    o = table(spark, sf, "orders").select(F.expr("o_orderkey div 2000").alias("grp"), "o_orderkey")
    return o.groupBy("grp").agg(F.array_join(F.transform(F.sort_array(F.collect_list("o_orderkey")),
                                                         lambda x: x.cast("string")), ",").alias("keys"))


@register("explode_list_long", """
select cast(o_orderkey // 2000 as bigint) as grp,
 row_number() over (partition by o_orderkey // 2000 order by o_orderkey) as n,
 cast(o_orderkey as varchar) as item from orders""")
def q_explode_list_long(spark, sf):
    """Lists of thousands of items lose none."""
    return R.explode_list(_lists(spark, sf), "keys", keep=["grp"]).withColumn(
        "n", F.col("n").cast("bigint"))


@register("distinct_items_long", """
select distinct 'stats_keys' as list_name, cast(o_orderkey as varchar) as item from orders""")
def q_distinct_items_long(spark, sf):
    """A1 as rows, over lists of thousands of items, each list twice."""
    lists = _lists(spark, sf).select(F.col("keys").alias("stats_keys"),
                                     F.lit(1).alias("is_loading_enabled"))
    return R.distinct_items(lists.unionAll(lists), "stats_keys")


@register("spec_document", """
select 'dim_' || p_partkey as name, 'id_' || p_partkey || ',name'
 || case when p_partkey % 10 = 0 then ',extra_' || p_partkey else '' end as columns from part""")
def q_spec_document(spark, sf):
    """Every part as a table of one group, and every tenth again in a
    second, a table a line; column order follows the groups."""
    path = SL.write_spec_lines(_part_specs(spark, sf), f"{scratch_path(spark, 'spec')}/schema")
    return SL.table_specs(SL.read_lines(spark, path)).select("name", "columns")


def _part_specs(spark, sf):
    """(group, index, spec): JSON of a table spec a part, and of every tenth again."""
    def entries(df, group, columns):
        cols = F.array(*[F.struct(F.lit("KEY").alias("field_type"), c.alias("output_name"))
                         for c in columns])
        kept = F.when(F.col("p_partkey") % 3 == 0, F.struct(
            F.col("p_size").alias("days"), F.col("p_brand").alias("tier")))
        return df.select(F.lit(group).alias("group"), F.col("p_partkey").alias("index"), F.to_json(
            F.struct(F.concat(F.lit("dim_"), "p_partkey").alias("name"),
                     F.lit("select").alias("sql"), cols.alias("columns"),
                     kept.alias("retention"))).alias("spec"))
    part = table(spark, sf, "part").select("p_partkey", "p_size", "p_brand")
    return entries(part, 0, [F.concat(F.lit("id_"), "p_partkey"), F.lit("name")]).unionAll(
        entries(part.where("p_partkey % 10 = 0"), 1, [F.concat(F.lit("extra_"), "p_partkey")]))


@register("spec_options", """
select 'dim_' || p_partkey as name, cast(g as bigint) as "group", 'retention' as option,
 '{"days":' || p_size || ',"tier":"' || p_brand || '"}' as value, cast(p_size as bigint) as days
 from part, (values (0), (1)) as v(g)
 where p_partkey % 3 = 0 and (g = 0 or p_partkey % 10 = 0)""")
def q_spec_options(spark, sf):
    """Options that no typed field names are kept, as VARIANT."""
    path = SL.write_spec_lines(_part_specs(spark, sf), f"{scratch_path(spark, 'spec')}/schema")
    return SL.other_options(SL.read_lines(spark, path)).select(
        "name", "group", "option", F.to_json("value").alias("value"),
        F.try_variant_get("value", "$.days", "bigint").alias("days"))


@register("spec_bad_lines", """
select p_partkey as index, p_partkey % 4 = 0 as has_json from part where p_partkey % 4 in (0, 1)""")
def q_spec_bad_lines(spark, sf):
    """Lines cut short and lines without a table name are rejects, not specs."""
    part = table(spark, sf, "part").select("p_partkey")
    line = F.concat(F.lit('{"version":"1","group":0,"index":'), "p_partkey", F.lit(',"table":{"'),
                    F.when(F.col("p_partkey") % 4 == 0, "nickname").otherwise("name"),
                    F.lit('":"t"'), F.when(F.col("p_partkey") % 4 == 1, "").otherwise("}}"))
    path = f"{scratch_path(spark, 'spec')}/schema"
    part.select(line.alias("value")).write.text(path)
    return SL.bad_lines(SL.read_lines(spark, path)).select(
        F.regexp_extract("line", '"index":([0-9]+)', 1).cast("bigint").alias("index"), "has_json")


@register("spec_fallback", """
select 'batch' as used, count(*) as n from part union all
select 'local', count(*) from part where p_partkey % 10 = 0 union all
select 'missing', count(*) from part where p_partkey % 10 = 0""")
def q_spec_fallback(spark, sf):
    """A load takes the batch's spec, the local one when asked, and the
    local one where the batch has none."""
    base = scratch_path(spark, "specs")
    specs = _part_specs(spark, sf)
    batch = SL.write_spec_lines(specs.where("group = 0"), f"{base}/batch/schema")
    local = SL.write_spec_lines(specs.where("group = 1"), f"{base}/local/schema")
    used = {"batch": SP.resolve_spec(spark, batch, local),
            "local": SP.resolve_spec(spark, batch, local, prefer_local=True),
            "missing": SP.resolve_spec(spark, f"{base}/none/schema", local)}
    out = None
    for name, path in used.items():
        n = SL.table_specs(SL.read_lines(spark, path)).agg(F.count("*").alias("n")).select(
            F.lit(name).alias("used"), "n")
        out = n if out is None else out.unionAll(n)
    return out


@register("max_hour_file", """
select max(date_diff('hour', timestamp '1970-01-01', cast(o_orderdate as timestamp))) as hour
 from orders""")
def q_max_hour_file(spark, sf):
    """K5: the newest hour of the data, written as the one-value file and read back."""
    hour = table(spark, sf, "orders").agg(F.max(timeutil.utc_hour(F.col("o_orderdate")))).first()[0]
    path = K.write_max_hour(spark, f"{scratch_path(spark, 'hour')}/data_max_utc_hour", hour)
    return spark.read.text(path).select(F.col("value").cast("bigint").alias("hour"))


@register("schema_doc_round_trip", with_fixtures("""
with listed as (
 select table_name, stats_keys, coalesce(measures, '') as metrics, database_name from fx_registry
  where is_loading_enabled = 1
 union all
 select 'all_keys_and_measures',
  (select string_agg(i, ',' order by i) from (select distinct unnest(string_split(stats_keys, ',')) as i
    from fx_registry where is_loading_enabled = 1)),
  coalesce((select string_agg(i, ',' order by i) from (select distinct unnest(string_split(measures, ',')) as i
    from fx_registry where is_loading_enabled = 1)), ''), '')
select distinct table_name as name, array_to_string(string_split(stats_keys, ','), ';') as keys, metrics,
 database_name as db_name from listed""", "fx_registry"))
def q_schema_doc_round_trip(spark, sf):
    """K4 -> S12: the schema document, a table a line, written and read back."""
    rows = R.schema_doc_rows(fixture(spark, sf, "fx_registry"))
    path = SL.write_registry_lines(rows, f"{scratch_path(spark, 'doc')}/schema")
    return SL.registry_specs(SL.read_lines(spark, path)).withColumn(
        "keys", F.array_join("keys", ";"))


@register("manifest_files", """
select c_nationkey as batch, cast(c_nationkey = 3 as bigint)
   + if(c_nationkey = 7, count(distinct c_mktsegment), 0) as n_extra,
 cast(c_nationkey = 5 as bigint) as n_missing, c_nationkey not in (3, 5, 7) as complete
 from customer group by c_nationkey""")
def q_manifest_files(spark, sf):
    """A folder a nation with sub-folders of files; the manifest of 3
    leaves out a file, that of 5 lists one too many, that of 7 is broken."""
    base = scratch_path(spark, "manifests")
    (table(spark, sf, "customer").repartition("c_nationkey", "c_mktsegment")
     .write.partitionBy("c_nationkey", "c_mktsegment").parquet(f"{base}/data"))
    batch = F.regexp_extract("path", "c_nationkey=([0-9]+)/", 1).cast("int")
    files = S.list_batch(spark, f"{base}/data").select(
        batch.alias("batch"), F.regexp_extract("path", "c_nationkey=[0-9]+/(.*)$", 1).alias("name"))
    entries = files.groupBy("batch").agg(F.sort_array(F.collect_list("name")).alias("all"))
    listed = (F.when(F.col("batch") == 3, F.slice("all", 2, F.size("all") - 1))
              .when(F.col("batch") == 5, F.array_append("all", "x/ghost.gz")).otherwise(F.col("all")))
    text = F.when(F.col("batch") == 7, "{broken").otherwise(
        F.to_json(F.struct(listed.alias("entries"))))
    entries.select("batch", text.alias("value")).write.partitionBy("batch").text(f"{base}/lists")
    found, batches = S.read_manifests(spark, f"{base}/lists/*/part-*")
    number = F.regexp_extract("batch", "batch=([0-9]+)", 1).cast("int")
    return Q.manifest_check(files, found.select(number.alias("batch"), F.col("url").alias("name")),
                            batches.where("valid").select(number.alias("batch")))


@register("ready_by_marker", """
select c_nationkey as batch, c_nationkey % 2 = 0 or c_nationkey % 3 = 0 as ready
 from customer group by c_nationkey""")
def q_ready_by_marker(spark, sf):
    """Q1/Q3: a batch without a complete manifest is ready by its marker."""
    c = table(spark, sf, "customer").select("c_nationkey", F.concat(
        F.lit("part-"), "c_mktsegment").alias("part")).distinct()
    files = c.select(F.col("c_nationkey").alias("batch"), F.col("part").alias("name")).unionAll(
        c.where("c_nationkey % 2 = 0").select("c_nationkey", F.lit("_SUCCESS")).distinct())
    listed = c.where("c_nationkey % 3 = 0").select(F.col("c_nationkey").alias("batch"),
                                                   F.col("part").alias("name"))
    data = files.where("name <> '_SUCCESS'")
    return Q.ready_batches(Q.manifest_check(data, listed), None, Q.has_success(files))


@register("full_refresh", "select * from orders union all select * from orders where o_orderkey % 2 = 0")
def q_full_refresh(spark, sf):
    """A table published three times; staging emptied in between."""
    base = scratch_path(spark, "publish")
    n = table(spark, sf, "orders")
    TB.publish(n.where("false"), f"{base}/t")
    TB.load_staging(n, f"{base}/stg")
    TB.truncate(spark, f"{base}/stg", n.schema)
    TB.load_staging(n.where("o_orderkey % 2 = 0"), f"{base}/stg")
    TB.publish(n, f"{base}/t")
    now = TB.read_table(spark, f"{base}/t").unionAll(TB.read_table(spark, f"{base}/stg"))
    TB.publish(now, f"{base}/t")
    return TB.read_table(spark, f"{base}/t")


@register("load_gates", """
select 'empty' as gate, count(*) > 0 as stopped from lineitem where l_quantity < 0
union all select 'not empty', count(*) = 0 from lineitem where l_quantity > 0
union all select 'rejects', count(*) filter (where strpos(text, '|') > 0) > 3 from documents
union all select 'spec', count(*) filter (where p_partkey % 6 = 0) > 0 from part""")
def q_load_gates(spark, sf):
    """Which gates stop a load, over whole tables."""
    li = table(spark, sf, "lineitem")
    docs = table(spark, sf, "documents").select("doc_id", "text")
    path = K.write_dump(docs, scratch_path(spark, "gates"), "b", "documents", partitions=4)
    n_bad = Q.reject_count(S.read_delimited(spark, path, docs.schema)).first().rejected_rows
    spec = table(spark, sf, "part").select(
        "p_name", F.when(F.col("p_partkey") % 6 != 0, F.lit("a,b")).alias("columns"),
        F.lit(False).alias("is_dimension"), F.lit(None).cast("string").alias("operation_column")) \
        .withColumnRenamed("p_name", "name")

    def stopped(check) -> bool:
        try:
            check()
        except Q.LoadGateError:
            return True
        return False
    rows = [("empty", stopped(lambda: Q.assert_empty(li.where("l_quantity < 0")))),
            ("not empty", stopped(lambda: Q.assert_nonempty(li.where("l_quantity > 0")))),
            ("rejects", stopped(lambda: Q.check_rejects(n_bad, 3))),
            ("spec", not Q.validate_spec(spec).isEmpty())]
    return spark.createDataFrame(rows, "gate string, stopped boolean")


def _registry(spark, columns: str):
    return spark.createDataFrame([("customer", "dimensions", "config", 1, 0, 0, "", 1, "LIVE", columns,
                                   columns, None, None)],
                                 "table_name string, database_name string, mysql_db string, is_delta int, "
                                 "reload_table int, always_reload int, view_name string, "
                                 "is_loading_enabled int, status string, mysql_keys string, "
                                 "stats_keys string, measures string, latest_loaded_date timestamp_ntz")


@register("refresh_job", """
select c_custkey, c_name, c_mktsegment,
 case when c_custkey % 2 = 0 then TIMESTAMP '2024-01-01 00:00:00' else TIMESTAMP '2124-01-01 00:00:00' end as updated_at
 from customer""")
def q_refresh_job(spark, sf):
    """A first run of half the customers, then a delta run that finds the
    rest by the watermark, with log and Q8 (the second run is replayed)."""
    base = scratch_path(spark, "refresh")
    cols = ["c_custkey", "c_name", "c_mktsegment", "updated_at"]
    late = F.col("c_custkey") % 2 == 1
    src = table(spark, sf, "customer").withColumn("updated_at", F.when(
        late, F.expr("TIMESTAMP_NTZ'2124-01-01 00:00:00'")).otherwise(
        F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00'"))).select(*cols)
    TB.publish(_registry(spark, ",".join(cols)), f"{base}/registry")
    TB.publish(spark.createDataFrame(
        [], "log_id long, table_name string, update_date timestamp_ntz, uploaded_to_vertica string"),
        f"{base}/updates")
    TB.publish(src.where("false"), f"{base}/wh/customer")
    spec = _spec(spark, base, _entry("customer", cols, delimiter="|", **_customer()))

    def run(hour, rows):
        J.refresh_dimensions(spark, f"{base}/registry", f"{base}/updates", lambda _: rows,
                             f"{base}/dumps", f"{base}/wh", spec, hour, log_path=f"{base}/log")
    run(HOUR, src.where(~late))
    run(HOUR + 1, src)
    run(HOUR + 1, src)
    return TB.read_table(spark, f"{base}/wh/customer")


@register("refresh_keeps_request", """
select c_custkey, c_name, 'NEW' as c_mktsegment, TIMESTAMP '2024-01-01 00:00:00' as updated_at from customer""")
def q_refresh_keeps_request(spark, sf):
    """A reload asked for while a run dumps and loads is honoured by the
    next run, which replaces all rows."""
    base = scratch_path(spark, "refresh-request")
    cols = ["c_custkey", "c_name", "c_mktsegment", "updated_at"]
    src = table(spark, sf, "customer").withColumn(
        "updated_at", F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00'")).select(*cols)
    TB.publish(_registry(spark, ",".join(cols)), f"{base}/registry")
    TB.publish(spark.createDataFrame(
        [], "log_id long, table_name string, update_date timestamp_ntz, uploaded_to_vertica string"),
        f"{base}/updates")
    TB.publish(src.where("false"), f"{base}/wh/customer")
    spec = _spec(spark, base, _entry("customer", cols, delimiter="|", **_customer()))

    def first(_):
        registry = TB.read_table(spark, f"{base}/registry")
        TB.publish(ST.request_reload(registry, registry.select("table_name")), f"{base}/registry")
        return src

    def run(hour, read):
        J.refresh_dimensions(spark, f"{base}/registry", f"{base}/updates", read,
                             f"{base}/dumps", f"{base}/wh", spec, hour, log_path=f"{base}/log")
    run(HOUR, first)
    run(HOUR + 1, lambda _: src.withColumn("c_mktsegment", F.lit("NEW")))
    return TB.read_table(spark, f"{base}/wh/customer")


@register("backfill_job", "select c_custkey, c_name, c_acctbal from customer")
def q_backfill_job(spark, sf):
    """E1/E5 with an ini schema file (S15): a dump into a named folder, read
    back; the file's own column list is dumped."""
    base = scratch_path(spark, "backfill")
    ini = fs.write_text_file(spark, f"{base}/schema.ini",
                             "[customer]\ncolumns = c_custkey\ncolumns_mysql = c_custkey, c_name, c_acctbal\n")
    cust = table(spark, sf, "customer")
    out = J.backfill(spark, "2023-12-31", _registry(spark, ""), lambda _: cust, f"{base}/dumps",
                     sections=R.tables_from_ini(spark, ini))
    cols = cust.select("c_custkey", "c_name", "c_acctbal")
    return Q.split_rejects(S.read_delimited(spark, f"{out.location}/customer/*.gz", cols.schema))[0]


@register("rerun_job", with_fixtures("""
with pick as (select min(run_time) as run_time from fx_dim_load_log
 where status in ('FAILED', 'STARTED') and run_time < 202401150000 - 15 and platform = 'p1')
select l.run_time, case when l.run_time = p.run_time then 'COMPLETED' else l.status end as status, l.platform
 from fx_dim_load_log l join pick p on true
 where l.platform = 'p1'""", "fx_dim_load_log"))
def q_rerun_job(spark, sf):
    """The oldest failed run of a platform dumped again and marked."""
    base = scratch_path(spark, "rerun")
    TB.publish(fixture(spark, sf, "fx_dim_load_log"), f"{base}/log")
    cust = table(spark, sf, "customer").select("c_custkey", "c_name")
    J.rerun_failed(spark, f"{base}/log", "p1", 202401150000, _registry(spark, "c_custkey,c_name"),
                   lambda _: cust, f"{base}/dumps")
    return TB.read_table(spark, f"{base}/log").where("platform = 'p1'")
