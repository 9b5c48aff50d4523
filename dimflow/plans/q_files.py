"""Queries through files: the data goes out through a writer and back in
through a reader or a whole load job, and must come back equal to the source
SQL (K1, K2, K6-K11, K8, L19, S6, S7, E2).

Files go to a fresh folder under the session's shared checkpoint directory
(``spark.checkpoint.dir``), never a machine-local one.
"""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from dimflow.operators import quality as Q
from dimflow.operators.projection import schema_lines
from dimflow.plans import jobs as J
from dimflow.plans.catalog import register
from dimflow.plans.fixtures import fixture, table, with_fixtures
from dimflow.plans.q_load import CUST_COLS
from dimflow.plans.q_projection import _norm_case
from dimflow.session import scratch_path
from dimflow.sinks import files as K
from dimflow.sinks import fs
from dimflow.sinks import tables as TB
from dimflow.sources import files as S


@register("dump_round_trip", "select * from orders")
def q_dump_round_trip(spark, sf):
    """K1 -> S6 -> K8: orders as gzip '|' text (8 part files) and back, typed."""
    orders = table(spark, sf, "orders")
    path = K.write_dump(orders, scratch_path(spark, "dump"), "b", "orders", partitions=8)
    good, _ = Q.split_rejects(S.read_delimited(spark, path, orders.schema))
    return good


@register("dump_rejects", """
select count(*) filter (where strpos(text, '|') > 0 or strpos(lang, '|') > 0) as rejected_rows,
 count(*) filter (where not (strpos(text, '|') > 0 or strpos(lang, '|') > 0)) as good_rows from documents""")
def q_dump_rejects(spark, sf):
    """K1 without cleansing -> S6: documents whose text holds the separator
    come back as 'too many fields' rejects (L19 counts them in the same pass)."""
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    path = K.write_dump(docs, scratch_path(spark, "rej"), "b", "documents", partitions=4)
    parsed = S.read_delimited(spark, path, docs.schema)
    return parsed.agg(F.count_if(F.col(S.REASON).isNotNull()).alias("rejected_rows"),
                      F.count_if(F.col(S.REASON).isNull()).alias("good_rows"))


@register("orc_round_trip", "select l_orderkey, l_partkey, l_quantity, l_shipdate from lineitem")
def q_orc_round_trip(spark, sf):
    """An ORC batch read with a column list (only those columns read)."""
    path = scratch_path(spark, "orc")
    table(spark, sf, "lineitem").write.orc(path)
    return S.read_orc(spark, path, ["l_orderkey", "l_partkey", "l_quantity", "l_shipdate"])


@register("sidecar_round_trip", with_fixtures(f"""
with v as (select table_name as t, view_name as v from fx_registry where view_name <> ''),
lines as (
 select coalesce(v.t, d.table_name) as table_name,
  replace(d.table_name || ' ' || d.column_name || ' - - - - - ' || {_norm_case('d.data_type')} || ' - "ends ''\\001''"',
          d.table_name, coalesce(v.t, d.table_name)) as line
 from fx_part_dictionary d left join v on v.v = d.table_name)
select distinct table_name, table_name || ' - - - - - - format - -' as line from lines
union all select * from lines""", "fx_part_dictionary", "fx_registry"))
def q_sidecar_round_trip(spark, sf):
    """P8 -> K2 (all tables in one partitioned write) -> read back."""
    views = fixture(spark, sf, "fx_registry").select("table_name", "view_name")
    root = scratch_path(spark, "sidecars")
    K.write_schema_sidecars(schema_lines(fixture(spark, sf, "fx_part_dictionary"), views), root)
    return spark.read.text(root).select("table_name", F.col("value").alias("line"))


def _spec(operation: str) -> dict:
    return {"version": "1", "groups": [{"tables": [{
        "name": "customer", "db_name": "dim", "db_name_stg": "stg", "sql": "select",
        "columns": [{"field_type": "KEY", "output_name": c} for c in CUST_COLS.split(", ")],
        "dimension": {"operation": operation, "operation_column": "c_custkey",
                      "order_column": "c_acctbal"}}]}]}


def _load_job(spark, sf, operation: str):
    base = scratch_path(spark, f"load-{operation.lower()}")
    prod_path, stg_path = f"{base}/wh/customer", f"{base}/wh/stg/customer"
    TB.publish(fixture(spark, sf, "fx_cust_prod"), prod_path)
    stg = fixture(spark, sf, "fx_cust_stg")
    batch_dir = K.write_dump(stg, f"{base}/dumps", "2024010100", "customer", partitions=4)
    spec = fs.write_text_file(spark, f"{base}/schema.json", json.dumps(_spec(operation)))
    # the load takes column types from the batch's sidecar, as shipped by the dump
    from dimflow.sources.jdbc import dictionary_from_schema
    K.write_schema_sidecar(schema_lines(dictionary_from_schema(spark, stg, "customer")),
                           f"{batch_dir}/customer.schema")
    J.load(spark, "customer", batch_dir, spec, prod_path, stg_path=stg_path,
           log_path=f"{base}/trf_log", hour=473352)
    return TB.read_table(spark, prod_path)


@register("load_job_insert", with_fixtures(f"""
select {CUST_COLS} from fx_cust_prod
union all
select {CUST_COLS} from fx_cust_stg s
 where not exists (select 1 from fx_cust_prod p where p.c_custkey = s.c_custkey)""",
                                           "fx_cust_prod", "fx_cust_stg"))
def q_load_job_insert(spark, sf):
    """E2 end to end: dump + sidecar -> parse -> staging (K6) -> insert-if-absent
    (J1) appended as a batch -> staging truncated (K11) -> COMPLETED event."""
    return _load_job(spark, sf, "Insert")


@register("load_job_merge", with_fixtures(f"""
select {CUST_COLS} from fx_cust_prod p
 where not exists (select 1 from fx_cust_stg s where s.c_custkey = p.c_custkey)
union all
select {CUST_COLS} from fx_cust_stg""", "fx_cust_prod", "fx_cust_stg"))
def q_load_job_merge(spark, sf):
    """E2 with ``operation: Merge``: staging rows replace production rows (X1),
    published as a new table version."""
    return _load_job(spark, sf, "Merge")
