"""Queries for the load operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from dimflow.functions.timeutil import hour_ts, ntz, to_pacific, utc_hour
from dimflow.operators import load as L
from dimflow.plans.catalog import register
from dimflow.plans.fixtures import fixture, table, with_fixtures

CUST_COLS = "c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment"


@register("insert_new", with_fixtures(f"""
select {CUST_COLS} from fx_cust_prod
union all
select {CUST_COLS} from fx_cust_stg s
 where not exists (select 1 from fx_cust_prod p where p.c_custkey = s.c_custkey)""",
                                      "fx_cust_prod", "fx_cust_stg"))
def q_insert_new(spark, sf):
    """Production after insert-if-absent of staging customers."""
    prod = fixture(spark, sf, "fx_cust_prod")
    stg = fixture(spark, sf, "fx_cust_stg")
    return L.publish_insert_new(stg, prod, "c_custkey")


@register("insert_new_rows", with_fixtures("""
select s.* from fx_cust_stg s anti join fx_cust_prod p on p.c_custkey = s.c_custkey""",
                                           "fx_cust_prod", "fx_cust_stg"))
def q_insert_new_rows(spark, sf):
    """Only the rows the insert adds."""
    return L.insert_new(fixture(spark, sf, "fx_cust_stg"), fixture(spark, sf, "fx_cust_prod"),
                        "c_custkey")


@register("upsert", with_fixtures(f"""
select {CUST_COLS} from fx_cust_prod p
 where not exists (select 1 from fx_cust_stg s where s.c_custkey = p.c_custkey)
union all
select {CUST_COLS} from fx_cust_stg""", "fx_cust_prod", "fx_cust_stg"))
def q_upsert(spark, sf):
    """Merge staging customers into production."""
    return L.upsert(fixture(spark, sf, "fx_cust_prod"), fixture(spark, sf, "fx_cust_stg"),
                    "c_custkey", "c_acctbal")


@register("upsert_latest_event", """
select event_id, ts, user_id, event_type, value from (
  select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn from events) t
 where rn = 1""")
def q_upsert_latest_event(spark, sf):
    """X1 + T1: a per-user dimension built from events before Jan 15, then
    merged with every later event (many rows per key, latest wins)."""
    ev = table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value")
    cut = ntz("2024-01-15 00:00:00")
    prod = L.latest_per_key(ev.where(F.col("ts") < cut), "user_id", "ts")
    stg = ev.where(F.col("ts") >= cut)
    return L.upsert(prod, stg, "user_id", "ts")


@register("latest_per_key", """
select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority from (
  select *, row_number() over (partition by o_custkey
     order by o_orderdate desc, o_orderkey desc, o_orderstatus desc, o_totalprice desc, o_orderpriority desc) rn
  from orders) t where rn = 1""")
def q_latest_per_key(spark, sf):
    """T1 (set form): each customer's latest order, ties broken by all columns."""
    o = table(spark, sf, "orders")
    return L.latest_per_key(o.select("o_orderdate", "o_custkey", "o_orderkey", "o_orderstatus",
                                     "o_totalprice", "o_orderpriority"), "o_custkey", "o_orderdate") \
        .select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
                "o_orderpriority")


@register("insert_with_lookup", """
select l.l_orderkey, p.p_brand as l_partkey, l.l_suppkey, l.l_linenumber, l.l_quantity, l.l_shipdate
 from lineitem l join part p on p.p_partkey = l.l_partkey""")
def q_insert_with_lookup(spark, sf):
    """J2 + P6: staging lineitems with l_partkey replaced through the part lookup."""
    stg = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey",
                                              "l_linenumber", "l_quantity", "l_shipdate")
    return L.insert_with_lookup(stg, table(spark, sf, "part"), "l_partkey", "p_partkey",
                                unwanted="l_partkey", wanted="p_brand")


@register("insert_positional", """
select o_orderkey as order_id, o_custkey as customer_id, o_orderstatus as status,
 o_totalprice as total, o_orderdate as ordered_at, o_orderpriority as priority from orders""")
def q_insert_positional(spark, sf):
    """Staging orders inserted by position into a differently named target."""
    return L.insert_positional(table(spark, sf, "orders"),
                               ["order_id", "customer_id", "status", "total", "ordered_at", "priority"])


@register("with_load_epoch", """
select l_orderkey, l_linenumber, l_extendedprice, cast(1704067200 as bigint) as load_epoch_ts from lineitem""")
def q_with_load_epoch(spark, sf):
    """Non-dimension rows tagged with the load second."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return L.with_load_epoch(li, 1704067200)


@register("assign_identity", with_fixtures("""
select s.c_custkey, s.c_name,
 cast((select max(c_custkey) from fx_cust_prod) + row_number() over (order by s.c_custkey) as bigint) as dim_id
 from fx_cust_stg s anti join fx_cust_prod p on p.c_custkey = s.c_custkey""", "fx_cust_prod", "fx_cust_stg"))
def q_assign_identity(spark, sf):
    """P5: dense identity for inserted dimension rows, continuing production's."""
    prod = fixture(spark, sf, "fx_cust_prod")
    new = L.insert_new(fixture(spark, sf, "fx_cust_stg"), prod, "c_custkey", ["c_custkey", "c_name"])
    start = prod.agg(F.max("c_custkey")).scalar()
    return L.assign_identity(new, "c_custkey", "dim_id", start)


@register("for_host", with_fixtures("""
select * from fx_summary where reporting_database_server_id in (select id from fx_servers where host_name = 'host1')""",
                                    "fx_summary", "fx_servers"))
def q_for_host(spark, sf):
    """Summary rows of one host's servers."""
    return L.for_host(fixture(spark, sf, "fx_summary"), fixture(spark, sf, "fx_servers"), "host1")


@register("advance_loaded_date", with_fixtures("""
select s.table_name, s.reporting_database_server_id,
 case when s.reporting_database_server_id in (select id from fx_servers where host_name = 'host2')
      then case when s.latest_loaded_date is null then n.loaded_at
                when s.latest_loaded_date > n.loaded_at then s.latest_loaded_date else n.loaded_at end
      else s.latest_loaded_date end as latest_loaded_date
 from fx_summary s
 join (select table_name, max(loaded_at) as loaded_at from (
         select table_name, (make_timestamp(cast(floor(epoch(TIMESTAMP '2024-01-20 00:00:00')/3600) + reporting_database_server_id as bigint)*3600*1000000)
                AT TIME ZONE 'UTC') AT TIME ZONE 'US/Pacific' as loaded_at from fx_summary) x group by table_name) n
   on n.table_name = s.table_name""", "fx_summary", "fx_servers"))
def q_advance_loaded_date(spark, sf):
    """M7: raise latest_loaded_date (Pacific wall time of the loaded hour)
    for host2's servers; NULL takes the new value, later values stay."""
    summary = fixture(spark, sf, "fx_summary")
    base_hour = utc_hour(ntz("2024-01-20 00:00:00"))
    loads = summary.select("table_name", to_pacific(hour_ts(
        base_hour + F.col("reporting_database_server_id"))).alias("loaded_at"))
    return L.advance_loaded_date(summary, fixture(spark, sf, "fx_servers"), "host2", loads)
