"""Queries for scans, cleansing and time expressions (S1, S2, S16, C1-C4,
H1-H3, K12)."""

from __future__ import annotations

from pyspark.sql import functions as F

from dimflow.functions.cleanse import cleanse, separator, to_delimited
from dimflow.functions import timeutil as TU
from dimflow.plans.catalog import register
from dimflow.plans.fixtures import fixture, table, with_fixtures
from dimflow.sources.tables import row_count, scan_full


@register("scan_full", "select c_custkey, c_name, c_mktsegment from customer")
def q_scan_full(spark, sf):
    """Chosen columns of a table (only they are read from parquet)."""
    return scan_full(spark, f"{sf}/customer.parquet", "c_custkey,c_name,c_mktsegment")


@register("scan_view", """
select o_orderkey, o_custkey, o_totalprice from orders where o_orderstatus = 'F'""")
def q_scan_view(spark, sf):
    """The dump reads a view that stands in for the table."""
    view = table(spark, sf, "orders").where(F.col("o_orderstatus") == "F")
    return scan_full(spark, f"{sf}/orders.parquet", ["o_orderkey", "o_custkey", "o_totalprice"], view=view)


@register("row_count", "select count(*) as row_count from lineitem")
def q_row_count(spark, sf):
    """S16."""
    return row_count(table(spark, sf, "lineitem"))


def _piped(col: str) -> str:
    return f"replace(replace({col}, '|', '-'), '0000-00-00 00:00:00', '1970-01-01 12:00:00') as {col}"


def _stripped(col: str) -> str:
    text = f"cast({col} as varchar)"
    return f"replace(replace(replace({text}, 'NULL', ''), chr(13), ''), '4294967295', '0') as {col}"


@register("cleanse_pipe", with_fixtures(
    f"select doc_id, {_piped('text')}, {_piped('lang')}, {_piped('source')}, n_chars from fx_cells",
    "fx_cells"))
def q_cleanse_pipe(spark, sf):
    """Primary-version cleansing of every cell; the cells hold separators,
    tabs and zero datetimes."""
    return cleanse(fixture(spark, sf, "fx_cells"), "pipe")


@register("cleanse_ctrl_a", with_fixtures("select " + ", ".join(
    _stripped(c) for c in ("doc_id", "text", "lang", "source", "n_chars")) + " from fx_cells", "fx_cells"))
def q_cleanse_ctrl_a(spark, sf):
    """Other-version cleansing of every cell (substring rules, numbers as
    text); the cells hold NULL texts, carriage returns and unsigned -1."""
    return cleanse(fixture(spark, sf, "fx_cells"), "ctrl_a")


@register("to_delimited", """
select concat_ws(chr(1), coalesce(cast(c_custkey as varchar), ''), coalesce(c_name, ''),
 coalesce(cast(c_nationkey as varchar), ''), coalesce(c_mktsegment, ''),
 printf('%.2f', c_acctbal)) as line from customer""")
def q_to_delimited(spark, sf):
    """Rows to ctrl-A delimited lines, the separator given as hex '01'."""
    cust = table(spark, sf, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_mktsegment",
        F.format_string("%.2f", F.col("c_acctbal").cast("double")).alias("c_acctbal"))
    return to_delimited(cust, separator("01"))


@register("hour_conversions", """
select event_id, cast(floor(epoch(ts) / 3600) as bigint) as utc_hour,
 make_timestamp(cast(floor(epoch(ts) / 3600) as bigint) * 3600 * 1000000) as hour_ts,
 (make_timestamp(cast(floor(epoch(ts) / 3600) as bigint) * 3600 * 1000000) AT TIME ZONE 'UTC') AT TIME ZONE 'US/Pacific' as pacific
 from events""")
def q_hour_conversions(spark, sf):
    """H1-H3: timestamp -> UTC hour -> hour timestamp -> Pacific wall time."""
    ev = table(spark, sf, "events")
    h = TU.utc_hour("ts")
    return ev.select("event_id", h.alias("utc_hour"), TU.hour_ts(h).alias("hour_ts"),
                     TU.to_pacific(TU.hour_ts(h)).alias("pacific"))


@register("pacific_dst", """
select o_orderkey, (o_orderdate AT TIME ZONE 'UTC') AT TIME ZONE 'US/Pacific' as pacific from orders""")
def q_pacific_dst(spark, sf):
    """H3 across six years of daylight-saving changes."""
    return table(spark, sf, "orders").select("o_orderkey", TU.to_pacific("o_orderdate").alias("pacific"))


@register("batch_paths", """
select distinct h as hour,
 strftime(make_timestamp(h * 3600 * 1000000), '%Y/%m/%d/%H') as slash_hour,
 strftime(make_timestamp(h * 3600 * 1000000), '%Y%m%d%H') as hour_dir,
 strftime(make_timestamp(h * 3600 * 1000000), '%Y%m%d%H00') as hour00_dir,
 strftime(make_timestamp(h * 3600 * 1000000), '%Y%m%d%H%M') as minute_dir,
 strftime(make_timestamp(h * 3600 * 1000000), 'date=%Y-%m-%d') as date_dir
 from (select cast(floor(epoch(o_orderdate) / 3600) as bigint) + o_orderkey % 24 as h from orders) t""")
def q_batch_paths(spark, sf):
    """Every batch folder layout for each load hour."""
    o = table(spark, sf, "orders")
    h = (TU.utc_hour("o_orderdate") + F.col("o_orderkey") % 24).alias("hour")
    hours = o.select(h).distinct()
    return hours.select("hour",
                        TU.batch_path("hour", "slash_hour").alias("slash_hour"),
                        TU.batch_path("hour", "hour").alias("hour_dir"),
                        TU.batch_path("hour", "hour00").alias("hour00_dir"),
                        TU.batch_path("hour", "minute").alias("minute_dir"),
                        TU.batch_path("hour", "date").alias("date_dir"))
