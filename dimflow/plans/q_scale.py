"""Queries for replays, batch trees, bucketed tables, key filters, fingerprints,
roll-ups, streams, even dumps, hot lookups and key ranges."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimflow.operators import keyfilter, reconcile, rollup, runlog, skew
from dimflow.plans.catalog import ORACLES, register
from dimflow.plans.fixtures import fixture, table, with_fixtures
from dimflow.session import scratch_path
from dimflow.sinks import partitioned as P
from dimflow.sinks import tables as TB
from dimflow.sources import batches as B
from dimflow.sources import ranges
from dimflow.streaming.exactly_once import stream_distinct

ORDERS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]
MONTH = "1996-03"


def _by_month(spark, sf):
    o = table(spark, sf, "orders")
    return o.select(*ORDERS, F.date_format("o_orderdate", "yyyy-MM").alias("month"))


def _loaded(spark, sf):
    """(orders by month, path of a table partitioned by it, schema)."""
    orders = _by_month(spark, sf)
    path = scratch_path(spark, "orders-by-month")
    P.load_partitions(orders, path, ["month"])
    return orders, path


@register("replay_month", f"""
select o_orderkey, o_custkey, o_orderstatus, o_totalprice, strftime(o_orderdate, '%Y-%m') as month from orders
 where not (strftime(o_orderdate, '%Y-%m') = '{MONTH}' and o_orderkey % 3 = 0)""")
def q_replay_month(spark, sf):
    """Orders by month, one month replayed with fewer rows."""
    orders, path = _loaded(spark, sf)
    P.load_partitions(orders.where((F.col("month") == MONTH) & (F.col("o_orderkey") % 3 != 0)),
                      path, ["month"])
    return P.read_partitions(spark, path, orders.schema)


@register("replay_month_failed", """
select o_orderkey, o_custkey, o_orderstatus, o_totalprice, strftime(o_orderdate, '%Y-%m') as month from orders""")
def q_replay_month_failed(spark, sf):
    """K7: a replay that fails after some rows leaves the old month."""
    orders, path = _loaded(spark, sf)
    broken = orders.where(F.col("month") == MONTH).withColumn(
        "o_totalprice", F.when(F.col("o_orderkey") % 5 == 0, F.raise_error(F.lit("broken row")))
        .otherwise(F.col("o_totalprice")))
    try:
        P.load_partitions(broken, path, ["month"])
    except PySparkException as e:
        if "broken row" not in str(e):
            raise
    return P.read_partitions(spark, path, orders.schema)


@register("replay_append_failed", """
select o_orderkey, o_custkey, o_orderstatus, o_totalprice, case when o_orderkey % 2 = 0 then 'even' else 'odd' end as batch
 from orders""")
def q_replay_append_failed(spark, sf):
    """Two batches appended, the second one's replay fails half-way; both stay readable."""
    o = table(spark, sf, "orders").select(*ORDERS)
    path = scratch_path(spark, "orders-appended")
    even, odd = o.where("o_orderkey % 2 = 0"), o.where("o_orderkey % 2 <> 0")
    TB.append(even.withColumn("batch", F.lit("even")), path, 1)
    odd = odd.withColumn("batch", F.lit("odd"))
    TB.append(odd, path, 2)
    try:
        TB.append(odd.withColumn("o_totalprice", F.when(
            F.col("o_orderkey") % 5 == 0, F.raise_error(F.lit("broken row")))
            .otherwise(F.col("o_totalprice"))), path, 2)
    except PySparkException as e:
        if "broken row" not in str(e):
            raise
    return TB.read_table(spark, path)


EVENTS = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType()),
                       T.StructField("event_type", T.StringType()), T.StructField("value", T.DoubleType())])
WINDOW = dt.datetime(2024, 1, 9, 23), dt.datetime(2024, 1, 10, 1)


def event_tree(spark, sf):
    """All events as delimited lines in hour folders; every 17th line has a bad value."""
    root = scratch_path(spark, "event-tree")
    e = table(spark, sf, "events")
    value = F.when(F.col("event_id") % 17 == 0, F.lit("n/a")).otherwise(F.col("value").cast("string"))
    B.write_tree(e.select("ts", F.concat_ws("|", "event_id", "user_id", "event_type", value)
                          .alias("value")), root, "ts")
    return root


@register("tree_window", """
select event_id, user_id, event_type, value, strftime(ts, '%Y-%m-%d') as date, strftime(ts, '%H') as hour
 from events where ts >= timestamp '2024-01-09 23:00:00' and ts < timestamp '2024-01-10 01:00:00' and event_id % 17 <> 0""")
def q_tree_window(spark, sf):
    """The good rows of a two-hour window, read by partition filter."""
    rows = B.read_window(spark, event_tree(spark, sf), *WINDOW, EVENTS)
    return rows.where("_reject_reason is null").drop("_raw", "_reject_reason")


@register("tree_rejects", """
select concat_ws('|', event_id, user_id, event_type, 'n/a') as _raw, 'bad value for value' as _reject_reason,
 strftime(ts, '%Y-%m-%d') as date, strftime(ts, '%H') as hour, true as in_its_hour, true as line_matches
 from events where event_id % 17 = 0""")
def q_tree_rejects(spark, sf):
    """The rejects of all hours with file and line, which are looked up again."""
    root = event_tree(spark, sf)
    bad = B.rejects_in_window(spark, root, dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1), EVENTS)
    # the n-th line of each file, by reading each file whole
    texts = (spark.read.text(root, wholetext=True)
             .select(F.col("_metadata.file_path").alias("_file"), F.split("value", "\n").alias("_lines")))
    return (bad.join(texts, "_file")
            .select("_raw", "_reject_reason", "date", "hour",
                    F.contains("_file", F.concat(F.lit("/date="), "date", F.lit("/hour="), "hour", F.lit("/")))
                    .alias("in_its_hour"),
                    (F.get("_lines", (F.col("_line") - 1).cast("int")) == F.col("_raw"))
                    .alias("line_matches")))


def bucketed_orders(spark, sf, buckets=8):
    """Two thirds of the orders in a bucketed table: (name, path, staging)."""
    o = table(spark, sf, "orders").select(*ORDERS)
    name, path = f"orders_{uuid.uuid4().hex[:12]}", scratch_path(spark, "orders-bucketed")
    P.save_bucketed(o.where("o_orderkey % 3 <> 0"), name, path, "o_orderkey", buckets)
    return name, path, o.withColumn("o_totalprice", F.col("o_totalprice") + 1)


@register("insert_new_bucketed", """
select o_orderkey, o_custkey, o_orderstatus, case when o_orderkey % 3 = 0 then o_totalprice + 1 else o_totalprice end as o_totalprice
 from orders""")
def q_insert_new_bucketed(spark, sf):
    """Production orders, bucketed, after insert-if-absent of all orders."""
    name, path, stg = bucketed_orders(spark, sf)
    P.append_new_bucketed(stg, name, path, "o_orderkey", 8)
    return spark.table(name)


LINES = ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_shipdate"]


def filter_sides(spark, sf):
    """(staging, production) lineitems: two months against all before 1999."""
    li = table(spark, sf, "lineitem").select(*LINES)
    stg = li.where("l_shipdate >= timestamp '1998-12-01' and l_shipdate < timestamp '1999-02-01'")
    return stg, li.where("l_shipdate < timestamp '1999-01-01'")


@register("insert_new_filtered", """
select l_orderkey, l_linenumber, l_partkey, l_quantity, l_shipdate from lineitem s
 where l_shipdate >= timestamp '1998-12-01' and l_shipdate < timestamp '1999-02-01' and not exists (
  select 1 from lineitem p where p.l_shipdate < timestamp '1999-01-01' and p.l_orderkey = s.l_orderkey
   and p.l_linenumber = s.l_linenumber)""")
def q_insert_new_filtered(spark, sf):
    """New lineitems, production filtered by a bitmap of staging's keys first."""
    stg, prod = filter_sides(spark, sf)
    return keyfilter.insert_new_filtered(stg, prod, ["l_orderkey", "l_linenumber"])


@register("reconcile_batches", ORACLES.get("file_diff"))
def q_reconcile_batches(spark, sf):
    """Files against manifests, names compared only where fingerprints differ."""
    return reconcile.reconcile(fixture(spark, sf, "fx_files"), fixture(spark, sf, "fx_manifest"))


@register("table_status_rolled_up", ORACLES.get("table_status"))
def q_table_status_rolled_up(spark, sf):
    """L6/L7/L9/L10/L14 from a roll-up that three runs of the log were merged into."""
    log = fixture(spark, sf, "fx_load_log")
    path = scratch_path(spark, "rollup")
    for run in range(3):
        rollup.advance(spark, path, log.where(F.col("log_id") % 3 == run))
    return runlog.table_status(rollup.as_log(spark, path))


@register("events_exactly_once", "select event_id, ts, user_id, event_type, value from events")
def q_events_exactly_once(spark, sf):
    """Events that come twice and out of order, through two runs of a stream."""
    e = table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value")
    source, target, state = (scratch_path(spark, n) for n in ("stream-in", "stream-out", "stream-state"))
    for part in ("event_id % 3 <> 0", "event_id % 2 = 0 or event_id % 3 = 0"):
        e.where(part).orderBy(F.xxhash64("event_id")).write.mode("append").parquet(source)
        stream_distinct(spark, source, e.schema, target, key="event_id", ts="ts",
                        delay="60 days", checkpoint=state).awaitTermination()
    return spark.read.schema(e.schema).parquet(target)


@register("even_dump", """
select source, count(*) as n_docs, cast(sum(length(coalesce(text, ''))) as bigint) as chars, true as whole from documents group by source""")
def q_even_dump(spark, sf):
    """K1: documents dumped near their source in even parts, and read back."""
    docs = table(spark, sf, "documents").select("doc_id", "text", "source")
    path = scratch_path(spark, "even-dump")
    P.write_even(docs, path, ["source"], max_rows=1_000_000)
    back = spark.read.parquet(path)
    return back.groupBy("source").agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.sum(F.length(F.coalesce("text", F.lit("")))).cast("bigint").alias("chars"),
        (F.max(F.length("_metadata.file_path")) > 0).alias("whole"))


def hot_lineitems(spark, sf):
    """Lineitems with a third of the rows on one part."""
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.when(F.col("l_orderkey") % 3 == 0, F.lit(1))
        .otherwise(F.col("l_partkey")).cast("long").alias("l_partkey"))


@register("lookup_hot_key", """
select l_orderkey, l_linenumber, l.l_partkey, p.p_partkey, p.p_brand from (
 select l_orderkey, l_linenumber, case when l_orderkey % 3 = 0 then 1 else l_partkey end as l_partkey from lineitem) l
 join part p on p.p_partkey = l.l_partkey""")
def q_lookup_hot_key(spark, sf):
    """Part lookup with a third of the rows on one key, salted."""
    return skew.salted_lookup(hot_lineitems(spark, sf),
                              table(spark, sf, "part").select("p_partkey", "p_brand"),
                              "l_partkey", "p_partkey")


@register("key_ranges", """
select 16 as n_ranges, count(*) as n_rows, true as even from lineitem""")
def q_key_ranges(spark, sf):
    """16 ranges of uneven keys with equal counts; each row in one range."""
    li = table(spark, sf, "lineitem").select(
        (F.col("l_orderkey") * F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("k"))
    bounds = ranges.equal_count_bounds(li, "k", 16)
    which = sum((F.expr(f"case when {p} then {i} else 0 end")
                 for i, p in enumerate(ranges.range_predicates("k", bounds))), F.lit(0))
    hits = sum((F.expr(f"case when {p} then 1 else 0 end")
                for p in ranges.range_predicates("k", bounds)), F.lit(0))
    per = li.select(which.alias("range"), hits.alias("hits")).groupBy("range").agg(
        F.count(F.lit(1)).alias("n"), F.min("hits").alias("lo"), F.max("hits").alias("hi"))
    return per.agg(F.count(F.lit(1)).cast("int").alias("n_ranges"), F.sum("n").alias("n_rows"),
                   ((F.max("n") <= 1.05 * F.avg("n")) & (F.min("lo") == 1) & (F.max("hi") == 1))
                   .alias("even"))
