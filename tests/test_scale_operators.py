"""Replays, batch trees, bucketed tables, key filters, fingerprints, roll-ups,
exactly-once streams, even dumps, hot lookups and key ranges."""

import datetime as dt
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SF_SMALL
from dimflow.operators import keyfilter as KF
from dimflow.operators import load as L
from dimflow.operators import reconcile as RC
from dimflow.operators import rollup as RU
from dimflow.operators import runlog as RL
from dimflow.operators import skew as SK
from dimflow.operators.quality import file_diff
from dimflow.plans import q_scale as Q
from dimflow.plans.catalog import ORACLES, QUERIES
from dimflow.plans.fixtures import fixture
from dimflow.plans.verify import compare
from dimflow.sinks import partitioned as P
from dimflow.sinks import tables as TB
from dimflow.sources import batches as B
from dimflow.sources import ranges as RG

NAMES = ["replay_month", "replay_month_failed", "replay_append_failed", "tree_window", "tree_rejects",
         "insert_new_bucketed", "insert_new_filtered", "reconcile_batches",
         "table_status_rolled_up", "events_exactly_once", "even_dump", "lookup_hot_key",
         "key_ranges"]


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_its_sql(spark, duck, name):
    assert compare(QUERIES[name](spark, SF_SMALL), duck, ORACLES[name]) == []


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# -- replays ------------------------------------------------------------------

def test_a_failed_append_keeps_the_batch(spark, tmp_path):
    path = str(tmp_path / "t")
    TB.publish(spark.createDataFrame([(1,)], "k int"), path)
    TB.append(spark.range(10).selectExpr("cast(id as int) as k"), path, "b:1")
    bad = spark.range(100).repartition(4).select(F.when(
        F.col("id") == 77, F.raise_error(F.lit("no"))).otherwise(F.col("id")).cast("int").alias("k"))
    with pytest.raises(Exception, match="no"):
        TB.append(bad, path, "b:1")
    assert TB.read_table(spark, path).count() == 11
    assert TB.read_table(spark, path, without_batch="b:1").count() == 1
    TB.append(spark.createDataFrame([(5,), (6,)], "k int"), path, "b:1")
    assert sorted(r.k for r in TB.read_table(spark, path).collect()) == [1, 5, 6]
    TB.append(spark.createDataFrame([], "k int"), path, "b:1")           # a batch without rows
    assert [r.k for r in TB.read_table(spark, path).collect()] == [1]


def test_only_loaded_partitions_change(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = T.StructType.fromDDL("k int, month string, site string")
    rows = [(i, f"2024-0{1 + i % 3}", "a/b" if i % 2 else None) for i in range(60)]
    df = spark.createDataFrame(rows, schema)
    P.load_partitions(df, path, ["month", "site"])
    read = lambda: sorted(map(tuple, P.read_partitions(spark, path, schema).collect()), key=str)
    assert read() == sorted(rows, key=str)
    P.load_partitions(df.where("month = '2024-02' and site is null and k < 20"), path,
                      ["month", "site"])
    want = [r for r in rows if r[1] != "2024-02" or r[2] or r[0] < 20]
    assert read() == sorted(want, key=str)
    P.load_partitions(df.where("false"), path, ["month", "site"])        # nothing to replace
    assert read() == sorted(want, key=str)


def test_a_partition_is_cleared(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = T.StructType.fromDDL("k int, month string")
    P.load_partitions(spark.createDataFrame([(1, "a"), (2, "b")], schema), path, ["month"])
    P.clear_partition(spark, path, {"month": "a"}, schema)
    assert [tuple(r) for r in P.read_partitions(spark, path, schema).collect()] == [(2, "b")]


# -- batch trees --------------------------------------------------------------

def test_a_window_reads_its_hours_only(spark):
    root = Q.event_tree(spark, SF_SMALL)
    old = spark.conf.get("spark.sql.maxMetadataStringLength")
    try:
        spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
        df = B.read_window(spark, root, *Q.WINDOW, Q.EVENTS)
        plan = plan_of(df)
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", old)
    filters = re.search(r"PartitionFilters: \[(.*?)\], Pushed", plan).group(1)
    assert "(date#" in filters and "(hour#" in filters
    scan = next(n for n in plan.splitlines() if "FileScan text" in n)
    assert "DataFilters: [isnotnull(value" in scan                        # nothing else is left to rows
    assert {(r.date, r.hour) for r in df.collect()} <= {("2024-01-09", "23"), ("2024-01-10", "00")}


@pytest.mark.parametrize("start, end", [
    ("2024-01-01T00:00", "2024-01-01T00:00"), ("2024-01-01T05:30", "2024-01-01T06:00"),
    ("2024-01-01T23:00", "2024-01-03T00:00"), ("2024-01-02T10:00", "2024-01-04T10:01"),
    ("2024-01-05T00:00", "2024-01-01T00:00")])
def test_window_conditions(spark, start, end):
    start, end = dt.datetime.fromisoformat(start), dt.datetime.fromisoformat(end)
    hours = [dt.datetime(2024, 1, 1) + dt.timedelta(hours=h) for h in range(120)]
    df = spark.createDataFrame([(f"{h:%Y-%m-%d}", f"{h:%H}") for h in hours], "date string, hour string")
    first = start.replace(minute=0)
    want = [(f"{h:%Y-%m-%d}", f"{h:%H}") for h in hours if first <= h < end] if start < end else []
    assert sorted(map(tuple, df.where(B.in_window(start, end)).collect())) == want


def test_reject_lines_across_splits(spark, tmp_path):
    folder = tmp_path / "tree" / "date=2024-01-01" / "hour=05"
    folder.mkdir(parents=True)
    rng = random.Random(1)
    want = []
    for f in range(3):
        lines = [rng.choice(["1|a", "", "x|b", "2", "3|c|d|e", "4|é" * 1]) for _ in range(400 + f)]
        (folder / f"part-{f}.txt").write_text("\n".join(lines) + "\n")
        want += [(f"part-{f}.txt", i, s) for i, s in enumerate(lines, 1)
                 if s and (s[0] == "x" or s.count("|") > 1)]
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "300")      # several splits a file
        bad = B.rejects_in_window(spark, str(tmp_path / "tree"), dt.datetime(2024, 1, 1, 5),
                                  dt.datetime(2024, 1, 1, 6), T.StructType.fromDDL("k int, v string"))
        got = [(r._file.rsplit("/", 1)[1], r._line, r._raw) for r in bad.collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert sorted(got) == sorted(want)


# -- bucketed tables ----------------------------------------------------------

def test_bucketed_production_is_not_shuffled(spark):
    name, _, stg = Q.bucketed_orders(spark, SF_SMALL)
    plan = plan_of(P.insert_new_bucketed(stg, name, "o_orderkey"))
    exchanges = re.findall(r"Exchange hashpartitioning\(([^#]*)#", plan)
    assert exchanges == ["o_orderkey"] and "SelectedBucketsCount" in plan
    below = plan.split("SortMergeJoin")[1]
    assert "Exchange" not in below[below.index("_p_o_orderkey", below.index("LeftAnti") + 9):]


# -- key filter ---------------------------------------------------------------

@pytest.mark.parametrize("bits", [15, 16, 25])
def test_filter_misses_no_key(spark, bits):
    rng = random.Random(bits)
    keys = [(rng.choice([None, *range(3000)]), rng.choice(["a", "b", None, "é"])) for _ in range(800)]
    stg = spark.createDataFrame([(*k, i) for i, k in enumerate(keys)], "k long, s string, v int")
    prod = spark.range(6000).selectExpr("id % 3500 as k", "case when id % 2 = 0 then 'a' else 'é' end as s")
    got = KF.insert_new_filtered(stg, prod, ["k", "s"], bits)
    want = L.insert_new(stg, prod, ["k", "s"])
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))
    near = KF.may_hold(prod, KF.key_bitmap(stg, ["k", "s"], bits), ["k", "s"], bits)
    held = set(keys)
    assert {tuple(r) for r in prod.collect()} & held <= {tuple(r) for r in near.collect()}
    empty = stg.where("false")
    assert KF.insert_new_filtered(empty, prod, ["k", "s"], bits).count() == 0
    assert KF.insert_new_filtered(stg, prod.where("false"), ["k", "s"], bits).count() == 800


def test_filtered_rows_fall_with_the_staging_share(spark):
    stg, prod = Q.filter_sides(spark, SF_SMALL)
    key = ["l_orderkey", "l_linenumber"]
    near = KF.may_hold(prod.select(*key), KF.key_bitmap(stg, key), key)
    matching = prod.join(stg.select(*key).distinct(), key).count()
    assert matching <= near.count() <= matching + prod.count() // 100
    assert "bitmap_construct_agg" in plan_of(near) and "BroadcastHashJoin" in plan_of(near)


# -- fingerprints -------------------------------------------------------------

def test_reconcile_equals_file_diff(spark):
    rng = random.Random(4)
    files, manifest = [], []
    for b in [None, *range(40)]:
        names = [rng.choice("abcdef") + str(rng.randrange(4)) for _ in range(rng.randrange(12))]
        batch = None if b is None else str(b)
        files += [(batch, n) for n in names]
        rng.shuffle(names)
        if b is None or b % 3 == 0:
            names = names[1:] + names[:1] * 2 if b and b % 2 else names[:-1]
        manifest += [(batch, n) for n in names]
    f = spark.createDataFrame(files, "batch string, name string")
    m = spark.createDataFrame(manifest, "batch string, name string")
    rows = lambda df: Counter(map(tuple, df.collect()))
    assert rows(RC.reconcile(f, m)) == rows(file_diff(f, m))
    bad = {r.batch for r in RC.unequal_batches(f, m).collect()}
    assert bad == {r.batch for r in file_diff(f, m).collect()}
    assert RC.reconcile(f, f).count() == 0 and RC.reconcile(f.where("false"), m).count() == len(manifest)


# -- roll-up ------------------------------------------------------------------

@pytest.mark.parametrize("runs", [1, 4])
def test_any_split_gives_the_full_answer(spark, tmp_path, runs):
    log = fixture(spark, SF_SMALL, "fx_load_log")
    path = str(tmp_path / "rollup")
    for i in [*range(runs), 0]:                          # the first run once more
        RU.advance(spark, path, log.where(F.pmod(F.xxhash64("log_id"), F.lit(runs)) == i))
    kept = RU.as_log(spark, path)
    rows = lambda df: Counter(map(tuple, df.collect()))
    for ask in (RL.table_status, RL.last_load_hour, RL.last_load_minute, RL.next_load_hour):
        assert rows(ask(kept)) == rows(ask(log))
    assert kept.count() == RL.hourly_grain(log).count()


def test_only_days_of_the_events_are_read(spark, tmp_path):
    path = str(tmp_path / "rollup")
    schema = "database_name string, table_name string, process_name string, status string, processed_utc_hour long, process_minute string"
    def event(hour, minute):
        return spark.createDataFrame([("d", "t", "LOAD", "COMPLETED", hour, minute)], schema)
    RU.advance(spark, path, event(24, "200001020000"))
    RU.advance(spark, path, event(48, None))
    def files():
        return {r[0] for r in RU.state(spark, path).where("day = 1").select(F.input_file_name()).collect()}
    first = files()
    RU.advance(spark, path, event(48, "200001030005"))
    assert files() == first
    assert sorted((r.day, r.max_minute) for r in RU.state(spark, path).collect()) == [
        (1, 200001020000), (2, 200001030005)]


# -- exactly once -------------------------------------------------------------

def test_stream_restarts_from_its_checkpoint(spark, tmp_path):
    from dimflow.streaming.exactly_once import stream_distinct
    schema = T.StructType.fromDDL("k long, ts timestamp_ntz, v string")
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    t0 = dt.datetime(2024, 1, 1)

    def arrive(keys):
        rows = [(k, t0 + dt.timedelta(minutes=(k or 0) % 50), f"v{k}") for k in keys]
        spark.createDataFrame(rows, schema).repartition(3).write.mode("append").parquet(source)
        stream_distinct(spark, source, schema, target, key="k", ts="ts", delay="2 hours",
                        checkpoint=state, files_per_trigger=1).awaitTermination()
        return sorted(r.k for r in spark.read.schema(schema).parquet(target).collect())
    assert arrive([3, 1, 2, 1, None]) == [1, 2, 3]
    assert arrive([2, 9, 3, 9]) == [1, 2, 3, 9]
    assert arrive([1, 2]) == [1, 2, 3, 9]


# -- even parts, hot lookups, ranges -----------------------------------------

def test_parts_of_a_hot_key_are_even(spark, tmp_path):
    df = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 50))
        .alias("source"), F.sha2(F.col("id").cast("string"), 256).alias("text"))
    conf = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k",
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        P.write_even(df.repartition(16), str(tmp_path / "d"), ["source"], max_rows=8_000)
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    back = spark.read.parquet(str(tmp_path / "d"))
    sizes = [r["count"] for r in back.groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) == 60_000 and len(sizes) >= 8
    assert max(sizes) <= 2 * sum(sizes) / len(sizes) and max(sizes) <= 8_000


def test_hot_lookup_spreads_and_equals_the_plain_join(spark):
    stg = Q.hot_lineitems(spark, SF_SMALL).repartition(8)
    part = spark.read.parquet(f"{SF_SMALL}/part.parquet").select("p_partkey", "p_brand")
    part = part.unionAll(part.where("p_partkey = 1"))                     # a lookup key twice
    assert [r.l_partkey for r in SK.hot_keys(stg, "l_partkey", 0.2).collect()] == [1]
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.shuffle.partitions": "8"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        salted = SK.salted_lookup(stg, part, "l_partkey", "p_partkey", share=0.05, salt=64)
        plain = stg.join(part, F.col("l_partkey") == F.col("p_partkey"))
        sizes = sorted(r["count"] for r in salted.groupBy(F.spark_partition_id()).count().collect())
        assert Counter(map(tuple, salted.select(*plain.columns).collect())) == Counter(
            map(tuple, plain.collect()))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert len(sizes) == 8 and sizes[-1] <= 3 * sizes[len(sizes) // 2]


def test_ranges_of_uneven_keys(spark):
    df = spark.range(20_000).selectExpr("case when id % 100 = 0 then null else id * id end as k")
    bounds = RG.equal_count_bounds(df, "k", 10)
    assert len(bounds) == 9 and bounds == sorted(bounds)
    counts = [df.where(p).count() for p in RG.range_predicates("k", bounds)]
    assert sum(counts) == 20_000 and max(counts) <= 1.15 * 2000
    same = spark.range(100).selectExpr("7L as k")
    preds = RG.range_predicates("k", RG.equal_count_bounds(same, "k", 4))
    assert sum(same.where(p).count() for p in preds) == 100
    none = RG.equal_count_bounds(same.where("false"), "k", 4)
    assert none == [] and len(RG.range_predicates("k", none)) == 1
