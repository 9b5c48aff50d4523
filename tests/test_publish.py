"""Batches loaded again, typed targets, lossless cells, sessions and caps."""

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from dimflow import session
from dimflow.operators import load as L
from dimflow.operators import registry as R
from dimflow.operators import runlog as RL
from dimflow.operators import state as ST
from dimflow.sinks import files as K
from dimflow.sinks import tables as TB
from dimflow.sources import files as S


def test_read_without_batch(spark, tmp_path):
    path = str(tmp_path / "t")
    one = spark.createDataFrame([(1,)], "k int")
    TB.publish(one, path)
    TB.append(spark.createDataFrame([(2,)], "k int"), path, "2024010101")
    assert [r.k for r in TB.read_table(spark, path, without_batch="2024010101").collect()] == [1]
    assert TB.read_table(spark, path).count() == 2


def test_events_of_one_hour_keep_apart(spark, tmp_path):
    path = str(tmp_path / "log")
    for db, process in (("db0", "TRANSFER"), ("db0", "LOAD"), ("db1", "LOAD"), ("db1", "LOAD")):
        TB.append_load_event(spark, path, db, "t", process, 5, "COMPLETED", "p")
    got = TB.read_table(spark, path).select("database_name", "process_name").collect()
    assert sorted(map(tuple, got)) == [("db0", "LOAD"), ("db0", "TRANSFER"), ("db1", "LOAD")]


CELLS = ["plain", "a\nb", "c\\d", "tab\there", "\\n", "\\\\", "\\", "x\r\ny", "nul\x00", "\\t\t\\", "é|ü"]


def test_cells_come_back_as_they_were(spark, tmp_path):
    df = spark.createDataFrame(list(enumerate(CELLS)), "k int, v string")
    path = K.write_dump(df, str(tmp_path), "b", "t", sep="\x01")
    back = S.read_delimited(spark, path, df.schema, "\x01")
    assert {r.k: r.v for r in back.collect()} == dict(enumerate(CELLS))
    # NULL and the empty text are both written as an empty cell, read as NULL
    nulls = spark.createDataFrame([(1, None), (2, "")], "k int, v string")
    path = K.write_dump(nulls, str(tmp_path), "b", "n")
    assert [r.v for r in S.read_delimited(spark, path, nulls.schema).collect()] == [None, None]


def test_type_columns_rejects(spark):
    df = spark.createDataFrame([("1", "x"), ("y", "z"), (None, None)], "a string, b string")
    out = S.type_columns(df, [("a", "int"), ("b", "string")]).collect()
    assert [(r.a, r.b, r[S.REASON]) for r in out] == [
        (1, "x", None), (None, "z", "bad value for a"), (None, None, None)]


def test_identity_does_not_depend_on_exchange_reuse(spark):
    df = spark.range(20_000).select((F.col("id") * 7919 % 20_000).alias("k"))
    before = {c: spark.conf.get(c) for c in ("spark.sql.exchange.reuse", "spark.sql.adaptive.enabled")}
    try:
        for c in before:
            spark.conf.set(c, "false")
        got = L.assign_identity(df, "k", "i", 5).select("k", "i").collect()
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)
    assert all(r.i == r.k + 6 for r in got) and len(got) == 20_000


def test_merge_names_its_order(spark):
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    with pytest.raises(ValueError, match="order column"):
        L.upsert(df, df, "k")


def test_lists_have_no_cap(spark):
    df = spark.createDataFrame([(",".join(map(str, range(1500))),)], "items string")
    assert R.explode_list(df, "items").count() == 1500


def test_mark_complete_without_log_id(spark):
    log = spark.createDataFrame([("t", 1, "downloaded"), ("t", 2, "downloaded")],
                                "table_name string, update_date int, uploaded_to_vertica string")
    got = sorted(map(tuple, ST.mark_complete(log).collect()))
    assert got == [("t", 1, "downloaded"), ("t", 2, "complete")]


def test_unknown_interval(spark):
    log = spark.createDataFrame([], TB.TRF_LOG_SCHEMA)
    with pytest.raises(ValueError, match="interval"):
        RL.next_interval(log, "weekly")


def test_session_keeps_what_the_builder_sets(monkeypatch):
    made = {}

    class Stop(Exception):
        pass

    def get(self):
        made.update(self._options)
        raise Stop
    monkeypatch.setattr(SparkSession, "getActiveSession", classmethod(lambda cls: None))
    monkeypatch.setattr(SparkSession.Builder, "getOrCreate", get)
    given = SparkSession.builder.master("spark://host:7077").config("spark.checkpoint.dir", "hdfs:///x")
    with pytest.raises(Stop):
        session.get_session(builder=given)
    assert made["spark.master"] == "spark://host:7077"
    assert made["spark.checkpoint.dir"] == "hdfs:///x"
    assert "spark.driver.memory" not in made
    made.clear()
    with pytest.raises(Stop):
        session.get_session(builder=SparkSession.builder.master("yarn"))
    assert "spark.checkpoint.dir" not in made
