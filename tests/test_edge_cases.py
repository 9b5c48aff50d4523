"""Hand-made edge inputs (FIXTURES.md §4): parsing, cleansing, keys, minutes,
failed-run stamps, upload logs."""

import datetime as dt

from pyspark.sql import Row
from pyspark.sql import functions as F

from dimflow.functions.cleanse import cleanse, separator
from dimflow.operators import load as L
from dimflow.operators import quality as Q
from dimflow.operators import runlog as RL
from dimflow.sources.files import parse_delimited


def test_parse_delimited_rules(spark):
    lines = ["1|a|2.5", "2|b", "3|c|4.5|extra", "x|d|1.0", "4||", "", '6|"q|9']
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    parsed = parse_delimited(df, [("id", "int"), ("name", "string"), ("price", "double")], "|")
    good, bad = Q.split_rejects(parsed)
    got = sorted(tuple(r) for r in good.collect())
    assert got == [(1, "a", 2.5), (2, "b", None), (4, None, None), (6, '"q', 9.0)]
    reasons = sorted((r.rejected_data, r.rejected_reason) for r in bad.collect())
    assert reasons == [("3|c|4.5|extra", "too many fields"), ("x|d|1.0", "bad value for id")]
    assert Q.reject_count(parsed).first().rejected_rows == 2


def test_parse_ctrl_a(spark):
    sep = separator("01")
    df = spark.createDataFrame([(f"1{sep}a|b{sep}3",)], "value string")
    row = parse_delimited(df, [("k", "long"), ("s", "string"), ("n", "int")], sep).first()
    assert (row.k, row.s, row.n, row._reject_reason) == (1, "a|b", 3, None)


def test_cleanse_profiles(spark):
    df = spark.createDataFrame([("a|b",), ("0000-00-00 00:00:00",), ("x\ty",)], "v string")
    assert [r.v for r in cleanse(df, "pipe").collect()] == ["a-b", "1970-01-01 12:00:00", "x\ty"]
    df2 = spark.createDataFrame([("NULL",), ("ANNULLED",), ("x\r",), ("4294967295",), ("14294967295",)],
                                "v string")
    assert [r.v for r in cleanse(df2, "ctrl_a").collect()] == ["", "ANED", "x", "0", "10"]
    assert [r.v for r in cleanse(df2, "ctrl_a", whole_cell=True).collect()] == \
        ["", "ANNULLED", "x\r", "0", "14294967295"]
    nums = spark.createDataFrame([(4294967295,)], "n long")
    assert cleanse(nums, "ctrl_a").first().n == "0"


def test_insert_new_keeps_null_and_duplicate_new_keys(spark):
    prod = spark.createDataFrame([(1, "p1"), (2, "p2")], "k int, v string")
    stg = spark.createDataFrame([(2, "s2"), (3, "s3a"), (3, "s3b"), (None, "sn")], "k int, v string")
    got = sorted(L.insert_new(stg, prod, "k").collect(), key=str)
    assert sorted(map(tuple, got), key=str) == sorted([(3, "s3a"), (3, "s3b"), (None, "sn")], key=str)


def test_upsert_one_row_per_key_and_idempotent(spark):
    prod = spark.createDataFrame([(1, 10, "old"), (2, 10, "keep")], "k int, ts int, v string")
    stg = spark.createDataFrame([(1, 20, "new"), (1, 15, "older"), (3, 5, "ins")], "k int, ts int, v string")
    once = L.upsert(prod, stg, "k", "ts")
    assert sorted(map(tuple, once.collect())) == [(1, 20, "new"), (2, 10, "keep"), (3, 5, "ins")]
    twice = L.upsert(once, stg, "k", "ts")
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, once.collect()))


def test_assign_identity_dense_across_partitions(spark):
    df = spark.range(0, 1000, 1, 7).select((F.col("id") * 3).alias("k")).repartition(5)
    out = L.assign_identity(df, "k", "sk", start=100)
    rows = sorted((r.k, r.sk) for r in out.collect())
    assert [sk for _, sk in rows] == list(range(101, 1101))


def test_next_interval_minutes_literal_and_true_carry(spark):
    base = dict(database_name="db", process_name="LOAD", status="COMPLETED", platform="t")
    log = spark.createDataFrame([
        Row(table_name="a", processed_utc_hour=473352, process_minute="202401010045", **base),
        Row(table_name="b", processed_utc_hour=473352, process_minute="202401010050", **base)])
    lit = {r.table_name: (r.next_minute, r.next_hour) for r in RL.next_interval(log, "minutes", 15).collect()}
    assert lit == {"a": ("202401010100", 473353), "b": ("202401010105", 473352)}
    true = {r.table_name: r.next_hour for r in RL.next_interval(log, "minutes", 15, carry="true").collect()}
    assert true == {"a": 473353, "b": 473353}


def test_failed_run_stamp_is_decimal_subtraction(spark):
    log = spark.createDataFrame([(202401010089, "FAILED", "p"), (202401010091, "FAILED", "p")],
                                "run_time bigint, status string, platform string")
    # 202401010105 - 15 = 202401010090 as a number
    assert RL.failed_runs(log, 202401010105, 15).first().failed_run_time == 202401010089
    # with real minutes the bound is 202401002350 and neither stamp qualifies
    assert RL.failed_runs(log, 202401010105, 15, true_time=True).count() == 0


def test_next_contiguous_hour_without_processing_is_null(spark):
    h = dt.datetime(2024, 1, 1, 5)
    up = spark.createDataFrame([(h, "COMPLETED", 0)], "load_hour timestamp_ntz, status string, is_forced int")
    assert RL.next_contiguous_hour(up, "2024-01-01 00:00:00").first().next_hour is None


def test_time_functions_ignore_session_zone(spark):
    from dimflow.functions.timeutil import hour_ts, to_pacific, utc_hour
    df = spark.createDataFrame([(dt.datetime(2024, 3, 10, 10, 30),)], "ts timestamp_ntz")
    q = df.select(utc_hour("ts").alias("h"), hour_ts(utc_hour("ts")).alias("t"), to_pacific("ts").alias("p"))
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
        a = q.first()
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        b = q.first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert a == b
    assert a.h == int(dt.datetime(2024, 3, 10, 10, tzinfo=dt.timezone.utc).timestamp() // 3600)
    assert a.p == dt.datetime(2024, 3, 10, 3, 30)  # PDT started 2024-03-10 10:00 UTC


def _values_fixture(spark, name):
    """A FIXTURES.md §3 VALUES fixture (hand-made input) as a DataFrame."""
    import re
    from conftest import ROOT
    text = open(f"{ROOT}/FIXTURES.md").read()
    sql = re.search(rf"-- {name}\n(.*?)```", text, re.S).group(1)
    return spark.sql(sql)


def test_schema_lines_on_handmade_dictionary(spark):
    from dimflow.operators.projection import schema_lines
    d = _values_fixture(spark, "fx_dictionary")
    views = spark.createDataFrame([("dim", "vw_dim")], "table_name string, view_name string")
    lines = [r.line for r in schema_lines(d, views).orderBy("ordinal").collect()]
    end = " - \"ends '\\001'\""
    assert lines == ["dim - - - - - - format - -"] + [
        f"dim {c} - - - - - {t}{end}" for c, t in [
            ("id", "long"), ("name", "string"), ("kind", "string"), ("price", "double"),
            ("ratio", "double"), ("flag", "int"), ("n", "int"), ("made", "string"),
            ("ora_n", "int"), ("ora_s", "string"), ("t", "time")]]


def test_spec_columns_on_handmade_entries(spark):
    from dimflow.operators.projection import spec_columns
    cols = _values_fixture(spark, "fx_spec_columns")
    got = {r.table_name: (r.columns, r.n_dropped) for r in spec_columns(cols).collect()}
    assert got == {"a": ("id,name,clicks,cost", 1), "b": ("k", 0)}
    sql = spark.createDataFrame([("a",)], "table_name string")
    got_sql = {r.table_name: r.columns for r in spec_columns(cols, sql).collect()}
    assert got_sql["a"] == "clicks,id,name,junk,cost"


def test_tables_from_ini(spark, tmp_path):
    from dimflow.operators.registry import tables_from_config, tables_from_ini
    from dimflow.sinks import fs
    p = str(tmp_path / "schema.ini")
    fs.write_text_file(spark, p, "[users]\ncolumns = id,name\ncolumns_mysql = id,name,updated_at\n\n"
                                 "[plans]\ncolumns = plan_id,price\n")
    secs = tables_from_ini(spark, p)
    assert sorted(map(tuple, secs.collect())) == [("plans", "plan_id,price"), ("users", "id,name,updated_at")]
    work = tables_from_config(secs, "config")
    assert {tuple(r) for r in work.collect()} == {("plans", "config", 0, 1, "", 1), ("users", "config", 0, 1, "", 1)}
    one = tables_from_config(secs, "config", single_table="users").collect()
    assert [tuple(r) for r in one] == [("users", "config", 1, 1, "", 1)]


def test_oracle_profile_and_delimited_nulls(spark):
    from dimflow.functions.cleanse import to_delimited
    df = spark.createDataFrame([("a\r\nb", None, 4294967295)], "s string, t string, n long")
    out = cleanse(df, "oracle")
    assert out.first().s == "a\nb" and out.first().n == 4294967295
    assert to_delimited(out, separator("01")).first().line == "a\nb\x01\x014294967295"


def test_manual_minute_hour(spark):
    from dimflow.functions.timeutil import hour_of_minute
    h = spark.range(1).select(hour_of_minute(F.lit("202401010045")).alias("h")).first().h
    assert h == int(dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc).timestamp() // 3600)


def test_log_event_appenders(spark, tmp_path):
    from dimflow.sinks import tables as TB
    p = str(tmp_path / "trf")
    TB.append_load_event(spark, p, "db", "t", "LOAD", 473352, "STARTED", "x")
    TB.append_load_event(spark, p, "db", "t", "LOAD", 473352, "COMPLETED", "x", minute="202401010045")
    TB.append_load_event(spark, p, "db", "t", "LOAD", 473352, "STARTED", "x")      # replayed: no duplicate
    rows = sorted((r.status, r.process_minute) for r in TB.read_table(spark, p).collect())
    assert rows == [("COMPLETED", "202401010045"), ("STARTED", None)]
    a = str(tmp_path / "agg")
    TB.append_agg_event(spark, a, "h1", 7, 473352, "RUNNING", "p")
    r = TB.read_table(spark, a).first()
    assert (r.host_name, r.job_id, r.status, r.platform) == ("h1", 7, "RUNNING", "p") and r.inserted_at is not None
    rl = str(tmp_path / "run")
    TB.append_run_event(spark, rl, 1, 2, "completed", row_count=10, file_name="f.gz", lines=12)
    r = TB.read_table(spark, rl).first()
    assert (r.loaded_records, r.file_name, r.lines_in_file) == (10, "f.gz", 12)


def test_prev_status_zero_interval_is_today(spark):
    log = spark.createDataFrame([
        (1, 7, dt.datetime(2024, 1, 14, 0, 0), "error "),
        (2, 7, dt.datetime(2024, 1, 15, 9, 0), "started"),
        (3, 8, dt.datetime(2024, 1, 14, 9, 0), "error")],
        "run_id bigint, job_id int, run_date timestamp_ntz, status string")
    today = {r.job_id: r.status for r in RL.prev_status(log, 0, "2024-01-15").collect()}
    assert today == {7: "started", 8: "completed"}
    anyt = {r.job_id: r.status for r in RL.prev_status(log, 5).collect()}
    assert anyt == {7: "started", 8: "error"}
