"""End-to-end jobs on the TESTDATA tables: extract -> load -> refresh."""

import datetime as dt
import json

from pyspark.sql import functions as F

from dimflow.operators import runlog as RL
from dimflow.plans import jobs as J
from dimflow.sinks import fs
from dimflow.sinks import tables as TB
from dimflow.session import ensure_checkpoint_dir

from conftest import SF_SMALL

UPDATE_LOG = "table_name string, update_date timestamp_ntz, uploaded_to_vertica string, log_id bigint"


def _sources(spark):
    cust = spark.read.parquet(f"{SF_SMALL}/customer.parquet").withColumn(
        "updated_at", F.timestamp_add("DAY", F.col("c_custkey").cast("int"),
                                      F.to_timestamp_ntz(F.lit("2024-01-01 00:00:00"))))
    nation = spark.read.parquet(f"{SF_SMALL}/nation.parquet")
    views = {"customer": cust, "vw_customer": cust.where(F.col("c_custkey") >= 0), "nation": nation}
    return lambda name: views[name]


def _registry(spark):
    return spark.createDataFrame([
        ("customer", "dimensions", "config", 1, 0, 0, "vw_customer", 1, "LIVE",
         "c_custkey,c_name,c_acctbal,updated_at", "c_custkey", "c_acctbal"),
        ("nation", "dimensions", "config", 0, 1, 0, "", 1, "LIVE", None, "n_nationkey,n_name", None),
    ], "table_name string, database_name string, mysql_db string, is_delta int, reload_table int, "
       "always_reload int, view_name string, is_loading_enabled int, status string, mysql_keys string, "
       "stats_keys string, measures string")


SPEC = {"version": "1", "groups": [{"tables": [
    {"name": "customer", "db_name": "dim", "db_name_stg": "stg", "sql": "x",
     "columns": [{"field_type": "KEY", "output_name": c} for c in ["c_custkey", "c_name", "c_acctbal", "updated_at"]],
     "dimension": {"operation": "Insert", "operation_column": "c_custkey"}},
    {"name": "nation", "db_name": "dim",
     "columns": [{"field_type": "KEY", "output_name": "n_nationkey"}, {"field_type": "METRIC", "output_name": "n_name"}]},
]}]}


def test_extract_then_load_insert_only(spark, tmp_path):
    ensure_checkpoint_dir(spark)
    root, wh = str(tmp_path / "dumps"), str(tmp_path / "wh")
    read = _sources(spark)
    reg = _registry(spark)
    empty_log = spark.createDataFrame([], UPDATE_LOG)
    res = J.extract(spark, reg, read, root, "2024/01/01/00", empty_log, now="2024-03-01 00:00:00", threads=2)
    assert res.successes == ["customer", "nation"] and res.errors == []
    assert res.reload_flags == {"customer": 0, "nation": 1}
    # a marker for the delta table was written before its scan
    assert [r.table_name for r in res.update_log.collect()] == ["customer"]
    spec = str(tmp_path / "schema.json")
    fs.write_text_file(spark, spec, json.dumps(SPEC))
    log = str(tmp_path / "trf_log")
    r1 = J.load(spark, "customer", f"{res.location}/customer", spec, f"{wh}/customer",
                stg_path=f"{wh}/stg/customer", log_path=log, hour=473352)
    assert r1.status == "loaded"
    prod = TB.read_table(spark, f"{wh}/customer")
    assert prod.count() == 150 and prod.columns == ["c_custkey", "c_name", "c_acctbal", "updated_at"]
    # staging is truncated after the insert
    assert TB.read_table(spark, f"{wh}/stg/customer").count() == 0
    # the same batch does not load twice
    assert J.load(spark, "customer", f"{res.location}/customer", spec, f"{wh}/customer",
                  stg_path=f"{wh}/stg/customer", log_path=log, hour=473352).status == "already loaded"
    # nation: direct load
    r2 = J.load(spark, "nation", f"{res.location}/nation", spec, f"{wh}/nation", log_path=log, hour=473352)
    assert r2.status == "loaded" and TB.read_table(spark, f"{wh}/nation").count() == 25
    events = TB.read_table(spark, log)
    assert RL.last_load_hour(events).where("table_name = 'customer'").first().last_load_hour == 473352

    # next run: customer as delta after the marker is completed (watermark 2024-03-01) -> only later rows
    completed = res.update_log.withColumn("uploaded_to_vertica", F.lit("complete"))
    res2 = J.extract(spark, reg, read, root, "2024/01/01/01", completed, now="2024-06-01 00:00:00", threads=2)
    back = spark.read.text(f"{res2.location}/customer")
    expect = read("vw_customer").where(F.col("updated_at") > F.to_timestamp_ntz(F.lit("2024-03-01 00:00:00")))
    assert back.count() == expect.count() > 0
    r3 = J.load(spark, "customer", f"{res2.location}/customer", spec, f"{wh}/customer",
                stg_path=f"{wh}/stg/customer", log_path=log, hour=473353)
    assert r3.status == "loaded" and TB.read_table(spark, f"{wh}/customer").count() == 150


def test_refresh_dimensions_end_to_end(spark, tmp_path):
    ensure_checkpoint_dir(spark)
    root, wh = str(tmp_path / "dumps"), str(tmp_path / "wh")
    reg_path, upd_path = str(tmp_path / "registry"), str(tmp_path / "update_log")
    TB.publish(_registry(spark), reg_path)
    TB.publish(spark.createDataFrame([], UPDATE_LOG), upd_path)
    spec = str(tmp_path / "schema.json")
    fs.write_text_file(spark, spec, json.dumps(SPEC))
    hour = int(dt.datetime(2024, 1, 2, 3, tzinfo=dt.timezone.utc).timestamp() // 3600)
    out = J.refresh_dimensions(spark, reg_path, upd_path, _sources(spark), root, wh, spec, hour, threads=2)
    assert out["loaded"] == ["customer", "nation"] and out["failed"] == []
    assert out["location"].endswith("2024/01/02/03")
    doc = json.loads(fs.read_text_file(spark, f"{out['location']}/schema/schema.json"))
    assert doc["tables"][0]["name"] == "nation" and doc["tables"][-1]["name"] == "all_keys_and_measures"
    reg = {r.table_name: r for r in TB.read_table(spark, reg_path).collect()}
    assert reg["nation"].reload_table == 0 and reg["nation"].latest_loaded_date is not None
    upd = TB.read_table(spark, upd_path).collect()
    assert [(r.table_name, r.uploaded_to_vertica) for r in upd] == [("customer", "complete")]


def test_rerun_failed_and_backfill(spark, tmp_path):
    ensure_checkpoint_dir(spark)
    root = str(tmp_path / "dumps")
    ll = str(tmp_path / "load_log")
    TB.publish(spark.createDataFrame([(202401010000, "FAILED", "other"), (202401010100, "COMPLETED", "other")],
                                     "run_time bigint, status string, platform string"), ll)
    reg = _registry(spark).withColumn("status", F.lit("LIVE"))
    res = J.rerun_failed(spark, ll, "other", 202401020000, reg, _sources(spark), root, threads=2)
    assert res.location.endswith("/202401010000") and res.manifest_written
    assert fs.exists(spark, f"{res.location}/customer/customer.schema")
    st = {r.run_time: r.status for r in TB.read_table(spark, ll).collect()}
    assert st[202401010000] == "COMPLETED"
    bf = J.backfill(spark, "2023121500", reg, _sources(spark), root, threads=2)
    assert bf.location.endswith("/2023121500") and bf.successes == ["customer", "nation"]


def test_rerun_keeps_what_other_runs_logged(spark, tmp_path):
    ensure_checkpoint_dir(spark)
    ll, schema = str(tmp_path / "load_log"), "run_time bigint, status string, platform string"
    TB.publish(spark.createDataFrame([(202401010000, "FAILED", "other")], schema), ll)
    reg = _registry(spark).withColumn("status", F.lit("LIVE"))
    sources, added = _sources(spark), []

    def read_source(name):
        if not added:                                    # another run logs meanwhile
            added.append(name)
            TB.publish(TB.read_table(spark, ll).unionAll(
                spark.createDataFrame([(202401010200, "STARTED", "other")], schema)), ll)
        return sources(name)
    J.rerun_failed(spark, ll, "other", 202401020000, reg, read_source, str(tmp_path / "dumps"), threads=1)
    assert {(r.run_time, r.status) for r in TB.read_table(spark, ll).collect()} == {
        (202401010000, "COMPLETED"), (202401010200, "STARTED")}


def test_dump_run_logs_and_load_advances_summary(spark, tmp_path):
    ensure_checkpoint_dir(spark)
    root, wh = str(tmp_path / "dumps"), str(tmp_path / "wh")
    reg = _registry(spark).withColumn("status", F.lit("LIVE"))
    ll, rl = str(tmp_path / "dim_load_log"), str(tmp_path / "run_log")
    res = J.dump_run(spark, reg, _sources(spark), root, "202401020300", version="other",
                     load_log_path=ll, run_log_path=rl, threads=2)
    assert res.errors == [] and res.manifest_written
    assert [tuple(r) for r in TB.read_table(spark, ll).collect()] == [(202401020300, "COMPLETED", "other")]
    assert sorted(r.status for r in TB.read_table(spark, rl).collect()) == ["completed", "started"]
    # load nation from that batch (ctrl-A dump with sidecar); summary high-water advances for host1 only
    spec = str(tmp_path / "schema.json")
    spec_doc = json.loads(json.dumps(SPEC))
    spec_doc["groups"][0]["tables"][1]["delimiter"] = "\u0001"
    fs.write_text_file(spark, spec, json.dumps(spec_doc))
    summ = str(tmp_path / "summary")
    TB.publish(spark.createDataFrame(
        [("nation", 1, None), ("nation", 2, dt.datetime(2030, 1, 1)), ("other", 1, None)],
        "table_name string, reporting_database_server_id int, latest_loaded_date timestamp_ntz"), summ)
    servers = spark.createDataFrame([(1, "host1"), (2, "host1"), (3, "host2")], "id int, host_name string")
    hour = int(dt.datetime(2024, 1, 2, 3, tzinfo=dt.timezone.utc).timestamp() // 3600)
    r = J.load(spark, "nation", f"{res.location}/nation", spec, f"{wh}/nation", hour=hour,
               platform="test_data", summary_path=summ, servers=servers, host="host1")
    assert r.status == "loaded"
    loaded = TB.read_table(spark, f"{wh}/nation")
    assert loaded.count() == 25 and "load_epoch_ts" in loaded.columns        # P4 for test_data
    got = {(x.table_name, x.reporting_database_server_id): x.latest_loaded_date
           for x in TB.read_table(spark, summ).collect()}
    assert got[("nation", 1)] == dt.datetime(2024, 1, 1, 19)                 # 03:00 UTC in PST
    assert got[("nation", 2)] == dt.datetime(2030, 1, 1)                     # later value kept
    assert got[("other", 1)] is None


def test_extract_over_jdbc_with_view_and_delta(spark, tmp_path):
    """E1 against an operational database (embedded Derby, in-process): the
    registry names the database, the view substitutes for the table, and the
    delta predicate is pushed into the database's SELECT."""
    import os
    from dimflow.sources.jdbc import jdbc_reader
    ensure_checkpoint_dir(spark)
    url = f"jdbc:derby:memory:dimsrc{os.getpid()};create=true"
    cust = _sources(spark)("customer").select("c_custkey", "c_name", "c_acctbal", "updated_at")
    cust.write.format("jdbc").option("url", url).option("dbtable", "CUSTOMER") \
        .option("createTableColumnTypes", "c_name VARCHAR(64)").save()
    conn = spark._jvm.java.sql.DriverManager.getConnection(url)
    conn.createStatement().execute('CREATE VIEW VW_CUSTOMER AS SELECT * FROM CUSTOMER WHERE "c_custkey" < 120')
    conn.close()
    reg = spark.createDataFrame([
        ("CUSTOMER", "dimensions", "config", 1, 0, 0, "VW_CUSTOMER", 1, "LIVE",
         "c_custkey,c_name,c_acctbal,updated_at", "c_custkey", None)],
        "table_name string, database_name string, mysql_db string, is_delta int, reload_table int, "
        "always_reload int, view_name string, is_loading_enabled int, status string, mysql_keys string, "
        "stats_keys string, measures string")
    log = spark.createDataFrame([("CUSTOMER", dt.datetime(2024, 3, 1), "complete", 1)], UPDATE_LOG)
    read = jdbc_reader(spark, {"config": url})
    res = J.extract(spark, reg, read, str(tmp_path), "b1", log, now="2024-06-01 00:00:00", threads=1)
    assert res.successes == ["CUSTOMER"]
    lines = spark.read.text(f"{res.location}/CUSTOMER").collect()
    # rows of the view only, changed after the watermark (day 60 = 2024-03-01 -> keys 61..119)
    keys = sorted(int(r.value.split("|")[0]) for r in lines)
    assert keys == list(range(61, 120))


def test_load_requires_complete_batch(spark, tmp_path):
    """E1 (manifest written) -> E2 with the completeness gate: loads while the
    folder matches the manifest, refuses once a listed file is missing."""
    ensure_checkpoint_dir(spark)
    root, wh = str(tmp_path / "dumps"), str(tmp_path / "wh")
    reg = _registry(spark).withColumn("status", F.lit("LIVE"))
    res = J.extract(spark, reg, _sources(spark), root, "202401020300", version="other", threads=2)
    assert res.manifest_written
    spec = str(tmp_path / "schema.json")
    doc = json.loads(json.dumps(SPEC))
    doc["groups"][0]["tables"][1]["delimiter"] = "\u0001"
    fs.write_text_file(spark, spec, json.dumps(doc))
    r = J.load(spark, "nation", f"{res.location}/nation", spec, f"{wh}/nation", hour=1, require_manifest=True)
    assert r.status == "loaded"
    # drop one data file of customer: the manifest no longer matches
    import os
    cdir = f"{res.location}/customer"
    victim = sorted(n for n in os.listdir(cdir) if n.endswith(".gz"))[0]
    os.remove(f"{cdir}/{victim}")
    r2 = J.load(spark, "customer", cdir, spec, f"{wh}/customer", stg_path=f"{wh}/stg/customer", hour=1,
                require_manifest=True)
    assert r2.status == "batch incomplete"


def test_direct_load_routes_to_load_table_and_checks_epoch(spark, tmp_path):
    """K10 (two sources into one table via load_table), P4 epoch column and
    the Q6 staging-environment check on the direct path."""
    ensure_checkpoint_dir(spark)
    root, wh = str(tmp_path / "dumps"), str(tmp_path / "wh")
    reg = _registry(spark)
    res = J.extract(spark, reg, _sources(spark), root, "b", None, threads=2)
    spec = str(tmp_path / "schema.json")
    doc = json.loads(json.dumps(SPEC))
    doc["groups"][0]["tables"][1]["load_table"] = "nation_all"
    fs.write_text_file(spark, spec, json.dumps(doc))
    for i, h in enumerate([10, 11]):
        r = J.load(spark, "nation", f"{res.location}/nation", spec, f"{wh}/nation", hour=h,
                   env="staging", load_epoch=1000 + i)
        assert r.status == "loaded"
    both = TB.read_table(spark, f"{wh}/nation_all")
    assert both.count() == 50
    assert sorted(r.load_epoch_ts for r in both.select("load_epoch_ts").distinct().collect()) == [1000, 1001]


def test_refresh_marks_only_tables_loaded_on_every_target(spark, tmp_path):
    ensure_checkpoint_dir(spark)
    root = str(tmp_path / "dumps")
    reg_path, upd_path = str(tmp_path / "registry"), str(tmp_path / "update_log")
    TB.publish(_registry(spark), reg_path)
    TB.publish(spark.createDataFrame([], UPDATE_LOG), upd_path)
    spec = str(tmp_path / "schema.json")
    fs.write_text_file(spark, spec, json.dumps(SPEC))
    good_wh, bad_wh = str(tmp_path / "wh1"), str(tmp_path / "wh2")
    # the second cluster's customer staging table is not empty: its load must fail (Q4)
    TB.publish(spark.createDataFrame([(1, "x", 1.0, dt.datetime(2024, 1, 1))],
                                     "c_custkey bigint, c_name string, c_acctbal double, updated_at timestamp_ntz"),
               f"{bad_wh}/stg/customer")
    out = J.refresh_dimensions(spark, reg_path, upd_path, _sources(spark), root, [good_wh, bad_wh], spec,
                               473400, threads=2)
    assert out["loaded"] == ["nation"] and out["failed"] == [("customer", bad_wh)]
    assert TB.read_table(spark, f"{good_wh}/customer").count() == 150     # the good cluster got it
    reg = {r.table_name: r for r in TB.read_table(spark, reg_path).collect()}
    assert reg["customer"].latest_loaded_date is None and reg["nation"].latest_loaded_date is not None
    upd = TB.read_table(spark, upd_path).collect()
    assert [(r.table_name, r.uploaded_to_vertica) for r in upd] == [("customer", "downloaded")]


def test_load_waits_for_dependency_unless_success_marker(spark, tmp_path):
    """Q1: a table loads only after the batch it depends on is complete; Q3:
    a _SUCCESS marker (trusted for HDFS output) short-circuits the checks."""
    import os
    ensure_checkpoint_dir(spark)
    root, wh = str(tmp_path / "dumps"), str(tmp_path / "wh")
    reg = _registry(spark).withColumn("status", F.lit("LIVE"))
    res = J.extract(spark, reg, _sources(spark), root, "202401020300", version="other", threads=2)
    spec = str(tmp_path / "schema.json")
    doc = json.loads(json.dumps(SPEC))
    doc["groups"][0]["tables"][1]["delimiter"] = "\u0001"
    fs.write_text_file(spark, spec, json.dumps(doc))
    cdir, ndir = f"{res.location}/customer", f"{res.location}/nation"
    victim = sorted(n for n in os.listdir(cdir) if n.endswith(".gz"))[0]
    os.remove(f"{cdir}/{victim}")                       # the dependency is now incomplete
    r = J.load(spark, "nation", ndir, spec, f"{wh}/nation", hour=1, dependent_dir=cdir)
    assert r.status == "dependency incomplete"
    assert os.path.exists(f"{ndir}/_SUCCESS")            # written by the committing dump job
    r2 = J.load(spark, "nation", ndir, spec, f"{wh}/nation", hour=1, dependent_dir=cdir,
                trust_success_marker=True)
    assert r2.status == "loaded"


def test_load_staging_branches_lookup_positional_identity(spark, tmp_path):
    """E2 through staging for the remaining operations: J2 (custom insert with
    a lookup join, key swapped), P7 (positional insert) and P5 (dimension
    insert with an identity column continuing production's)."""
    from dimflow.sinks import files as K
    ensure_checkpoint_dir(spark)
    wh = str(tmp_path / "wh")
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").select("l_orderkey", "l_partkey", "l_linenumber")
    part = spark.read.parquet(f"{SF_SMALL}/part.parquet")
    cust = spark.read.parquet(f"{SF_SMALL}/customer.parquet").select("c_custkey", "c_name")
    dumps = str(tmp_path / "dumps")
    dirs = {"fact_lines": K.write_dump(li, dumps, "b", "fact_lines", partitions=2),
            "fact_plain": K.write_dump(li, dumps, "b", "fact_plain", partitions=2),
            "dim_cust": K.write_dump(cust, dumps, "b", "dim_cust", partitions=2)}
    li_cols = [{"field_type": "KEY", "output_name": c} for c in ["l_orderkey", "l_partkey", "l_linenumber"]]
    spec = {"version": "1", "groups": [{"tables": [
        {"name": "fact_lines", "db_name": "f", "db_name_stg": "stg", "sql": "x", "columns": li_cols,
         "custom_insert_sql": {"replace_keys": {"unwanted_key": "fact_lines.l_partkey", "wanted_key": "part.p_brand"},
                               "join_table": "part", "join_key": "l_partkey"}},
        {"name": "fact_plain", "db_name": "f", "db_name_stg": "stg", "sql": "x", "columns": li_cols},
        {"name": "dim_cust", "db_name": "d", "db_name_stg": "stg", "sql": "x",
         "columns": [{"field_type": "KEY", "output_name": c} for c in ["c_custkey", "c_name"]],
         "dimension": {"operation": "Insert", "operation_column": "c_custkey", "identity_column": "sk"}}]}]}
    sp = str(tmp_path / "schema.json")
    fs.write_text_file(spark, sp, json.dumps(spec))
    types = {"l_orderkey": "long", "l_partkey": "long", "l_linenumber": "int", "c_custkey": "long", "c_name": "string"}
    for t, d in dirs.items():
        cols = ["c_custkey", "c_name"] if t == "dim_cust" else ["l_orderkey", "l_partkey", "l_linenumber"]
        lines = [f"{t} - - - - - - format - -"] + [f"{t} {c} - - - - - {types[c]} - x" for c in cols]
        fs.write_text_file(spark, f"{d}/{t}.schema", "\n".join(lines) + "\n")
    joined = li.join(part, li.l_partkey == part.p_partkey).count()
    # The first load creates the table from the lookup output, the second appends to it
    lookup = {"part": part.withColumnRenamed("p_partkey", "l_partkey")}
    for h in (1, 2):
        assert J.load(spark, "fact_lines", dirs["fact_lines"], sp, f"{wh}/fact_lines",
                      stg_path=f"{wh}/stg/fact_lines", hour=h, lookups=lookup, platform="other").status == "loaded"
    out = TB.read_table(spark, f"{wh}/fact_lines")
    assert out.count() == 2 * joined and out.where(~F.col("l_partkey").startswith("Brand#")).count() == 0
    # The second load inserts by position into the table the first created
    for h in (1, 2):
        J.load(spark, "fact_plain", dirs["fact_plain"], sp, f"{wh}/fact_plain",
               stg_path=f"{wh}/stg/fact_plain", hour=h, platform="other")
    assert TB.read_table(spark, f"{wh}/fact_plain").count() == 2 * li.count()
    # P5: production holds sk 1..50 for the first customers; new ones continue the sequence
    first = cust.where("c_custkey < 50")
    TB.publish(first.withColumn("sk", (F.col("c_custkey") + 1).cast("bigint")), f"{wh}/dim_cust")
    J.load(spark, "dim_cust", dirs["dim_cust"], sp, f"{wh}/dim_cust", stg_path=f"{wh}/stg/dim_cust", hour=1)
    dim = TB.read_table(spark, f"{wh}/dim_cust")
    assert dim.count() == cust.count()
    assert sorted(r.sk for r in dim.collect()) == list(range(1, cust.count() + 1))
