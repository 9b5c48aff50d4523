"""Round trips through files and tables: dumps, sidecars, manifests, ORC,
versioned tables, spec documents, JDBC."""

import json
import os

import pytest
from pyspark.sql import functions as F

from dimflow.functions.cleanse import cleanse
from dimflow.operators import quality as Q
from dimflow.operators.projection import schema_lines
from dimflow.sinks import files as K
from dimflow.sinks import fs
from dimflow.sinks import tables as TB
from dimflow.sources import files as S
from dimflow.sources.jdbc import dictionary_from_schema, scan_jdbc
from dimflow.sources.specs import read_table_specs, read_table_specs_a, resolve_spec

from conftest import SF_SMALL


def _same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.mark.parametrize("sep", ["|", "\x01"])
def test_dump_round_trip(spark, tmp_path, sep):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text", "lang", "n_chars")
    clean = cleanse(docs, "pipe" if sep == "|" else "ctrl_a", columns=["text", "lang"])
    path = K.write_dump(clean, str(tmp_path), "2024010100", "documents", sep=sep, partitions=3)
    assert any(n.endswith(".gz") for n in os.listdir(path))
    back = S.read_delimited(spark, path, clean.schema, sep)
    good, bad = Q.split_rejects(back)
    assert bad.isEmpty()
    # cells come back as they were
    expect = clean.withColumn("text", F.when(F.col("text") != "", F.col("text")))
    assert _same(good, expect)


def test_round_trip_types_and_nulls(spark, tmp_path):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    path = K.write_dump(o, str(tmp_path), "b", "orders")
    back, _ = Q.split_rejects(S.read_delimited(spark, path, o.schema))
    assert _same(back, o)


def test_sidecar_manifest_and_check(spark, tmp_path):
    root = str(tmp_path)
    cust = spark.read.parquet(f"{SF_SMALL}/customer.parquet")
    data_dir = K.write_dump(cust, root, "b1", "customer", partitions=2)
    d = dictionary_from_schema(spark, cust, "customer")
    side = K.write_schema_sidecar(schema_lines(d), f"{data_dir}/customer.schema")
    text = fs.read_text_file(spark, side).splitlines()
    assert text[0] == "customer - - - - - - format - -"
    assert text[1] == "customer c_custkey - - - - - long - \"ends '\\001'\""
    files = S.list_batch(spark, data_dir)
    assert K.write_manifest(files.select(F.col("path").alias("url")), f"{data_dir}/manifest.json")
    entries, batches = S.read_manifests(spark, f"{data_dir}/manifest.json")
    check = Q.manifest_check(S.list_batch(spark, data_dir), entries, batches.where("valid"))
    assert [tuple(r) for r in check.select("n_extra", "n_missing", "complete").collect()] == [(0, 0, True)]
    # an extra file breaks completeness
    fs.write_text_file(spark, f"{data_dir}/stray.gz", "x")
    check2 = Q.manifest_check(S.list_batch(spark, data_dir), entries, batches.where("valid")).first()
    assert (check2.n_extra, check2.complete) == (1, False)


def test_manifest_shapes_and_invalid(spark, tmp_path):
    root = str(tmp_path)
    fs.write_text_file(spark, f"{root}/a/manifest.json", json.dumps({"entries": ["x.gz", "y.gz"]}))
    fs.write_text_file(spark, f"{root}/a/x.gz", "1")
    fs.write_text_file(spark, f"{root}/b/manifest.json",
                       json.dumps({"entries": [{"url": "s3://bucket/p/b/x.gz"}]}))
    fs.write_text_file(spark, f"{root}/b/x.gz", "1")
    fs.write_text_file(spark, f"{root}/c/manifest.json", "{not json")
    fs.write_text_file(spark, f"{root}/c/x.gz", "1")
    entries, batches = S.read_manifests(spark, f"{root}/*/manifest.json")
    files = S.list_batch(spark, root)
    res = {r.batch.rsplit("/", 1)[-1]: (r.n_extra, r.n_missing, r.complete)
           for r in Q.manifest_check(files, entries, batches.where("valid")).collect()}
    assert res == {"a": (0, 1, False), "b": (0, 0, True), "c": (1, 0, False)}


def test_orc_batch(spark, tmp_path):
    p = str(tmp_path / "orc")
    spark.read.parquet(f"{SF_SMALL}/nation.parquet").write.orc(p)
    df = S.read_orc(spark, p, ["n_name", "n_nationkey"])
    assert df.columns == ["n_name", "n_nationkey"] and df.count() == 25


def test_versioned_table_publish_append_truncate(spark, tmp_path):
    path = str(tmp_path / "dim")
    assert TB.current_version(spark, path) is None
    a = spark.createDataFrame([(1, "a")], "k int, v string")
    TB.publish(a, path)
    TB.append(spark.createDataFrame([(2, "b")], "k int, v string"), path, "2024010101")
    TB.append(spark.createDataFrame([(2, "b")], "k int, v string"), path, "2024010101")  # replay
    assert sorted(map(tuple, TB.read_table(spark, path).collect())) == [(1, "a"), (2, "b")]
    # a version without its marker stays invisible
    spark.createDataFrame([(9, "z")], "k int, v string").write.parquet(f"{path}/v=9/batch_id=snapshot")
    assert sorted(map(tuple, TB.read_table(spark, path).collect())) == [(1, "a"), (2, "b")]
    TB.truncate(spark, path, a.schema)
    assert TB.read_table(spark, path).count() == 0
    with pytest.raises(Q.LoadGateError):
        TB.load_staging(a, path) and TB.load_staging(a, path)


SPEC_B = {
    "version": "3",
    "groups": [
        {"tables": [
            {"name": "fact", "columns": [{"field_type": "METRIC", "output_name": "clicks"},
                                         {"field_type": "KEY", "output_name": "id"},
                                         {"field_type": "OTHER", "output_name": "junk"}],
             "db_name": "prod", "compression": "", "delimiter": "\u0001"},
            {"name": "dim", "sql": "select 1", "columns": [{"field_type": "METRIC", "output_name": "b"},
                                                           {"field_type": "KEY", "output_name": "a"}],
             "db_name": "d", "db_name_stg": "stg",
             "dimension": {"operation": "Insert", "operation_column": "a", "identity_column": "sk",
                           "truncate_before_load": "true"},
             "custom_insert_sql": {"replace_keys": {"unwanted_key": "dim.b", "wanted_key": "lk.val"},
                                   "join_table": "lk", "join_key": "a"}}]},
        {"tables": [
            {"name": "fact", "columns": [{"field_type": "KEY", "output_name": "day"}],
             "db_name": "prod2", "load_table": "fact_all"}]}]}


def test_read_table_specs(spark, tmp_path):
    p = str(tmp_path / "schema.json")
    fs.write_text_file(spark, p, json.dumps(SPEC_B))
    specs, cols = read_table_specs(spark, p)
    s = {r.name: r for r in specs.collect()}
    assert s["fact"].columns == "id,day,clicks"          # keys of both groups, then metrics
    assert s["fact"].db_name == "prod2" and s["fact"].load_table == "fact_all"  # last wins
    assert s["fact"].delimiter == "|" and s["fact"].compression is None and not s["fact"].is_dimension
    assert s["dim"].columns == "b,a" and s["dim"].is_sql
    assert s["dim"].column_string_with_identity == "b,a,sk"
    assert (s["dim"].operation, s["dim"].operation_column, s["dim"].truncate_before_load) == ("Insert", "a", True)
    assert s["dim"].insert_columns == ["lk.val", "dim.a"]
    assert cols.count() == 6
    bad = Q.validate_spec(specs.withColumn("operation_column", F.lit(None).cast("string")))
    assert [r.name for r in bad.collect()] == ["dim"]


def test_read_table_specs_a_and_resolve(spark, tmp_path):
    p = str(tmp_path / "a.json")
    fs.write_text_file(spark, p, json.dumps({"tables": [
        {"name": "t", "keys": ["a"], "metrics": "m", "db_name": "x"},
        {"name": "t", "keys": ["b", "c"], "metrics": "", "db_name": "y"}]}))
    r = read_table_specs_a(spark, p).first()
    assert (r.keys, r.db_name) == (["b", "c"], "y")
    assert resolve_spec(spark, str(tmp_path / "missing.json"), p) == p
    assert resolve_spec(spark, p, "local.json") == p
    assert resolve_spec(spark, p, "local.json", prefer_local=True) == "local.json"


def test_jdbc_partitioned_read_and_pushdown(spark, tmp_path):
    url = f"jdbc:derby:memory:dimflow{os.getpid()};create=true"
    cust = spark.read.parquet(f"{SF_SMALL}/customer.parquet")
    cust.write.format("jdbc").option("url", url).option("dbtable", "CUST") \
        .option("createTableColumnTypes", "c_name VARCHAR(64), c_mktsegment VARCHAR(32)").save()
    df = scan_jdbc(spark, url, "CUST", ["C_CUSTKEY", "C_NAME"], partition_column="C_CUSTKEY",
                   lower_bound=0, upper_bound=150, num_partitions=4)
    assert df.rdd.getNumPartitions() == 4
    delta = df.where(F.col("C_CUSTKEY") > 100)
    plan = delta._jdf.queryExecution().executedPlan().toString().lower()
    assert "pushedfilters: [*isnotnull(c_custkey), *greaterthan(c_custkey,100)]" in plan
    assert delta.count() == cust.where("c_custkey > 100").count()
    d = dictionary_from_schema(spark, df, "CUST")
    assert [r.column_name for r in d.orderBy("ordinal").collect()] == ["C_CUSTKEY", "C_NAME"]


def test_compact_folds_appends(spark, tmp_path):
    path = str(tmp_path / "log")
    for h in range(5):
        TB.append(spark.createDataFrame([(h, "x")], "h int, s string"), path, str(h))
    v = TB.current_version(spark, path)
    before = sorted(map(tuple, TB.read_table(spark, path).collect()))
    v2 = TB.compact(spark, path, partitions=1)
    assert v2 == v + 1
    assert sorted(map(tuple, TB.read_table(spark, path).collect())) == before
    assert [n for n in os.listdir(f"{path}/v={v2}") if n.startswith("batch_id=")] == ["batch_id=snapshot"]


def test_versions_are_claimed_once(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor
    path = str(tmp_path / "t")
    dfs = [spark.createDataFrame([(i,)], "k int") for i in range(8)]
    with ThreadPoolExecutor(8) as ex:
        versions = list(ex.map(lambda d: TB.publish(d, path), dfs))
    assert sorted(versions) == list(range(1, 9))
    assert TB.read_table(spark, path).count() == 1


def test_dump_parts_stay_small_as_the_table_grows(spark, tmp_path):
    """A part larger than the advisory size is split: ``partitions`` does not
    fix the size of a writing or reading task."""
    conf, size = spark.conf, "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = conf.get(size)
    rows = spark.range(0, 4000, 1, 8).select("id", F.sha2(F.col("id").cast("string"), 512).alias("s"))
    conf.set(size, "32KB")
    try:
        path = K.write_dump(rows, str(tmp_path), "b", "t", partitions=2)
    finally:
        conf.set(size, before)
    counts = [r[0] for r in spark.read.text(path).groupBy("_metadata.file_path")
              .count().select("count").collect()]
    assert len(counts) > 4 and max(counts) <= 800
    back = S.read_delimited(spark, path, rows.schema).select("id", "s")
    assert sorted(back.collect()) == sorted(rows.collect())
