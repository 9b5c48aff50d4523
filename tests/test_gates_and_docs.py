"""Gates that stop a job, and the single-document writers."""

import json
import os

import pytest
from pyspark.sql import functions as F

from dimflow.operators import quality as Q
from dimflow.operators.registry import schema_doc_rows
from dimflow.sinks import files as K
from dimflow.sinks import fs
from dimflow.sources.jdbc import column_dictionary_jdbc

from conftest import SF_SMALL


def test_gates(spark):
    empty = spark.createDataFrame([], "k int")
    one = spark.createDataFrame([(1,)], "k int")
    Q.assert_empty(empty)                                   # Q4 passes
    with pytest.raises(Q.LoadGateError):
        Q.assert_empty(one)
    Q.assert_nonempty(one)                                  # Q6 / Q7 pass
    with pytest.raises(Q.LoadGateError):
        Q.assert_nonempty(empty)
    assert Q.check_rejects(3, None) == 3                    # Q5: reported, no limit
    assert Q.check_rejects(3, 5) == 3
    with pytest.raises(Q.LoadGateError):
        Q.check_rejects(6, 5)


def test_schema_doc_and_max_hour(spark, tmp_path):
    from dimflow.plans.fixtures import fixture
    reg = fixture(spark, SF_SMALL, "fx_registry")
    p = K.write_schema_doc(schema_doc_rows(reg), str(tmp_path / "schema.json"))
    doc = json.loads(fs.read_text_file(spark, p))
    names = [t["name"] for t in doc["tables"]]
    assert names == sorted(names, reverse=True)
    summary = [t for t in doc["tables"] if t["name"] == "all_keys_and_measures"][0]
    assert summary["metrics"] == "clicks,cost" and summary["db_name"] == ""
    enabled = reg.where("is_loading_enabled = 1").select("table_name").distinct().count()
    assert len(doc["tables"]) == enabled + 1
    one = [t for t in doc["tables"] if t["name"] != "all_keys_and_measures"][0]
    assert isinstance(one["keys"], list) and one["metrics"] in ("", "clicks,cost")
    m = K.write_max_hour(spark, str(tmp_path / "part-00000-data_max_utc_hour.csv"), 473352)
    assert fs.read_text_file(spark, m) == "473352"


def test_dictionary_query_over_jdbc(spark):
    """The dictionary query text, run through JDBC (an in-process Derby
    stands in for the database; its information_schema table is made here)."""
    url = f"jdbc:derby:memory:dict{os.getpid()};create=true"
    conn = spark._jvm.java.sql.DriverManager.getConnection(url)
    st = conn.createStatement()
    st.execute("CREATE SCHEMA information_schema")
    st.execute("CREATE TABLE information_schema.columns (table_name VARCHAR(64), column_name VARCHAR(64), "
               "data_type VARCHAR(32))")
    for c, t in [("id", "bigint"), ("name", "varchar"), ("price", "decimal"), ("other", "int")]:
        st.execute(f"INSERT INTO information_schema.columns VALUES ('vw_dim', '{c}', '{t}')")
    conn.close()
    d = column_dictionary_jdbc(spark, url, "vw_dim", ["price", "id", "name"])
    rows = [tuple(r) for r in d.orderBy("ordinal").collect()]
    assert rows == [("vw_dim", "price", "decimal", 1), ("vw_dim", "id", "bigint", 2),
                    ("vw_dim", "name", "varchar", 3)]
