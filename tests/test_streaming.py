"""Streaming micro-batch load: exactly-once files, insert-if-absent."""

from pyspark.sql import functions as F

from dimflow.session import ensure_checkpoint_dir
from dimflow.sinks import files as K
from dimflow.sinks import tables as TB
from dimflow.streaming import stream_load

from conftest import SF_SMALL


def test_stream_load_two_batches_then_restart(spark, tmp_path):
    ensure_checkpoint_dir(spark)
    root, prod = str(tmp_path / "dumps"), str(tmp_path / "prod")
    cust = spark.read.parquet(f"{SF_SMALL}/customer.parquet").select("c_custkey", "c_name")
    K.write_dump(cust.where("c_custkey < 100"), root, "b1", "customer", partitions=2)
    K.write_dump(cust.where("c_custkey >= 50"), root, "b2", "customer", partitions=2)
    ck = str(tmp_path / "ck")
    schema = [("c_custkey", "long"), ("c_name", "string")]
    q = stream_load(spark, f"{root}/*/customer", schema, prod, key="c_custkey", checkpoint=ck,
                    max_files_per_trigger=1)
    q.awaitTermination(300)
    out = TB.read_table(spark, prod)
    # every key once: overlapping batches insert only absent keys
    assert out.count() == 150 and out.select("c_custkey").distinct().count() == 150
    # a restart with the same checkpoint reads no file twice
    q2 = stream_load(spark, f"{root}/*/customer", schema, prod, key="c_custkey", checkpoint=ck)
    q2.awaitTermination(300)
    assert TB.read_table(spark, prod).count() == 150
    assert out.where(F.col("c_name").isNull()).count() == 0
