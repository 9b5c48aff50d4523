"""Session helpers: one place that knows how a dimflow job wants Spark set up.

On a cluster the session already exists and carries its own settings; these
helpers only fill in what is unset (tests, bench, local runs).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark import SparkConf, SparkContext
from pyspark.sql import SparkSession

# Settings every dimflow job relies on.  AQE re-plans joins from runtime sizes
# (the only broadcast decision we let happen implicitly), coalesces small
# shuffle partitions and splits skewed ones.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.inferTimestampNTZ.enabled": "true",
    # checkpoint files of unreferenced RDDs are removed from the shared folder
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def _given(builder) -> dict[str, str]:
    """Settings that the caller's builder or spark-submit has made."""
    given = {}
    if "PYSPARK_GATEWAY_PORT" in os.environ:              # started by spark-submit
        SparkContext._ensure_initialized()
        given.update(SparkConf().getAll())
    given.update(builder._options)
    return given


def get_session(master: str | None = None, app: str = "dimflow",
                shuffle_partitions: int | None = None, builder=None) -> SparkSession:
    """Return the active session, or build one: what ``builder`` or
    spark-submit sets stays; only for a local master (tests, bench) are memory,
    partitions and a checkpoint folder filled in."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = builder or SparkSession.builder
    given = _given(builder)
    master = master or given.get("spark.master") or f"local[{cpus}]"
    fill = {"spark.app.name": app, **_DEFAULTS}
    if shuffle_partitions:
        fill["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master.startswith("local"):
        fill = {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
                "spark.driver.memory": "16g", "spark.sql.shuffle.partitions": cpus, **fill}
        if "spark.checkpoint.dir" not in given:
            fill["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="dimflow-ckpt-")
    for k, v in fill.items():
        if k not in given:
            builder = builder.config(k, v)
    spark = builder.master(master).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder used to cut lineage and stage written tables.

    Read from ``spark.checkpoint.dir`` (the cluster's shared store) or the
    context's checkpoint folder.  Only a local-mode session with neither set
    (tests) gets a fresh scratch folder; a cluster session without one is an
    error, never a machine-local folder.
    """
    sc = spark.sparkContext
    cur = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not cur:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster "
                               "(dimflow checkpoints and stages files there)")
        cur = tempfile.mkdtemp(prefix="dimflow-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(cur)
    return cur.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A unique path under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
