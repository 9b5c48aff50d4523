"""Helpers shared by the operators: tables, the shared folder, id filters and
connected components."""

from __future__ import annotations

import ctypes
import pathlib
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimflow.session import ensure_checkpoint_dir

#: Links that one task contracts at a time.
TASK_LINKS = 200_000
#: Bits of an id filter: 2**25 bits are 4 MB, whatever the number of ids.
FILTER_BITS = 25


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared checkpoint folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def map_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
              schema: str) -> DataFrame:
    """``mapInArrow`` whose workers can import this package and hand freed memory
    back at the end of each task (workers are reused by later stages)."""
    ship(df.sparkSession)

    def task(batches):
        yield from run(batches)
        release_memory()
    return df.mapInArrow(task, schema)


def release_memory() -> None:
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:                               # no such call in this C library
        pass


def ship(spark: SparkSession) -> None:
    """Hand this package's source to the executors (once per application), so
    that it needs no installation there."""
    sc = spark.sparkContext
    if any(name.startswith("dimflow-src") for name in sc._python_includes):
        return
    root = pathlib.Path(__file__).resolve().parent.parent
    out = pathlib.Path(tempfile.mkdtemp(prefix="dimflow-src-")) / "dimflow-src.zip"
    with zipfile.ZipFile(out, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(out))


def id_filter(ids: DataFrame, column: str, slot: F.Column | None = None) -> np.ndarray:
    """A fixed-size bitmap (2**FILTER_BITS bits) of the hashes of ``ids`` (or
    of their slots, if given).
    ``maybe`` on it never misses an id; when full it only stops filtering."""
    if slot is None:
        slot = F.pmod(F.xxhash64(F.col(column).cast("long")), F.lit(1 << FILTER_BITS))
    rows = (ids.select(slot.alias("s"))
            .groupBy(F.shiftright("s", 15).alias("part"))
            .agg(F.bitmap_construct_agg(F.pmod("s", F.lit(1 << 15))).alias("bits"))
            .collect())
    out = np.zeros((1 << FILTER_BITS) // 8, dtype=np.uint8)
    for r in rows:
        out[r.part * 4096:(r.part + 1) * 4096] = np.frombuffer(r.bits, dtype=np.uint8)
    return out


def maybe(bits: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """Which ``slots`` (``slot_of`` values) may be in the filter."""
    return (bits[slots >> 3] >> (slots & 7).astype(np.uint8)) & 1 == 1


def slot_of(column: str) -> F.Column:
    return F.pmod(F.xxhash64(F.col(column).cast("long")), F.lit(1 << FILTER_BITS)).alias("slot")


def _contract(edges: DataFrame) -> DataFrame:
    """Within each task, replace links by one link from each vertex to the
    smallest vertex of its local component (union-find); the task's memory
    follows its own links only."""
    def run(batches):
        parent: dict[int, int] = {}

        def find(x):
            root = x
            while (p := parent.setdefault(root, root)) != root:
                root = p
            while parent[x] != root:
                parent[x], x = root, parent[x]
            return root
        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                a, b = find(a), find(b)
                if a != b:
                    parent[max(a, b)] = min(a, b)
        rows = [(v, find(v)) for v in list(parent)]
        rows = [r for r in rows if r[0] != r[1]]
        for i in range(0, len(rows), 50_000):
            part = rows[i:i + 50_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in part], pa.int64()),
                 pa.array([r[1] for r in part], pa.int64())], ["a", "b"])
    return map_arrow(edges.select("a", "b"), run, "a long, b long")


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(v, component): for every vertex of links (a, b), the smallest vertex
    reachable.  Links are contracted within tasks, then again in tasks of up to
    TASK_LINKS of the links that are left.  If that took several tasks,
    alternating large-star and small-star rounds follow, as grouped minima and
    joins, until the links no longer change.  Each round is kept in the shared
    folder."""
    def star(links: DataFrame, large: bool) -> DataFrame:
        both = links.select("a", "b")
        if large:
            both = both.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        joined = both.join(least, "a")
        if large:
            out = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(
                least.select("a", F.col("m").alias("b")))
        return out.where("a <> b")

    def labelled(links: DataFrame) -> DataFrame:
        return links.select(F.col("a").alias("v"), F.col("b").alias("component")).unionAll(
            links.select(F.col("b").alias("v"), F.col("b").alias("component")).distinct())

    links = cut(_contract(edges.where("a <> b")).distinct())
    tasks = -(-links.count() // TASK_LINKS) or 1
    links = cut(_contract(links.coalesce(tasks)))
    if tasks == 1:                                       # every link was in that task
        return labelled(links)
    before = None
    for _ in range(max_rounds):
        links = cut(star(links, True).distinct())
        links = cut(star(links, False).distinct())
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return labelled(links)
        before = now
    raise RuntimeError("components did not settle")
