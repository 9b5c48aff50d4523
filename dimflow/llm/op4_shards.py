"""Operator 4: contiguous, balanced shards by global prefix sums of bytes.

Narrow rows (id, size, text hash) are range-partitioned by (text hash, id) and
sorted; the text itself is never shuffled.  Each partition numbers its rows and
sums its bytes; the prefix sums of the partitions' totals, one row a partition,
make row number and byte offset global.  Shards are cut at equal byte targets.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimflow.llm.common import cut, map_arrow, partitions

#: Bytes counted for each row besides its text.
ROW_BYTES = 8
#: A group of equal texts stays whole up to this share of a shard's target.
WHOLE_GROUP = 0.05


def _numbered(rows: DataFrame) -> DataFrame:
    """Adds part, local_row and local_byte to the rows of sorted partitions."""
    def run(batches):
        row, byte = 0, 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            size = batch.column("size").to_numpy()
            before = byte + np.cumsum(size) - size
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.arange(row, row + n)), pa.array(before)],
                [*batch.schema.names, "local_row", "local_byte"])
            row, byte = row + n, int(before[-1] + size[-1])
    return map_arrow(rows, run, "doc_id long, size long, text_crc32 long, group long, part int, "
                                "local_row long, local_byte long")


def shard_documents(docs: DataFrame, shards: int = 24) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard, byte_offset).

    The law is ``bytes``: rows in the order of (text hash, doc_id) are cut where
    the running size passes k/shards of the total, so shard sizes differ by
    about one row.  Copies of a text stand side by side; a cut inside a group
    of equal texts moves to the group's nearer end if the group is at most
    WHOLE_GROUP of a target (larger groups are split, or sizes could not be
    near equal).  ``slot`` numbers the rows of a shard from 0 without gaps.
    Null and empty texts have 0 bytes and checksum 0.  Ties (repeated rows) may
    take either order; a null id sorts first.  With fewer rows than shards some
    shards are empty; an empty table gives no rows.
    """
    def checksums(batches):
        for batch in batches:
            text = batch.column("text").cast(pa.large_binary()).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(t or b"") + ROW_BYTES for t in text],
                                                  pa.int64()),
                 pa.array([zlib.crc32(t or b"") for t in text], pa.int64()),
                 batch.column("group")], ["doc_id", "size", "text_crc32", "group"])

    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = map_arrow(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"),
                    F.xxhash64(text).alias("group")),
        checksums, "doc_id long, size long, text_crc32 long, group long")
    rows = (rows.repartitionByRange(partitions(spark), "group", "doc_id")
            .sortWithinPartitions("group", "doc_id")
            .withColumn("part", F.spark_partition_id()))
    # sorted and numbered once, in the shared folder: offsets and rows agree
    rows = cut(_numbered(rows))
    totals = sorted(rows.groupBy("part").agg(F.count("*"), F.sum("size")).collect())
    if not totals:
        return _placed(rows.withColumn("row", F.lit(0).cast("long"))
                       .withColumn("byte", F.lit(0).cast("long")), [], [])
    counts, sizes = np.array([t[1] for t in totals]), np.array([t[2] for t in totals])
    starts = spark.createDataFrame(                      # one row a partition
        [(t[0], int(r), int(b)) for t, r, b in
         zip(totals, np.cumsum(counts) - counts, np.cumsum(sizes) - sizes)],
        "part int, row0 long, byte0 long")
    rows = rows.join(F.broadcast(starts), "part").select(
        "doc_id", "size", "text_crc32", "group", (F.col("row0") + F.col("local_row")).alias("row"),
        (F.col("byte0") + F.col("local_byte")).alias("byte"))
    total = int(sizes.sum())
    targets = [total * k // shards for k in range(1, shards)]
    cuts = _cuts(rows, targets, total / shards)
    first = {s: r for s, r in _placed(rows, cuts, None).groupBy("shard")
             .agg(F.min("row")).collect()}
    return _placed(rows, cuts, [first.get(s, 0) for s in range(shards)])


def _cuts(rows: DataFrame, targets: list[int], share: float) -> list[int]:
    """Byte offsets at which shards begin: for each target the nearer end of the
    row that holds it or, if small enough, of that row's group."""
    inside = F.lit(False)
    for t in targets:
        inside |= (F.col("byte") < t) & (F.col("byte") + F.col("size") > t)
    hit = rows.where(inside).select("group", "byte", "size").collect()   # at most one a target
    ends = {r.group: (r.lo, r.hi) for r in
            rows.where(F.col("group").isin([h.group for h in hit])).groupBy("group")
            .agg(F.min("byte").alias("lo"), F.max(F.col("byte") + F.col("size")).alias("hi"))
            .collect()}
    out = []
    for t in targets:
        for h in hit:
            if h.byte < t < h.byte + h.size:
                lo, hi = ends[h.group]
                if hi - lo > WHOLE_GROUP * share:
                    lo, hi = h.byte, h.byte + h.size
                t = lo if t - lo <= hi - t else hi
                break
        out.append(t)
    return out


def _placed(rows: DataFrame, cuts: list[int], first: list[int] | None) -> DataFrame:
    shard = F.lit(0)
    for c in cuts:
        shard = shard + (F.col("byte") >= c).cast("int")
    rows = rows.withColumn("shard", shard)
    if first is None:
        return rows
    start = F.element_at(F.array(*[F.lit(f).cast("long") for f in first or [0]]),
                         F.col("shard") + 1)
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                       (F.col("row") - start).alias("slot"),
                       F.lit(None).cast("int").alias("grown_shard"),
                       F.col("byte").alias("byte_offset"))
