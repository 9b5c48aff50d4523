"""Reconciliation of batches by fingerprints of multisets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimflow.operators.quality import file_diff


def fingerprints(names: DataFrame) -> DataFrame:
    """(batch, n, sum, xor) over the names of each batch: the count, the exact
    sum of their 64-bit hashes, and the xor of other hashes.  Order does not
    matter, repeats do; partial results add up, so a batch of any size is a few
    numbers a task."""
    return names.groupBy("batch").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64("name").cast("decimal(20,0)")).alias("sum"),
        F.bit_xor(F.xxhash64(F.lit(7), "name")).alias("xor"))


def unequal_batches(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """(batch) of batches whose two multisets of names differ.  Different ones
    that agree in count, sum and xor are taken for equal: about one in 2**64."""
    f, m = fingerprints(files), fingerprints(manifest)
    same = [F.col(f"f.{c}").eqNullSafe(F.col(f"m.{c}")) for c in ("n", "sum", "xor")]
    joined = f.alias("f").join(m.alias("m"), F.col("f.batch").eqNullSafe(F.col("m.batch")), "full")
    return joined.where(~(same[0] & same[1] & same[2])).select(
        F.coalesce("f.batch", "m.batch").alias("batch"))


def reconcile(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """U2 as ``file_diff``; names are shuffled and compared only in batches whose
    fingerprints differ."""
    files, manifest = files.select("batch", "name"), manifest.select("batch", "name")
    bad = unequal_batches(files, manifest).withColumnRenamed("batch", "_bad")

    def of_bad(df):
        return df.join(bad, F.col("batch").eqNullSafe(F.col("_bad")), "left_semi")
    return file_diff(of_bad(files), of_bad(manifest))
