"""Completeness and data-quality gates.

Gates that decide *data* (which batches are complete, which rows are bad)
are DataFrames over all batches at once.  Gates that stop a job (empty
staging, too many rejects) are small driver checks that raise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MANIFEST_NAMES = ("manifest.json", "MANIFEST")


def file_diff(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """Multiset difference both ways per batch: ``extra`` = listed but not
    in the manifest, ``missing`` = in the manifest but not listed."""
    f = files.select("batch", "name")
    m = manifest.select("batch", "name")
    return f.exceptAll(m).withColumn("side", F.lit("extra")) \
        .unionByName(m.exceptAll(f).withColumn("side", F.lit("missing")))


def manifest_check(files: DataFrame, manifest: DataFrame,
                   manifest_batches: DataFrame | None = None) -> DataFrame:
    """M1: per batch ``(n_extra, n_missing, complete)``.

    A batch is complete iff it has a (valid) manifest and its listed files --
    manifest files excluded -- equal the manifest entries as multisets.  One
    count join over all batches: entries are counted per (batch, name) on
    both sides map-side, then full-outer joined.  ``manifest_batches(batch)``
    names batches whose manifest was read even if it lists nothing; by
    default a batch has a manifest when it has entries.
    """
    f = files.where(~F.col("name").isin(*MANIFEST_NAMES)) \
        .groupBy("batch", "name").agg(F.count(F.lit(1)).alias("_nf"))
    m = manifest.groupBy("batch", "name").agg(F.count(F.lit(1)).alias("_nm"))
    j = f.join(m, ["batch", "name"], "full")
    nf, nm = F.coalesce(F.col("_nf"), F.lit(0)), F.coalesce(F.col("_nm"), F.lit(0))
    per = j.groupBy("batch").agg(
        F.sum(F.greatest(nf - nm, F.lit(0))).cast("bigint").alias("n_extra"),
        F.sum(F.greatest(nm - nf, F.lit(0))).cast("bigint").alias("n_missing"),
        F.max(F.col("_nm").isNotNull()).alias("_has"))
    if manifest_batches is not None:
        mb = manifest_batches.select(F.col("batch").alias("_mb")).distinct()
        per = per.join(mb, F.col("batch") == F.col("_mb"), "left") \
            .withColumn("_has", F.col("_has") | F.col("_mb").isNotNull()).drop("_mb")
    return per.select("batch", "n_extra", "n_missing",
                      (F.col("_has") & (F.col("n_extra") == 0) & (F.col("n_missing") == 0))
                      .alias("complete"))


def has_files(files: DataFrame, batches: DataFrame | None = None) -> DataFrame:
    """Q2: the any-file rule -- a batch is ready when it holds a file."""
    n = files.groupBy("batch").agg(F.count(F.lit(1)).alias("_n"))
    base = batches.select("batch").distinct().join(n, "batch", "left") if batches is not None else n
    return base.select("batch", (F.coalesce(F.col("_n"), F.lit(0)) > 0).alias("has_files"))


def has_success(files: DataFrame) -> DataFrame:
    """Q3: whether a batch holds the ``_SUCCESS`` marker."""
    return files.groupBy("batch").agg(F.max(F.col("name") == "_SUCCESS").alias("has_success"))


def ready_batches(checks: DataFrame, deps: DataFrame | None = None,
                  success: DataFrame | None = None) -> DataFrame:
    """Q1: a batch loads when it is complete and the batch it depends on
    (``deps(batch, dep_batch)``) is complete too; a ``_SUCCESS`` marker
    (Q3, ``success(batch, has_success)``) short-circuits both checks.  A
    dependency with no check row is not complete.

    The checks are read once: each check row, joined with the batches that wait
    for it, gives a row for its own batch and one for each of those."""
    out = checks.select("batch", "complete")
    if deps is not None:
        d = deps.select(F.col("batch").alias("_for"), "dep_batch")
        none = F.lit(None).cast("boolean")
        own = F.struct(F.col("batch").alias("b"), F.col("complete").alias("c"), none.alias("d"))
        waiting = F.struct(F.col("_for").alias("b"), none.alias("c"),
                           F.coalesce("complete", F.lit(False)).alias("d"))
        out = out.join(d, F.col("batch") == F.col("dep_batch"), "full").select(F.explode(F.array(
            F.when(F.col("batch").isNotNull(), own),
            F.when(F.col("_for").isNotNull(), waiting))).alias("r")).where("r is not null") \
            .groupBy(F.col("r.b").alias("batch")) \
            .agg(F.max("r.c").alias("complete"), F.min("r.d").alias("_dep_ok")) \
            .where("complete is not null")
    else:
        out = out.withColumn("_dep_ok", F.lit(None).cast("boolean"))
    if success is not None:
        out = out.join(success.select("batch", "has_success"), "batch", "left")
    else:
        out = out.withColumn("has_success", F.lit(None).cast("boolean"))
    ready = F.coalesce(F.col("has_success"), F.lit(False)) | \
        (F.col("complete") & F.coalesce(F.col("_dep_ok"), F.lit(True)))
    return out.select("batch", ready.alias("ready"))


BATCH_KEYS = ("database_name", "table_name", "processed_utc_hour")


def not_yet_loaded(candidates: DataFrame, log: DataFrame, process: str = "LOAD",
                   keys=BATCH_KEYS) -> DataFrame:
    """Q8: candidate batches with no COMPLETED ``process`` event (a batch
    already loaded never loads again).  Minute batches are told apart by
    ``process_minute`` as a further key."""
    done = log.where((F.col("process_name") == process) & (F.col("status") == "COMPLETED")) \
        .select(*keys).distinct()
    return candidates.join(done, list(keys), "left_anti")


def validate_spec(spec: DataFrame) -> DataFrame:
    """Q9: specs that cannot load -- no columns, or a dimension without an
    operation column -- with the reason."""
    no_cols = F.col("columns").isNull() | (F.col("columns") == "")
    no_op = F.coalesce(F.col("is_dimension"), F.lit(False)) & F.col("operation_column").isNull()
    reason = F.when(no_cols, "no columns").when(no_op, "dimension without operation column")
    return spec.select("name", reason.alias("reason")).where(F.col("reason").isNotNull())


def split_rejects(parsed: DataFrame, reason_col: str = "_reject_reason"):
    """K8: ``(good, rejected)`` from one parse.  The caller persists
    ``parsed`` (or has it checkpointed) so the input is read once."""
    good = parsed.where(F.col(reason_col).isNull()).drop(reason_col, "_raw")
    bad = parsed.where(F.col(reason_col).isNotNull()).select(
        F.col("_raw").alias("rejected_data"), F.col(reason_col).alias("rejected_reason"))
    return good, bad


def reject_count(parsed: DataFrame, reason_col: str = "_reject_reason") -> DataFrame:
    """Rejected-row count of a load (one row)."""
    return parsed.agg(F.count_if(F.col(reason_col).isNotNull()).alias("rejected_rows"))


class LoadGateError(RuntimeError):
    """A gate stopped the load (nothing was published)."""


def check_rejects(n_rejected: int, reject_max: int | None) -> int:
    """Q5: rejects are reported when > 0; the load fails only beyond
    ``reject_max`` (None = no limit)."""
    if reject_max is not None and n_rejected > reject_max:
        raise LoadGateError(f"{n_rejected} rejected rows exceed REJECTMAX {reject_max}")
    return n_rejected


def assert_empty(df: DataFrame, what: str = "staging table") -> None:
    """Q4: staging must be empty before a load."""
    if not df.isEmpty():
        raise LoadGateError(f"{what} is not empty")


def assert_nonempty(df: DataFrame, what: str = "load") -> None:
    """Q6/Q7: zero rows where rows are expected is an error."""
    if df.isEmpty():
        raise LoadGateError(f"{what} has no rows")
