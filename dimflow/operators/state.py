"""Control-table updates as snapshot transforms (M2-M6).

Plain parquet tables take no ``UPDATE``/``MERGE``, so each statement of the
source becomes ``old snapshot -> new snapshot``; ``dimflow.sinks.tables``
publishes the result as a new version.  Statements that named one table now
take a DataFrame of tables, so a whole run's updates are one job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimflow.functions.timeutil import ntz


def _as_ts(value) -> Column:
    return value if isinstance(value, Column) else ntz(str(value))


def _table_set(tables: DataFrame | None, alias: str = "_tn") -> DataFrame | None:
    if tables is None:
        return None
    return tables.select(F.col("table_name").alias(alias)).distinct()


def mark_complete(update_log: DataFrame, tables: DataFrame | None = None,
                  tie_break: str | None = None) -> DataFrame:
    """M2: for each table (of ``tables``, else all), its newest
    ``downloaded`` row becomes ``complete`` (``ORDER BY update_date DESC
    LIMIT 1``).  Ties on ``update_date`` are broken by ``tie_break``
    descending if given, by ``log_id`` if the log has that column, else all
    tied rows are marked.  ``update_date`` itself is left as it was."""
    tie_break = tie_break or ("log_id" if "log_id" in update_log.columns else None)
    dl = update_log.where(F.col("uploaded_to_vertica") == "downloaded")
    ts = _table_set(tables)
    if ts is not None:
        dl = dl.join(ts, F.col("table_name") == F.col("_tn"), "left_semi")
    fields = [F.col("update_date").alias("u")]
    if tie_break:
        fields.append(F.col(tie_break).alias("k"))
    pick = dl.groupBy(F.col("table_name").alias("_pt")).agg(F.max(F.struct(*fields)).alias("_p"))
    pick = pick.select("_pt", F.col("_p.u").alias("_pu"),
                       *([F.col("_p.k").alias("_pk")] if tie_break else []))
    cond = (F.col("table_name") == F.col("_pt")) & (F.col("update_date") == F.col("_pu")) & \
        (F.col("uploaded_to_vertica") == "downloaded")
    if tie_break:
        cond = cond & F.col(tie_break).eqNullSafe(F.col("_pk"))
    j = update_log.join(pick, cond, "left")
    return j.select(*[(F.when(F.col("_pt").isNotNull(), F.lit("complete"))
                       .otherwise(F.col(c)).alias(c)) if c == "uploaded_to_vertica" else F.col(c)
                      for c in update_log.columns])


def mark_downloaded(update_log: DataFrame, tables: DataFrame, at) -> DataFrame:
    """M3: append a ``downloaded`` marker per table at time ``at`` -- written
    *before* the delta scan so the next watermark overlaps, never misses."""
    new = tables.select("table_name").distinct().select(
        *[(F.col("table_name") if c == "table_name"
           else _as_ts(at).alias(c) if c == "update_date"
           else F.lit("downloaded").alias(c) if c == "uploaded_to_vertica"
           else F.lit(None).cast(update_log.schema[c].dataType).alias(c))
          for c in update_log.columns])
    return update_log.unionByName(new)


def set_load_status(load_log: DataFrame, run_time, platform: str, status: str,
                    insert: bool = False) -> DataFrame:
    """M4: ``INSERT (run_time, status, platform)`` or ``UPDATE ... SET status
    WHERE run_time = ? AND platform = ?`` on the dimension load log.
    ``run_time`` is a stamp or a scalar Column (e.g. a subquery)."""
    rt = run_time if isinstance(run_time, Column) else F.lit(int(run_time))
    if insert:
        new = load_log.sparkSession.range(1).select(
            rt.cast("bigint").alias("run_time"), F.lit(status).alias("status"),
            F.lit(platform).alias("platform"))
        return load_log.unionByName(new.select(*load_log.columns))
    hit = (F.col("run_time") == rt) & (F.col("platform") == platform)
    return load_log.select(*[(F.when(hit, F.lit(status)).otherwise(F.col(c)).alias(c))
                             if c == "status" else F.col(c) for c in load_log.columns])


def _flag_tables(registry: DataFrame, tables: DataFrame) -> DataFrame:
    ts = _table_set(tables)
    return registry.join(ts, F.col("table_name") == F.col("_tn"), "left")


def mark_loaded(registry: DataFrame, tables: DataFrame, now) -> DataFrame:
    """M5: after a successful load: ``latest_loaded_date = now`` and
    ``reload_table = 0`` for the loaded tables."""
    reg = registry if "latest_loaded_date" in registry.columns else \
        registry.withColumn("latest_loaded_date", F.lit(None).cast("timestamp_ntz"))
    j = _flag_tables(reg, tables)
    hit = F.col("_tn").isNotNull()
    return j.select(*[
        F.when(hit, F.lit(0)).otherwise(F.col(c)).alias(c) if c == "reload_table"
        else F.when(hit, _as_ts(now)).otherwise(F.col(c)).alias(c) if c == "latest_loaded_date"
        else F.col(c) for c in reg.columns])


def request_reload(registry: DataFrame, tables: DataFrame) -> DataFrame:
    """M6: ``reload_table = 1`` for the listed tables."""
    j = _flag_tables(registry, tables)
    return j.select(*[F.when(F.col("_tn").isNotNull(), F.lit(1)).otherwise(F.col(c)).alias(c)
                      if c == "reload_table" else F.col(c) for c in registry.columns])
