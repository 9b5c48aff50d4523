"""End-to-end jobs: extract, load, refresh, rerun, backfill.

Each table is one distributed read -> transform -> write lineage.  The
driver only decides *which* jobs to submit: the work plan (one row per
dimension table, registry-sized) is collected, and independent tables are
submitted from a small thread pool so their Spark jobs share the cluster.
"""

from __future__ import annotations

import datetime as dt
import inspect
import logging
import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from dimflow.functions.cleanse import cleanse, separator
from dimflow.operators import load as L
from dimflow.operators import quality as Q
from dimflow.operators import registry as R
from dimflow.operators import runlog as RL
from dimflow.operators import state as ST
from dimflow.functions.timeutil import hour_ts, parse_minute, to_pacific
from dimflow.operators.projection import schema_lines
from dimflow.session import ensure_checkpoint_dir
from dimflow.sinks import files as K
from dimflow.sinks import fs
from dimflow.sinks import tables as TB
from dimflow.sources import files as SF
from dimflow.sources.jdbc import dictionary_from_schema
from dimflow.sources.specs import read_table_specs, resolve_spec
from dimflow.sources.tables import scan_delta

log = logging.getLogger("dimflow")

PRIMARY = R.PRIMARY_VERSION
# Platforms whose non-dimension loads carry a load_epoch_ts column.
EPOCH_PLATFORMS = ("test_mysql", "test_data")


@dataclass
class ExtractResult:
    """What the dump step hands to the load step."""
    successes: list[str]
    location: str
    errors: list[str]
    reload_flags: dict[str, int]
    minutes: dict[str, float] = field(default_factory=dict)
    update_log: DataFrame | None = None
    manifest_written: bool = False


def _columns_by_table(registry: DataFrame) -> DataFrame:
    cols = R.extract_columns(registry)
    return cols.groupBy("table_name").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "column_name"))),
                    lambda e: e["column_name"]).alias("columns"))


def extract(spark: SparkSession, registry: DataFrame, read_source: Callable[[str], DataFrame],
            root: str, batch: str, update_log: DataFrame | None = None,
            version: str = PRIMARY, force_full: bool = False, only: str | None = None,
            ts_col: str = "updated_at", sep: str | None = None, threads: int = 8,
            now: str | None = None, db_type: str = "MYSQL",
            publish_log: Callable[[DataFrame], object] | None = None,
            sections: DataFrame | None = None) -> ExtractResult:
    """S4 plan -> M3 markers (before any scan) -> per table scan (full or
    delta, through the view when named) -> cleanse -> Q7 -> K1 dump, K2
    sidecar -> K3 manifest when nothing failed.  Failed tables are retried
    once (F3).  ``update_log`` comes back with the markers appended;
    ``publish_log`` publishes it before the first table is read.
    ``sections(table_name, columns)`` of an ini schema file replace the
    registry as the work list (S15), with their own column lists.  ``sep`` may be a character or hex text (``01``);
    ``db_type='ORCL'`` uses the Oracle cleansing profile (carriage returns
    only)."""
    if sections is not None:
        work = R.tables_from_config(sections, "config", only)
    else:
        work = R.enabled_tables(registry, version)
        if only is not None:
            work = R.only_table(work, only)
    wm = RL.watermarks(update_log) if update_log is not None else None
    plan = R.extract_mode(work, wm, force_full, version)
    stamp = now or dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
    new_log = None
    if update_log is not None and version == PRIMARY:
        new_log = ST.mark_downloaded(update_log, plan.where("needs_marker"), stamp)
        if publish_log is not None:
            publish_log(new_log)
    by_table = _columns_by_table(registry) if sections is None else sections.select(
        "table_name", F.split("columns", r"\s*,\s*").alias("columns"))
    rows = plan.join(by_table, "table_name", "left").collect()
    profile = "oracle" if db_type == "ORCL" else ("pipe" if version == PRIMARY else "ctrl_a")
    sep = separator(sep) if sep is not None else ("|" if version == PRIMARY else "\x01")
    # a reader may take (source_name) or (source_name, database from the registry)
    try:
        two_args = len(inspect.signature(read_source).parameters) >= 2
    except (TypeError, ValueError):
        two_args = False

    def one(row) -> tuple[str, float]:
        t0 = time.time()
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", "dimflow")
        df = read_source(row.source_name, row.mysql_db) if two_args else read_source(row.source_name)
        if row.columns:
            df = df.select(*[F.col(f"`{c}`") for c in row.columns])
        if row.mode == "delta":
            df = scan_delta(df, row.watermark, ts_col)
        df = cleanse(df, profile, sep)
        if version != PRIMARY:
            Q.assert_nonempty(df, f"dump of {row.table_name}")
        path = K.write_dump(df, root, batch, row.table_name, sep)
        if version != PRIMARY:
            d = dictionary_from_schema(spark, df, row.source_name)
            views = spark.createDataFrame([(row.table_name, row.view_name)], "table_name string, view_name string")
            K.write_schema_sidecar(schema_lines(d, views), f"{path}/{row.table_name}.schema")
        return row.table_name, (time.time() - t0) / 60

    def run(batch_rows):
        ok, bad, mins = [], [], {}
        with ThreadPoolExecutor(max_workers=max(1, threads)) as ex:
            futs = {r.table_name: ex.submit(one, r) for r in batch_rows}
            for name, fut in futs.items():
                try:
                    _, m = fut.result()
                    ok.append(name)
                    mins[name] = m
                except Exception as e:  # noqa: BLE001 -- a table's failure is data, not a crash
                    log.error("dump of %s failed: %s", name, e)
                    bad.append(name)
        return ok, bad, mins

    ok, bad, mins = run(rows)
    if bad:  # the second pass re-runs only the failed tables
        ok2, bad, mins2 = run([r for r in rows if r.table_name in set(bad)])
        ok += ok2
        mins.update(mins2)
    location = f"{root.rstrip('/')}/{batch}"
    written = False
    if not bad and version != PRIMARY:
        files = SF.list_batch(spark, location).select(F.col("path").alias("url"))
        written = K.write_manifest(files, f"{location}/MANIFEST", None, "url", version)
    flags = {r.table_name: int(r.reload_flag) for r in rows if r.table_name in set(ok)}
    return ExtractResult(sorted(ok), location, sorted(bad), flags, mins, new_log, written)


def _sidecar_schema(spark: SparkSession, path: str):
    """Column names and types from a ``.schema`` sidecar (header skipped)."""
    lines = fs.read_text_file(spark, path).splitlines()[1:]
    out = []
    for ln in lines:
        parts = ln.split(" - - - - - ")
        col = parts[0].split(" ", 1)[1]
        typ = parts[1].split(" - ")[0].strip()
        out.append((col, typ))
    return out


def _batch_complete(spark: SparkSession, batch_dir: str) -> bool:
    """M1 for one table folder with all its sub-folders: its files, by their
    names relative to the folder, equal its manifest -- the loader's
    ``manifest.json`` in the folder, else the dump step's batch-level
    ``MANIFEST`` restricted to this folder's entries."""
    key = batch_dir.rstrip("/")
    leaf = f"/{key.rsplit('/', 1)[-1]}/"

    def relative(col: str):
        return F.substring_index(F.col(col), leaf, -1)
    files = SF.list_batch(spark, batch_dir).select(
        F.lit(key).alias("batch"), relative("path").alias("name"))
    if fs.exists(spark, f"{batch_dir}/manifest.json"):
        entries, batches = SF.read_manifests(spark, f"{batch_dir}/manifest.json")
    else:
        parent = batch_dir.rstrip("/").rsplit("/", 1)[0]
        if not fs.exists(spark, f"{parent}/MANIFEST"):
            return False
        entries, batches = SF.read_manifests(spark, f"{parent}/MANIFEST")
        here = key.split(":", 1)[-1] + "/"
        entries = entries.where(F.col("url").contains(here)
                                & ~F.col("name").isin(*Q.MANIFEST_NAMES))
    entries = entries.select(F.lit(key).alias("batch"), relative("url").alias("name"))
    batches = batches.select(F.lit(key).alias("batch"), "valid")
    checks = Q.manifest_check(files, entries, batches.where("valid")).collect()   # one row
    return bool(checks) and all(c.complete for c in checks)


def _batch_id(spark: SparkSession, table: str, batch_dir: str, stamp: str) -> str:
    """The identity of a batch: its source table, hour or minute, and the names
    and sizes of its files.  The same files give the same id (a replay), another
    dump of the hour or another source of a shared target a new one."""
    print_of = SF.list_batch(spark, batch_dir).agg(
        F.sum(F.xxhash64("path", "length").cast("decimal(38,0)")).alias("s")).first().s
    return f"{table}-{stamp}-{int(print_of or 0) & 0xFFFFFFFFFF:010x}"


@dataclass
class LoadResult:
    table: str
    status: str
    rows: int = 0
    rejected: int = 0
    version: int | None = None


def load(spark: SparkSession, table: str, batch_dir: str, spec_path: str, prod_path: str,
         stg_path: str | None = None, lookups: dict[str, DataFrame] | None = None,
         log_path: str | None = None, hour: int = 0, minute: str | None = None,
         database: str = "warehouse", platform: str = "test_mysql", process: str = "LOAD",
         env: str = "prod", reject_path: str | None = None, reload: bool = False,
         local_spec: str | None = None, require_manifest: bool = False,
         load_epoch: int | None = None, summary_path: str | None = None,
         servers: DataFrame | None = None, host: str | None = None,
         dependent_dir: str | None = None, trust_success_marker: bool = False) -> LoadResult:
    """Q8 -> M1/Q2 -> S17/S13 -> S6/S7 parse -> K8/Q5 rejects -> staging
    (K6/Q4/Q6) -> J1 / X1 / J2 / P7 / K9 -> K11 -> L15 event -> M7.

    Non-dimension loads of the ``test_mysql`` / ``test_data`` platforms carry
    a ``load_epoch_ts`` column (P4; the current second unless given), and in a
    staging environment a load that added no row for its epoch fails (Q6,
    L18).  With ``summary_path``/``servers``/``host`` the summary table's
    ``latest_loaded_date`` of ``host``'s servers advances to the loaded hour
    (or minute) in Pacific time (M7, H3).

    With ``require_manifest`` the batch folder must match its manifest (M1);
    with ``dependent_dir`` the batch of the table this one depends on must be
    complete first (Q1).  With ``trust_success_marker`` (output on HDFS,
    written by a committing job) a ``_SUCCESS`` marker in the batch folder
    short-circuits both (Q3).

    Idempotence: a batch with a COMPLETED event is skipped (Q8, by hour, for
    minute loads by minute).  Appends go into a folder named after the batch
    (``_batch_id``), and what is new (J1, P5) is decided against the target
    without that folder, so loading a batch again rewrites the same rows.

    Columns take the types of the production table if it exists, else of the
    batch's sidecar, else text; cells that do not cast are rejects, counted
    before anything is published.
    """
    if log_path is not None and TB.current_version(spark, log_path) is not None:
        done = Q.not_yet_loaded(
            spark.createDataFrame([(database, table, hour, minute)],
                                  "database_name string, table_name string, processed_utc_hour bigint, "
                                  "process_minute string"),
            TB.read_table(spark, log_path, TB.TRF_LOG_SCHEMA), process,
            (*Q.BATCH_KEYS, "process_minute") if minute else Q.BATCH_KEYS)
        if done.isEmpty():
            return LoadResult(table, "already loaded")
    # completeness of the batch folder (Q3 marker, Q1 dependency, M1 manifest, Q2 any file)
    if require_manifest or dependent_dir is not None:
        has_marker = trust_success_marker and SF.success_markers(spark, [batch_dir]).first().has_success
        if not has_marker:
            if dependent_dir is not None and not _batch_complete(spark, dependent_dir):
                return LoadResult(table, "dependency incomplete")
            if not _batch_complete(spark, batch_dir):
                return LoadResult(table, "batch incomplete")
    elif not Q.has_files(SF.list_batch(spark, batch_dir)).where("has_files").take(1):
        return LoadResult(table, "no files")

    def event(status: str):
        if log_path is not None:
            TB.append_load_event(spark, log_path, database, table, process, hour, status, platform, minute)

    spec_file = resolve_spec(spark, spec_path, local_spec or spec_path)
    specs, _ = read_table_specs(spark, spec_file, with_columns=False)
    spec = specs.where(F.col("name") == table).first()
    if spec is None or not spec.columns:
        event("FAILED")
        raise Q.LoadGateError(f"no columns for {table}")
    if spec.is_dimension and spec.operation_column is None:
        event("FAILED")
        raise Q.LoadGateError(f"dimension {table} has no operation column")
    event("STARTED")
    batch_id = _batch_id(spark, table, batch_dir, minute or str(hour))
    staged = stg_path is not None and spec.db_name_stg is not None
    # A spec may route this source into another table (load_table)
    target = prod_path if staged or spec.load_table is None else \
        prod_path.rsplit("/", 1)[0] + "/" + spec.load_table
    cols = spec.columns.split(",")
    side = f"{batch_dir}/{table}.schema"
    types = dict(_sidecar_schema(spark, side)) if fs.exists(spark, side) else {}
    if TB.current_version(spark, target) is not None:
        known = {f.name: f.dataType for f in TB.read_table(spark, target).schema.fields}
        types = {**types, **{c: known[c] for c in cols if c in known}}
    schema = [(c, types.get(c, "string")) for c in cols]
    if spec.file_format == "orc":
        parsed = SF.type_columns(SF.read_orc(spark, batch_dir, cols), schema)
    else:
        parsed = SF.read_delimited(spark, f"{batch_dir}/*.gz", schema, spec.delimiter)
    # A staged load counts its rejects while the good rows are written to staging
    # (one parse, one write); a direct load has to know them before it publishes.
    seen = Observation()
    if staged:
        good, _ = Q.split_rejects(parsed.observe(
            seen, F.count_if(F.col(SF.REASON).isNotNull()).alias("rejected_rows")))
    else:
        ensure_checkpoint_dir(spark)
        parsed = parsed.checkpoint(eager=True)
        good, _ = Q.split_rejects(parsed)

    def gate_rejects(n_bad: int) -> int:
        if n_bad and (spec.write_rejects or reject_path):
            # the source kept rejects beside the staging table: <stg>.<table>_rejected_data
            TB.append(Q.split_rejects(parsed)[1],
                      reject_path or f"{stg_path or prod_path}_rejected_data", batch_id)
        return Q.check_rejects(n_bad, spec.reject_max)

    if not spec.is_dimension and load_epoch is None and platform in EPOCH_PLATFORMS:
        load_epoch = int(time.time())
    if not spec.is_dimension and load_epoch is not None:
        good = L.with_load_epoch(good, load_epoch)
    try:
        if staged:
            TB.load_staging(good, stg_path)
            stg = TB.read_table(spark, stg_path)
            try:
                n_bad = gate_rejects(seen.get["rejected_rows"])
                if "staging" in env and not spec.is_dimension:
                    Q.assert_nonempty(stg, f"staging {table}")
                version = _publish_from_staging(spark, spec, stg, prod_path, batch_id, lookups or {}, reload)
            finally:
                TB.truncate(spark, stg_path, stg.schema)  # K11, on success and failure
        else:
            n_bad = gate_rejects(Q.reject_count(parsed).first().rejected_rows)
            if reload or spec.truncate_before_load:
                version = TB.full_refresh(good, target)
            else:
                version = TB.load_direct(good, target, batch_id)
            if load_epoch is not None and "staging" in env and not spec.is_dimension:
                n = RL.epoch_count(TB.read_table(spark, target).where(F.col("load_epoch_ts") == load_epoch))
                if n.isEmpty():                                                # Q6 via L18
                    raise Q.LoadGateError(f"no rows loaded for epoch {load_epoch} of {table}")
    except Exception:
        event("FAILED")
        raise
    event("COMPLETED")
    if summary_path is not None and servers is not None and host is not None:
        loaded_at = to_pacific(parse_minute(F.lit(minute)) if minute else hour_ts(F.lit(hour)))
        loads = spark.range(1).select(F.lit(table).alias("table_name"), loaded_at.alias("loaded_at"))
        summary = TB.read_table(spark, summary_path)
        TB.publish(L.advance_loaded_date(summary, servers, host, loads), summary_path)
    return LoadResult(table, "loaded", rejected=int(n_bad), version=version)


def _publish_from_staging(spark, spec, stg: DataFrame, prod_path: str, batch_id: str,
                          lookups: dict[str, DataFrame], reload: bool) -> int:
    """Staging -> production by the spec's operation.  A reload, or a first
    load into a table that does not exist yet, publishes the transformed
    staging rows as the whole table (K9); otherwise the operation runs
    against the current production rows."""
    fresh = reload or TB.current_version(spark, prod_path) is None
    # production apart from this batch: a batch loaded again finds its own rows new
    prod = None if fresh else TB.read_table(spark, prod_path, without_batch=batch_id)
    if spec.is_dimension:
        key, ident = spec.operation_column, spec.identity_column
        if fresh:
            rows = stg
            if ident and ident not in stg.columns:
                rows = L.assign_identity(stg, key, ident, 0)                   # P5 from 1
            return TB.full_refresh(rows, prod_path)
        if spec.operation == "Merge":                                        # X1
            return TB.publish(L.upsert(prod, stg.select(*prod.columns), key, spec.order_column),
                              prod_path)
        new = L.insert_new(stg, prod, key)                                   # J1
        if ident:
            start = prod.agg(F.max(ident)).scalar()                          # P5
            new = L.assign_identity(new.drop(ident) if ident in new.columns else new, key, ident, start)
        return TB.append(new.select(*prod.columns), prod_path, batch_id)
    # J2 + P6; a join without replacement keys is dropped, as the source did
    if spec.join_table is not None and spec.unwanted_key and spec.wanted_key:
        unwanted = spec.unwanted_key.split(".")[-1]
        wanted = spec.wanted_key.split(".")[-1]
        out = L.insert_with_lookup(stg, lookups[spec.join_table], spec.join_key, spec.join_key,
                                   unwanted, wanted)
        return TB.full_refresh(out, prod_path) if fresh else TB.append(out, prod_path, batch_id)
    if fresh:
        return TB.full_refresh(stg, prod_path)
    return TB.append(L.insert_positional(stg, prod.columns), prod_path, batch_id)   # P7


def refresh_dimensions(spark: SparkSession, registry_path: str, update_log_path: str,
                       read_source: Callable[[str], DataFrame], root: str, warehouse: str | list[str],
                       spec_path: str, hour: int, force_full: bool = False,
                       threads: int = 8, load_threads: int = 8, log_path: str | None = None,
                       database: str = "warehouse", require_manifest: bool = False,
                       summary_path: str | None = None, servers: DataFrame | None = None,
                       host: str | None = None) -> dict:
    """Schema doc (U1/K4) and max hour (K5) -> E1 (M3 markers published
    before any scan) -> E2 per dumped table into every warehouse target (full
    refresh when reload/always_reload/forced, else insert-if-absent), up to
    ``load_threads`` loads at a time; then, for each table that loaded on
    *all* targets, M2 (marker complete) and M5 (registry
    ``latest_loaded_date``, ``reload_table = 0``).  Each load runs with the
    log (L15, Q8), the manifest gate (M1) and the summary (M7) if given;
    a target's log database is ``<database>:<target>``.  ``failed`` lists
    ``(table, target)`` pairs."""
    registry = TB.read_table(spark, registry_path)
    batch = dt.datetime.fromtimestamp(hour * 3600, dt.timezone.utc).strftime("%Y/%m/%d/%H")
    meta = f"{root.rstrip('/')}/{batch}"
    K.write_schema_doc(R.schema_doc_rows(registry), f"{meta}/schema/schema.json")
    K.write_max_hour(spark, f"{meta}/data_max_utc_hour/part-00000-data_max_utc_hour.csv", hour)
    upd = TB.read_table(spark, update_log_path)
    res = extract(spark, registry, read_source, root, batch, upd, force_full=force_full, threads=threads,
                  publish_log=lambda df: TB.publish(df, update_log_path))
    targets = [warehouse] if isinstance(warehouse, str) else list(warehouse)
    if log_path is not None and TB.current_version(spark, log_path) is None:
        TB.publish(spark.createDataFrame([], TB.TRF_LOG_SCHEMA), log_path)   # before loads share it

    def one(t: str, wh: str) -> bool:
        try:
            r = load(spark, t, f"{res.location}/{t}", spec_path, f"{wh}/{t}",
                     stg_path=f"{wh}/stg/{t}", hour=hour, log_path=log_path,
                     database=f"{database}:{wh.rstrip('/').rsplit('/', 1)[-1]}",
                     require_manifest=require_manifest,
                     reload=bool(res.reload_flags.get(t)) or force_full)
            return r.status in ("loaded", "already loaded")
        except Exception as e:  # noqa: BLE001 -- one target's failure is recorded, others still load
            log.error("load of %s into %s failed: %s", t, wh, e)
            return False

    pairs = [(t, wh) for t in res.successes for wh in targets]
    with ThreadPoolExecutor(max_workers=max(1, load_threads)) as ex:
        outcome = dict(zip(pairs, ex.map(lambda p: one(*p), pairs)))
    failed = [p for p in pairs if not outcome[p]]
    loaded = [t for t in res.successes if all(outcome[t, wh] for wh in targets)]
    if loaded and summary_path is not None and servers is not None and host is not None:
        at = to_pacific(hour_ts(F.lit(hour)))                                 # M7, one update a run
        loads = spark.createDataFrame([(t,) for t in loaded], "table_name string") \
            .select("table_name", at.alias("loaded_at"))
        TB.publish(L.advance_loaded_date(TB.read_table(spark, summary_path), servers, host, loads),
                   summary_path)
    if loaded:  # each table that loaded on every target is marked, independently of the others
        done = spark.createDataFrame([(t,) for t in loaded], "table_name string")
        TB.publish(ST.mark_complete(TB.read_table(spark, update_log_path), done), update_log_path)
        now = dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
        # the registry as it is now; a reload asked for during the run is still to come
        current = TB.read_table(spark, registry_path)
        asked = current.where("reload_table = 1").select("table_name").join(
            registry.where("reload_table = 1").select("table_name"), "table_name", "left_anti")
        TB.publish(ST.request_reload(ST.mark_loaded(current, done, now), asked), registry_path)
    return {"dumped": res.successes, "dump_errors": res.errors, "loaded": loaded, "failed": failed,
            "location": res.location}


def dump_run(spark: SparkSession, registry: DataFrame, read_source: Callable[[str], DataFrame],
             root: str, now_stamp: str, version: str = "other", load_log_path: str | None = None,
             run_log_path: str | None = None, job_id: int = 0, process_id: int = 0,
             **kw) -> ExtractResult:
    """A dump run as the dumper's main does it: run log 'started' (L15), dim
    load log STARTED for the run stamp (M4 insert, non-primary versions),
    E1 into ``<root>/<now_stamp>``, then COMPLETED / FAILED on the same run
    (M4 update) and 'completed' / 'error' in the run log."""
    def run_event(status: str, error: str = ""):
        if run_log_path is not None:
            TB.append_run_event(spark, run_log_path, job_id, process_id, status,
                                file_name=f"dimension_dump_{version}", error=error)

    def load_log(status: str, insert: bool):
        if load_log_path is None or version == PRIMARY:
            return
        empty = spark.createDataFrame([], "run_time bigint, status string, platform string")
        cur = TB.read_table(spark, load_log_path) if TB.current_version(spark, load_log_path) is not None \
            else empty
        TB.publish(ST.set_load_status(cur, int(now_stamp), version, status, insert=insert), load_log_path)

    run_event("started")
    load_log("STARTED", insert=True)
    res = extract(spark, registry, read_source, root, now_stamp, version=version, **kw)
    if res.errors:
        run_event("error", "Tables Failed: " + ",".join(res.errors))
        load_log("FAILED", insert=False)
    else:
        run_event("completed")
        load_log("COMPLETED", insert=False)
    return res


def rerun_failed(spark: SparkSession, load_log_path: str, platform: str, now: int, registry: DataFrame,
                 read_source: Callable[[str], DataFrame], root: str, lag: int = 15, **kw) -> ExtractResult | None:
    """F2 picks the failed run, E1 rewrites that run's batch, M4 records
    the outcome (COMPLETED / FAILED) on the same run."""
    load_log = TB.read_table(spark, load_log_path)
    pick = RL.failed_runs(load_log, now, lag, platform=platform).first()
    if pick is None:
        return None
    run_time = int(pick.failed_run_time)
    res = extract(spark, registry, read_source, root, str(run_time), version=platform, **kw)
    status = "FAILED" if res.errors else "COMPLETED"
    load_log = TB.read_table(spark, load_log_path)       # with what other runs added meanwhile
    TB.publish(ST.set_load_status(load_log, run_time, platform, status), load_log_path)
    return res


def backfill(spark: SparkSession, custom_date: str, registry: DataFrame,
             read_source: Callable[[str], DataFrame], root: str, **kw) -> ExtractResult:
    """E5: E1 into a named batch folder."""
    return extract(spark, registry, read_source, root, custom_date, **kw)
