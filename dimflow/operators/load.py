"""Staging -> production publish operators.

Each returns the rows to write (or the new snapshot); the sinks in
``dimflow.sinks`` do the writing.  Joins name no strategy: Catalyst/AQE pick
broadcast or shuffle from measured sizes, and only the key column of the big
production table takes part in anti joins.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dimflow.session import ensure_checkpoint_dir


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def insert_new(stg: DataFrame, prod: DataFrame, key: str | Sequence[str],
               columns: Sequence[str] | None = None) -> DataFrame:
    """Staging rows whose key is absent from production (``NOT EXISTS``).

    Left anti equi-join on the operation column(s).  As in SQL, a NULL key
    never matches so such rows are always inserted, and duplicate new keys in
    staging are all inserted.  Only the key is read from production.
    """
    keys = _keys(key)
    cond = [stg[k] == F.col(f"_p_{k}") for k in keys]
    prod_keys = prod.select(*[F.col(k).alias(f"_p_{k}") for k in keys])
    new = stg.join(prod_keys, cond, "left_anti")
    return new.select(*(columns or stg.columns))


def publish_insert_new(stg: DataFrame, prod: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Production after J1: ``prod`` plus the staging rows with new keys."""
    return prod.unionByName(insert_new(stg, prod, key, prod.columns))


def replace_key(columns: Sequence[str], unwanted: str, wanted: str,
                table: str | None = None) -> list[tuple[str, str]]:
    """The insert column list as ``(source, target)`` pairs, with the
    ``unwanted`` column taken from ``wanted`` instead (exact names, not text
    replacement).  ``table`` qualifies the untouched columns."""
    out = []
    for c in columns:
        src = wanted if c == unwanted else (f"{table}.{c}" if table else c)
        out.append((src, c))
    return out


def insert_with_lookup(stg: DataFrame, lookup: DataFrame, stg_key: str, lookup_key: str,
                       unwanted: str, wanted: str,
                       columns: Sequence[str] | None = None) -> DataFrame:
    """Inner join staging with a lookup table and swap one column.

    Rows of ``stg`` join ``lookup`` on ``stg_key = lookup_key``; the output has
    the staging column list with ``unwanted`` replaced by lookup's ``wanted``
    value (a surrogate-key lookup), named after the target column.  Staging
    rows without a match are dropped, duplicates in ``lookup`` multiply, as an
    inner join does.
    """
    cols = list(columns or stg.columns)
    lk = lookup.select(F.col(lookup_key).alias("_lk_key"), F.col(wanted).alias("_lk_val"))
    joined = stg.join(lk, stg[stg_key] == F.col("_lk_key"), "inner")
    return joined.select(*[(F.col("_lk_val") if c == unwanted else stg[c]).alias(c)
                           for c in cols])


def insert_positional(stg: DataFrame, target_columns: Sequence[str]) -> DataFrame:
    """``INSERT INTO target SELECT * FROM staging`` -- by position."""
    if len(stg.columns) != len(target_columns):
        raise ValueError(f"staging has {len(stg.columns)} columns, target {len(target_columns)}")
    return stg.toDF(*target_columns)


def with_load_epoch(df: DataFrame, epoch: int, name: str = "load_epoch_ts") -> DataFrame:
    """Tag every row of a non-dimension load with the load second."""
    return df.withColumn(name, F.lit(int(epoch)).cast("bigint"))


def latest_per_key(df: DataFrame, key: str | Sequence[str], order_col: str) -> DataFrame:
    """T1 set form: the row with the greatest ``order_col`` for every key.

    ``max(struct(order_col, other columns...))`` is an ordinary aggregate, so it
    combines map-side: a key holding a third of all rows is reduced in every
    task before the shuffle, where a window would send the whole group to one
    task.  Ties on ``order_col`` are broken by the remaining columns.
    """
    keys = _keys(key)
    rest = [c for c in df.columns if c not in keys and c != order_col]
    packed = F.struct(F.col(order_col).alias(order_col), *[F.col(c) for c in rest])
    best = df.groupBy(*keys).agg(F.max(packed).alias("_best"))
    return best.select(*keys, *[F.col(f"_best.{c}").alias(c) for c in [order_col] + rest]) \
        .select(*df.columns)


def upsert(prod: DataFrame, stg: DataFrame, key: str | Sequence[str],
           order_col: str = "updated_at") -> DataFrame:
    """X1 (``operation: Merge``): staging rows replace production rows with the
    same key, production rows without a staging match are kept, new keys are
    inserted.  Staging is first reduced to one row per key (greatest
    ``order_col``, which must be named and present; ties by all columns).  Rows with a NULL key never match and
    are all kept, as in J1.  Returns the new production snapshot.
    """
    keys = _keys(key)
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    stg = stg.select(*prod.columns)
    keyed = stg.where(~null_key)
    if order_col not in prod.columns:
        raise ValueError(f"merge needs an order column to pick the latest row; {order_col!r} is absent")
    latest = latest_per_key(keyed, keys, order_col)
    kept = insert_new(prod, latest, keys, prod.columns)
    return kept.unionByName(latest).unionByName(stg.where(null_key))


def assign_identity(df: DataFrame, key: str | Sequence[str], id_col: str,
                    start: Column | int = 0) -> DataFrame:
    """P5: a dense identity ``start + 1, start + 2, ...`` in key order.

    Distributed, no single-partition window: rows are range-partitioned and
    sorted by key and kept once in the shared checkpoint folder (counting and
    numbering must see one and the same partitioning, whatever exchanges the
    optimizer reuses); ``monotonically_increasing_id`` carries the partition
    index (upper bits) and the position in the partition (lower 33 bits).  A
    count per partition (one row per partition -- a proven-small side,
    broadcast) gives each partition its offset.  ``start`` may be a scalar
    Column such as ``prod.agg(F.max("id")).scalar()``.
    """
    keys = _keys(key)
    # Ranging and sorting on every column makes the order total: a hot key's
    # rows spread over several range partitions (still in key order), and a
    # partition recomputed after an executor loss numbers its rows as before.
    rest = [c for c in df.columns if c not in keys]
    ordered = df.repartitionByRange(*keys, *rest).sortWithinPartitions(*keys, *rest)
    t = (ordered.withColumn("_mid", F.monotonically_increasing_id())
         .withColumn("_pid", F.shiftright("_mid", 33))
         .withColumn("_local", F.col("_mid").bitwiseAND((1 << 33) - 1)))
    ensure_checkpoint_dir(df.sparkSession)
    t = t.checkpoint(eager=True)
    counts = t.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    base = start if isinstance(start, Column) else F.lit(int(start))
    out = t.join(F.broadcast(offsets), "_pid")
    return out.withColumn(id_col, (F.coalesce(base, F.lit(0)) + F.col("_off") + F.col("_local") + 1)
                          .cast("bigint")).drop("_mid", "_pid", "_local", "_off")


def for_host(summary: DataFrame, servers: DataFrame, host: str) -> DataFrame:
    """Summary rows whose server belongs to ``host`` (``IN (subquery)``)."""
    ids = servers.where(F.col("host_name") == host).select(F.col("id").alias("_sid"))
    return summary.join(ids, summary["reporting_database_server_id"] == F.col("_sid"), "left_semi")


def advance_loaded_date(summary: DataFrame, servers: DataFrame, host: str,
                        loads: DataFrame) -> DataFrame:
    """M7: monotonic high-water update of ``latest_loaded_date``.

    For summary rows of ``host``'s servers whose table appears in
    ``loads(table_name, loaded_at)``: NULL becomes the new value, otherwise the
    later of old and new is kept.  Other rows are unchanged.  Returns the new
    summary snapshot.
    """
    ids = (servers.where(F.col("host_name") == host)
           .select(F.col("id").alias("_sid")).distinct())
    new = loads.groupBy(F.col("table_name").alias("_lt")).agg(F.max("loaded_at").alias("_new"))
    s = (summary.join(ids, summary["reporting_database_server_id"] == F.col("_sid"), "left")
         .join(new, F.col("table_name") == F.col("_lt"), "left"))
    hit = F.col("_sid").isNotNull() & F.col("_new").isNotNull()
    old = F.col("latest_loaded_date")
    upd = F.when(old.isNull(), F.col("_new")).otherwise(F.greatest(old, F.col("_new")))
    return s.select(*[(F.when(hit, upd).otherwise(old).alias(c) if c == "latest_loaded_date"
                       else F.col(c)) for c in summary.columns])


def project(df: DataFrame, mapping: Mapping[str, str] | Sequence[tuple[str, str]]) -> DataFrame:
    """Select ``source AS target`` pairs (the output of P6)."""
    pairs = mapping.items() if isinstance(mapping, Mapping) else mapping
    return df.select(*[F.col(s).alias(t) for s, t in pairs])
