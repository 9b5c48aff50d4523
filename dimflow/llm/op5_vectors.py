"""Operator 5: near-duplicate vectors by cross-polytope hashing.

A vector is rotated (three rounds of random signs and a fast Hadamard
transform) and hashed to its nearest signed axis.  A table's code joins FUNCTIONS such
hashes; besides its own bucket in each of TABLES tables a vector probes the
PROBES buckets where one hash takes the second nearest axis at the least loss.
Pairs that meet in a bucket are verified by cosine in double precision.

Equal vectors are one class from the start.  Buckets with one class are dropped
before vectors move.  Larger buckets are split into blocks; a task compares
two blocks with one matrix product and returns only link counts and a spanning
star of each block's components, never the pairs.  A pair counts in the first
table in which it meets, which both vectors' codes tell.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimflow.llm.common import components, cut, map_arrow, partitions

TABLES, FUNCTIONS, PROBES = 8, 3, 3
#: Vectors of a block; a bucket of b blocks makes b * (b + 1) / 2 comparisons.
BLOCK = 512
SEED = 7


def _hadamard(x: np.ndarray) -> np.ndarray:
    n, d = x.shape
    h = 1
    while h < d:
        x = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(n, d)
        h *= 2
    return x


def codes(x: np.ndarray, tables: int = TABLES, functions: int = FUNCTIONS,
          probes: int = PROBES) -> np.ndarray:
    """[vectors, tables, 1 + probes] bucket codes: own code, then probed ones."""
    n, dim = x.shape
    d = 1 << max(1, (dim - 1).bit_length())
    padded = np.zeros((n, d))
    padded[:, :dim] = x
    rng = np.random.default_rng(SEED)
    out = np.empty((n, tables, 1 + probes), dtype=np.int64)
    rows = np.arange(n)
    for t in range(tables):
        best, second, loss = [], [], []
        for _ in range(functions):
            y = padded
            for _ in range(3):
                y = _hadamard(y * rng.choice([-1.0, 1.0], size=d)) / np.sqrt(d)
            size = np.abs(y)
            two = np.argpartition(-size, 1, axis=1)[:, :2]
            swap = size[rows, two[:, 0]] < size[rows, two[:, 1]]
            two[swap] = two[swap][:, ::-1]
            axis = two + d * (y[rows[:, None], two] < 0)
            best.append(axis[:, 0])
            second.append(axis[:, 1])
            loss.append(size[rows, two[:, 0]] - size[rows, two[:, 1]])
        base = 2 * d
        own = sum(b * base ** f for f, b in enumerate(best))
        other = np.stack([own + (s - b) * base ** f
                          for f, (b, s) in enumerate(zip(best, second))], axis=1)
        order = np.argsort(np.stack(loss, axis=1), axis=1, kind="stable")[:, :probes]
        out[:, t, 0] = own
        out[:, t, 1:] = -1
        out[:, t, 1:1 + order.shape[1]] = np.take_along_axis(other, order, 1)
    return out


def _matrix(column: pa.Array) -> list[tuple[int, np.ndarray]]:
    """(row, vector) of the rows whose vector can link: neither null nor zero,
    without null or non-finite components."""
    out = []
    for i, v in enumerate(column):
        if v.is_valid and len(v) and v.values.null_count == 0:
            x = np.asarray(v.values.to_numpy(zero_copy_only=False), dtype=np.float64)
            if np.isfinite(x).all() and x.any():
                out.append((i, x + 0.0))
    return out


def _classes(vectors: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            key: list = [None] * batch.num_rows
            for i, x in _matrix(batch.column("vec")):
                digest = hashlib.blake2b(x.tobytes(), digest_size=16).digest()
                key[i] = digest
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(key, pa.binary()), batch.column("vec")],
                ["vec_id", "key", "vec"])
    return map_arrow(vectors, run, "vec_id long, key binary, vec array<double>")


def _entries(classes: DataFrame, tables: int, functions: int, probes: int) -> DataFrame:
    """(rep, n, vec, codes) rows with all codes, flattened table by table."""
    def run(batches):
        for batch in batches:
            found = _matrix(batch.column("vec"))
            by_dim: dict[int, list] = {}
            for i, x in found:
                by_dim.setdefault(len(x), []).append((i, x))
            for dim, rows in by_dim.items():
                x = np.stack([v for _, v in rows])
                # a common power of two keeps the norm finite for any input
                x = x / np.abs(x).max(axis=1, keepdims=True)
                x /= np.linalg.norm(x, axis=1, keepdims=True)
                c = codes(x, tables, functions, probes)
                c = np.where(c >= 0, c * 65536 + dim % 65536, -1)
                at = pa.array([i for i, _ in rows])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("rep").take(at), batch.column("n").take(at),
                     _lists(x), _lists(c.reshape(len(rows), -1))], ["rep", "n", "vec", "codes"])
    return map_arrow(classes, run, "rep long, n long, vec array<double>, codes array<long>")


def _lists(x: np.ndarray) -> pa.Array:
    n, k = x.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * k),
                                    pa.array(np.ascontiguousarray(x).ravel()))


def _compare(rep, n, x, code, own, side, table, bucket, same, threshold):
    """Partial (rep, n_links, star) rows of one block pair."""
    sim = x @ x.T
    i, j = np.nonzero(np.triu(sim >= threshold, 1))
    ok = own[i] | own[j]
    if not same:
        ok &= side[i] != side[j]
    i, j = i[ok], j[ok]
    # pairs met in an earlier table count there
    a, b = code[i], code[j]
    for t in range(table):
        met = (a[:, t, :1] == b[:, t]).any(axis=1) | (b[:, t, :1] == a[:, t]).any(axis=1)
        i, j, a, b = i[~met], j[~met], a[~met], b[~met]
    # of two buckets of one table, the pair counts in the smaller
    oa, ob = a[:, table, 0], b[:, table, 0]
    twice = (oa != ob) & (a[:, table, 1:] == ob[:, None]).any(axis=1) \
        & (b[:, table, 1:] == oa[:, None]).any(axis=1) & (np.minimum(oa, ob) != bucket)
    i, j = i[~twice], j[~twice]
    if not len(i):
        return None
    links = np.bincount(i, weights=n[j], minlength=len(rep)) \
        + np.bincount(j, weights=n[i], minlength=len(rep))
    label = rep.copy()
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        if (new == label).all():
            break
        label = new
    hit = links > 0
    return rep[hit], links[hit].astype(np.int64), label[hit]


def _links(blocks: DataFrame, tables: int, probes: int, threshold: float) -> DataFrame:
    """Streams block-pair members sorted by (dim, t, bucket, bi, bj); the
    members of one block pair are held together."""
    def flush(rows):
        dim, t, bucket, bi, bj, block, rep, n, x, code = (np.concatenate(c) for c in zip(*rows))
        bounds = [0, *(_changes([t, bucket, bi, bj])).tolist(), len(t)]
        out = []
        for lo, hi in zip(bounds, bounds[1:]):
            if hi - lo > 1:
                c = code[lo:hi].reshape(hi - lo, tables, 1 + probes)
                got = _compare(rep[lo:hi], n[lo:hi], x[lo:hi], c,
                               c[:, t[lo], 0] == bucket[lo], block[lo:hi] == bi[lo], int(t[lo]),
                               bucket[lo], bi[lo] == bj[lo], threshold)
                if got:
                    out.append(got)
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(c)) for c in zip(*out)], ["rep", "links", "star"])

    def run(batches):
        held: list = []
        for batch in batches:
            if not batch.num_rows:
                continue
            dims = batch.column(0).to_numpy()
            cuts = [0, *_changes([dims]).tolist(), len(dims)]
            for lo, hi in zip(cuts, cuts[1:]):              # vectors of one length
                part = batch.slice(lo, hi - lo)
                cols = [part.column(i).to_numpy() for i in range(8)] + [
                    part.column(i).flatten().to_numpy().reshape(hi - lo, -1) for i in (8, 9)]
                change = _changes(cols[:5])
                last = int(change[-1]) if len(change) else 0
                if held and any(held[-1][i][-1] != cols[i][0] for i in range(5)):
                    yield from flush(held)
                    held = []
                if last:
                    yield from flush([*held, [c[:last] for c in cols]])
                    held = []
                held.append([c[last:] for c in cols])
        if held:
            yield from flush(held)
    return map_arrow(blocks, run, "rep long, links long, star long")


def _changes(keys: list[np.ndarray]) -> np.ndarray:
    """Positions at which any of the keys differs from the row before."""
    return np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1


def near_vectors(vectors: DataFrame, threshold: float = 0.95, tables: int = TABLES,
                 functions: int = FUNCTIONS, probes: int = PROBES) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors``.

    ``vectors`` needs ``vec_id`` (long) and ``embedding`` (array of numbers);
    other columns are not read.  Two vectors of one length link when their
    cosine is at least ``threshold``, computed in double precision; only links
    found by the hash tables count (all of equal vectors are).  Vectors that
    are null, empty or zero, or hold null or non-finite components, link with
    nothing.  ``component_id`` is the smallest vec_id reachable, ``kept`` marks
    it.  Equal vectors under several ids are linked; repeated rows each give a
    row and count as vectors.  An empty table gives no rows.
    """
    spark = vectors.sparkSession
    rows = cut(_classes(vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("embedding").cast("array<double>").alias("vec"))))
    classes = (rows.where("key is not null").groupBy("key")
               .agg(F.min("vec_id").alias("rep"), F.count("*").alias("n"),
                    F.first("vec").alias("vec")))
    classes = classes.where("rep is not null")
    coded = cut(_entries(classes.select("rep", "n", "vec"), tables, functions, probes))
    width = 1 + probes
    entries = coded.select("rep", F.posexplode("codes").alias("at", "bucket")).where(
        "bucket >= 0").select(
        "rep", F.expr(f"at div {width}").cast("int").alias("t"), "bucket",
        F.expr(f"at % {width} = 0").alias("own"))
    live = (entries.groupBy("t", "bucket")
            .agg(F.count("*").alias("size"), F.max("own").alias("any_own"))
            .where("size > 1 and any_own")
            .select("t", "bucket", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks")))
    members = entries.join(live, ["t", "bucket"]).select(
        "rep", "t", "bucket", "blocks",
        F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int").alias("block"))
    # vectors and codes move to live buckets only
    pairs = (members.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
             .join(coded, "rep")
             .select(F.size("vec").alias("dim"), "t", "bucket",
                     F.least("block", "other").alias("bi"),
                     F.greatest("block", "other").alias("bj"), "block", "rep", "n", "vec", "codes"))
    pairs = pairs.repartition(partitions(spark), "t", "bucket", "bi", "bj").sortWithinPartitions(
        "dim", "t", "bucket", "bi", "bj")
    found = cut(_links(pairs, tables, probes, threshold))
    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    labels = components(found.select(F.col("rep").alias("a"), F.col("star").alias("b")))
    per_class = (classes.select("key", "rep", "n").join(counts, "rep", "left")
                 .join(labels, F.col("rep") == F.col("v"), "left")
                 .select("key", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                         F.coalesce("component", "rep").alias("component_id")))
    return (rows.select("vec_id", "key").join(per_class, "key", "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component_id", "vec_id").alias("component_id"))
            .withColumn("kept", F.col("vec_id") == F.col("component_id")))
