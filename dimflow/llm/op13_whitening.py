"""Operator 13: whitening of embeddings by a distributed Jacobi-Davidson method.

Vectors become integers on a fixed grid, so counts and sums are exact.  The
covariance of the distinct vectors is never formed: Spark multiplies it by a
few vectors at a time, block by block of the fit list, centring first.  A block
Jacobi-Davidson iteration on the driver works on matrices of the dimension by
a few dozen columns only: Rayleigh-Ritz in a subspace, locking of leading pairs
whose residual has reached rounding level, and new directions from the projected
correction equations, which inner MINRES steps solve for all open pairs at once
(one distributed product a step).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimflow.llm.common import cut, map_arrow

#: Grid of the integers: floor(GRID * entry) + SHIFT.
GRID, SHIFT = 64, 1_000_000
#: Entries beyond 2**40 have no exact place on the grid (sums of a batch must
#: stay within 64 bits); such rows are dropped as non-finite ones are.
LIMIT = float(1 << 40)
#: Vectors packed into one block of the fit list.
ROWS = 2048
#: Extra directions of the first subspace, and columns of the largest one.
GUARD, SUBSPACE = 8, 128
#: Inner steps of a correction equation, and outer rounds at most.
INNER, ROUNDS = 6, 200
#: Eigenvalues below this share of the trace are rounding noise: no component.
NOISE = 1e-12


def _valid(vectors: DataFrame) -> DataFrame:
    """(vec_id, x) of the rows that can be used, in the most frequent dimension
    (of equally frequent ones the smallest)."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                          F.col("embedding").cast("array<double>").alias("vec"))
    rows = rows.where(
        (F.size("vec") > 0) & F.forall("vec", lambda c: F.coalesce(
            ~F.isnan(c) & (F.abs(c) < F.lit(LIMIT)), F.lit(False))))
    rows = rows.select("vec_id", F.transform("vec", lambda c: (
        F.floor(c * F.lit(float(GRID))) + F.lit(SHIFT)).cast("long")).alias("x"))
    dim = (rows.groupBy(F.size("x").alias("dim")).count()
           .orderBy(F.desc("count"), "dim").first())
    return rows.where(F.size("x") == F.lit(dim.dim if dim else -1))


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    """The vectors of an Arrow list column, one a row."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, d)


def _fit_blocks(rows: DataFrame, d: int) -> DataFrame:
    """The distinct vectors, packed ROWS at a time, in the shared folder."""
    def run(batches):
        for batch in batches:
            x = _matrix(batch.column(0), d)
            parts = [x[i:i + ROWS] for i in range(0, len(x), ROWS)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([p.astype("<i8").tobytes() for p in parts], pa.binary())], ["block"])
    return cut(map_arrow(rows.select("x").distinct(), run, "block binary"))


def _totals(blocks: DataFrame, d: int) -> tuple[int, list[int]]:
    """(n, S): the number of distinct vectors and their exact sums."""
    def run(batches):
        n, total = 0, np.zeros(d, dtype=object)
        for batch in batches:
            for raw in batch.column(0):
                x = np.frombuffer(raw.as_buffer(), dtype="<i8").reshape(-1, d)
                n += len(x)
                total += x.sum(axis=0).astype(object)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(d + 1), pa.int32()),
             pa.array([str(v) for v in [*total, n]])], ["i", "part"])
    found = dict(map_arrow(blocks, run, "i int, part string").groupBy("i").agg(
        F.sum(F.col("part").cast("decimal(38,0)"))).collect())
    return int(found[d]), [int(found[i]) for i in range(d)]


class _Centre:
    """Centring by the exact mean S / n, split into whole and fractional part,
    so that no digits are lost before the subtraction."""

    def __init__(self, n: int, sums: list[int]):
        self.whole = np.array([s // n for s in sums], dtype=np.int64)
        self.part = np.array([(s % n) / n for s in sums])

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole).astype(np.float64) - self.part


def _summed(blocks: DataFrame, d: int, centre: _Centre, height: int, width: int, part) -> np.ndarray:
    """The sum over all blocks of ``part(centred block)``, a matrix of height x
    width: tasks add up their blocks, Spark the tasks' rows."""
    def run(batches):
        total = np.zeros((height, width))
        for batch in batches:
            for raw in batch.column(0):
                x = np.frombuffer(raw.as_buffer(), dtype="<i8").reshape(-1, d)
                total += part(centre(x))
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(height), pa.int32()),
             *[pa.array(total[:, j]) for j in range(width)]],
            ["i", *[f"c{j}" for j in range(width)]])
    names = [f"c{j}" for j in range(width)]
    rows = map_arrow(blocks, run, "i int, " + ", ".join(f"{c} double" for c in names)).groupBy(
        "i").agg(*[F.sum(c).alias(c) for c in names]).collect()
    out = np.zeros((height, width))
    for r in rows:
        out[r.i] = r[1:]
    return out


def _orthonormal(t: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """The columns of ``t`` made orthonormal to ``basis`` and each other;
    directions that vanish are left out."""
    for _ in range(2):
        t = t - basis @ (basis.T @ t)
        size = np.linalg.norm(t, axis=0)
        t = t[:, size > 0] / size[size > 0]
    kept: list[np.ndarray] = []
    for v in t.T:
        for _ in range(2):
            for w in kept:
                v = v - w * (w @ v)
            v = v - basis @ (basis.T @ v)
        size = np.linalg.norm(v)
        if size > 1e-8:
            kept.append(v / size)
    return np.array(kept).T if kept else np.empty((len(basis), 0))


def _minres(product, theta: np.ndarray, basis: np.ndarray, rhs: np.ndarray, steps: int) -> np.ndarray:
    """A few MINRES steps on (I-QQ')(A - theta I)(I-QQ') t = rhs, for all columns
    side by side: one product of A with the block a step."""
    def project(y):
        return y - basis @ (basis.T @ y)
    rhs = project(rhs)
    beta = np.linalg.norm(rhs, axis=0)
    tiny = np.finfo(float).tiny
    v = rhs / np.maximum(beta, tiny)
    v_old, w, w_old, x = (np.zeros_like(v) for _ in range(4))
    phi, cs, sn = beta.copy(), -np.ones_like(beta), np.zeros_like(beta)
    dbar, eps, carry = np.zeros_like(beta), np.zeros_like(beta), np.zeros_like(beta)
    alive = beta > 0
    for _ in range(steps):
        y = project(product(v)) - theta * v - carry * v_old
        alpha = (v * y).sum(axis=0)
        y = project(y - alpha * v)
        carry = np.linalg.norm(y, axis=0)
        old_eps, delta, gbar = eps, cs * dbar + sn * alpha, sn * dbar - cs * alpha
        eps, dbar = sn * carry, -cs * carry
        gamma = np.hypot(gbar, carry)
        alive &= gamma > np.abs(theta) * 1e-14 + tiny
        safe = np.where(alive, gamma, 1.0)
        cs, sn = gbar / safe, carry / safe
        step, phi = cs * phi, sn * phi
        w_new = (v - old_eps * w_old - delta * w) / safe
        x = x + np.where(alive, step * w_new, 0.0)
        w_old, w = w, w_new
        alive &= carry > np.abs(theta) * 1e-14
        v_old, v = v, y / np.maximum(carry, tiny) * alive
        if not alive.any():
            break
    return x


def leading_pairs(product, d: int, wanted: int, scale: float,
                  rounds: int = ROUNDS, seed: int = 13) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues descending, unit eigenvectors) of a symmetric positive
    semidefinite d x d operator, the ``wanted`` largest, by block
    Jacobi-Davidson.  ``product`` multiplies a d x m matrix; ``scale`` bounds the
    largest eigenvalue."""
    block = min(d, wanted + GUARD)
    limit = min(d, max(SUBSPACE, 4 * block))
    tol = 4 * np.finfo(float).eps * np.sqrt(d)           # relative to the largest eigenvalue
    locked, values = np.empty((d, 0)), np.empty(0)
    basis = np.linalg.qr(np.random.default_rng(seed).standard_normal((d, block)))[0]
    image = product(basis)
    best = np.inf
    stalled = 0
    for _ in range(rounds):
        h = basis.T @ image
        theta, s = np.linalg.eigh((h + h.T) / 2)
        theta, s = theta[::-1], s[:, ::-1]
        open_pairs = min(wanted - len(values), len(theta))
        ritz, ritz_image = basis @ s, image @ s
        u, t = ritz[:, :open_pairs], theta[:open_pairs]
        residual = ritz_image[:, :open_pairs] - u * t
        residual -= locked @ (locked.T @ residual)
        size = np.linalg.norm(residual, axis=0)
        top = max(scale * 1e-300, float(max([*values[:1], *t[:1]], default=0.0)))
        ok = size <= tol * top
        # rounding of the products can hold the last digit back: no progress any more
        stalled = stalled + 1 if size.max() >= best * 0.5 else 0
        best = min(best, float(size.max()))
        whole = basis.shape[1] + locked.shape[1] >= d    # the subspace is everything
        done = open_pairs if whole or (stalled >= 3 and size.max() <= 64 * tol * top) else \
            int(np.argmin(np.r_[ok, False]))
        if done:
            locked = np.c_[locked, u[:, :done]]
            values = np.r_[values, t[:done]]
            basis, image = ritz[:, done:], ritz_image[:, done:]
            best, stalled = np.inf, 0
            u, t, residual = u[:, done:], t[done:], residual[:, done:]
        if len(values) >= min(wanted, d):
            break
        if limit < d and basis.shape[1] + u.shape[1] > limit - locked.shape[1]:   # thick restart
            keep = min(basis.shape[1], max(block - locked.shape[1], u.shape[1] + GUARD))
            if not done:
                basis, image = ritz, ritz_image
            basis, image = basis[:, :keep], image[:, :keep]
        t_new = _minres(product, t, np.c_[locked, u], -residual, INNER)
        new = _orthonormal(t_new, np.c_[locked, basis])
        if not new.shape[1]:
            new = _orthonormal(np.random.default_rng(seed + basis.shape[1]).standard_normal(
                (d, u.shape[1])), np.c_[locked, basis])
        new = new[:, :d - locked.shape[1] - basis.shape[1]]
        basis, image = np.c_[basis, new], np.c_[image, product(new)]
    else:
        raise RuntimeError("the eigenpairs did not settle")
    by = np.argsort(-values, kind="stable")
    return values[by], locked[:, by]


def whiten(vectors: DataFrame, components: int = 16) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error),
    one row for each usable row of ``vectors`` and component.

    Usable rows have a non-empty ``embedding`` of finite entries below 2**40 in
    size, in the table's most frequent dimension (the smallest of equally
    frequent ones); all others are dropped.  Entries c become floor(64 c) +
    1,000,000.  The fit list is each distinct vector once, so repeated rows and
    copies do not weigh more, yet each gives its rows.  ``n`` is the length of
    the list, ``deviation`` the exact sum over dimensions of (n x - S)**2 (null
    if beyond 64 bits), ``whitened`` the centred vector on the unit eigenvector
    over the root of its eigenvalue, ``explained`` the eigenvalue over the
    trace, ``identity_error`` the largest entry of the whitened covariance less
    the identity.  Fewer components than asked are given if fewer eigenvalues
    differ from zero: none for an empty table or a single distinct vector.  Null
    vec_ids stay null; only ``vec_id`` and ``embedding`` are read.
    """
    schema = ("vec_id long, component int, n long, deviation long, whitened double, "
              "explained double, identity_error double")
    spark = vectors.sparkSession
    rows = _valid(vectors)
    first = rows.select(F.size("x").alias("d")).first()
    if first is None:
        return spark.createDataFrame([], schema)
    d = first.d
    blocks = _fit_blocks(rows, d)
    n, sums = _totals(blocks, d)
    centre = _Centre(n, sums)

    def product(b: np.ndarray) -> np.ndarray:
        return _summed(blocks, d, centre, d, b.shape[1], lambda x: x.T @ (x @ b)) / n
    trace = float(_summed(blocks, d, centre, 1, 1, lambda x: (x * x).sum().reshape(1, 1))[0, 0]) / n
    if trace <= 0:
        return spark.createDataFrame([], schema)
    values, axes = leading_pairs(product, d, min(components, d), trace)
    kept = values > NOISE * trace
    values, axes = values[kept], axes[:, kept]
    axes = axes * np.where(axes[np.abs(axes).argmax(axis=0), range(axes.shape[1])] < 0, -1.0, 1.0)
    scaled = axes / np.sqrt(values)
    m = len(values)

    def moments(x):
        y = x @ scaled
        return np.r_[y.T @ y, y.sum(axis=0)[None]]
    second = _summed(blocks, d, centre, m + 1, m, moments) / n
    error = float(np.abs(second[:m] - np.outer(second[m], second[m]) - np.eye(m)).max())
    explained = values / trace
    exact_sums = np.array(sums, dtype=object)

    def deviations(x: np.ndarray) -> list:
        span = max(int(np.abs(x - centre.whole).max()) + 1, 1) * n
        if span * span * d < 1 << 62:
            rest = np.array([s % n for s in sums], dtype=np.int64)
            y = (x - centre.whole) * n - rest
            return (y * y).sum(axis=1).tolist()
        found = ((x.astype(object) * n - exact_sums) ** 2).sum(axis=1)
        return [int(v) if v < 1 << 63 else None for v in found]

    def run(batches):
        for batch in batches:
            for lo in range(0, len(batch), ROWS):
                part = batch.slice(lo, ROWS)
                x = _matrix(part.column("x"), d)
                k = len(x)
                at = pa.array(np.repeat(np.arange(k), m))
                yield pa.RecordBatch.from_arrays(
                    [part.column("vec_id").take(at),
                     pa.array(np.tile(np.arange(1, m + 1, dtype=np.int32), k)),
                     pa.array(np.full(k * m, n, dtype=np.int64)),
                     pa.array(deviations(x), pa.int64()).take(at),
                     pa.array((centre(x) @ scaled).ravel()),
                     pa.array(np.tile(explained, k)),
                     pa.array(np.full(k * m, error))],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained",
                     "identity_error"])
    return map_arrow(rows, run, schema)
