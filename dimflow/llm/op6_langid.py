"""Operator 6: language identification by sparse multinomial logistic regression
on TF-IDF character n-grams.

Texts are lower-cased, everything but letters becomes one space, and n-grams of
one to three characters are hashed into 2**HASH_BITS features.  A feature's
value is its relative frequency times its inverse document frequency, which is
counted over all training documents.  The model is fitted on a bounded sample
with per-coordinate follow-the-regularised-leader steps and an elastic-net
penalty, so most weights are exactly zero.  A temperature fitted on a part of
the sample that the weights have not seen calibrates the scores.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimflow.llm.common import map_arrow

HASH_BITS = 16
#: Bound of the training sample: documents expected for each language.
PER_LANGUAGE = 400
SCALE = 10.0
UNKNOWN = "und"
_BLOCK = 1 << 18
_MULT = [np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F),
         np.uint64(0x165667B19E3779F9)]


@functools.lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def features(text: str) -> Iterator[np.ndarray]:
    """Feature numbers of all n-grams of a text, in blocks; nothing if it has
    no letter."""
    letters = _letters()
    tail = np.array([32], dtype=np.uint64)
    for i in range(0, len(text), _BLOCK):
        c = np.frombuffer(text[i:i + _BLOCK].lower().encode("utf-32-le", "surrogatepass"),
                          dtype=np.uint32)
        keep = letters[c]
        if not keep.any() and tail[-1] == 32:
            continue
        c = np.where(keep, c, 32).astype(np.uint64)
        c = np.concatenate([tail, c])
        blank = c == 32
        c = c[~(blank & np.concatenate([[False], blank[:-1]]))]
        for k in range(3):
            gram = c[:len(c) - k].copy()
            for j in range(1, k + 1):
                gram = (gram << np.uint64(21)) ^ c[j:len(c) - k + j]
            # n-grams that lie in the tail were counted with the block before
            gram = gram[max(0, len(tail) - k):]
            yield ((gram * _MULT[k]) >> np.uint64(64 - HASH_BITS)).astype(np.int64)
        tail = c[-2:]


def _document_counts(docs: DataFrame) -> np.ndarray:
    """Documents that hold each feature, over all of ``docs``."""
    size = 1 << HASH_BITS

    def run(batches):
        total = np.zeros(size, dtype=np.int64)
        for batch in batches:
            for text in batch.column("text"):
                flag = np.zeros(size, dtype=bool)
                for f in features(text.as_py() or ""):
                    flag[f] = True
                total += flag
        hit = np.flatnonzero(total)
        if len(hit):
            yield pa.RecordBatch.from_arrays([pa.array(hit), pa.array(total[hit])],
                                             ["feature", "n"])
    out = np.zeros(size, dtype=np.int64)
    rows = map_arrow(docs.select("text"), run, "feature long, n long").groupBy("feature").agg(
        F.sum("n").alias("n")).collect()               # at most 2**HASH_BITS rows
    for r in rows:
        out[r.feature] = r.n
    return out


class Model:
    """Languages, feature weights (idf folded in), biases and temperature."""

    def __init__(self, languages, weights, bias, temperature):
        self.languages, self.weights, self.bias = languages, weights, bias
        self.temperature = temperature

    def logits(self, text: str) -> np.ndarray | None:
        total, n = np.zeros(len(self.languages)), 0
        for f in features(text):
            total += self.weights[f].sum(axis=0, dtype=np.float64)
            n += len(f)
        return self.bias + total * SCALE / n if n else None

    def predict(self, text: str | None) -> tuple[str, float]:
        z = self.logits(text) if text and self.languages else None
        if z is None:
            return UNKNOWN, 0.0
        p = np.exp((z - z.max()) / self.temperature)
        best = int(z.argmax())
        return self.languages[best], float(p[best] / p.sum())


def fit_ftrl(rows, classes: int, epochs: int = 4, alpha: float = 0.5, beta: float = 1.0,
             l1: float = 0.02, l2: float = 0.02) -> tuple[np.ndarray, np.ndarray]:
    """Weights and biases from (feature numbers, values, class) rows."""
    size = 1 << HASH_BITS
    z, n = np.zeros((size + 1, classes)), np.zeros((size + 1, classes))
    rng = np.random.default_rng(3)

    def weight(k):
        zk = z[k]
        return np.where(np.abs(zk) > l1, (np.sign(zk) * l1 - zk)
                        / ((beta + np.sqrt(n[k])) / alpha + l2), 0.0)
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            k, x, y = rows[i]
            k, x = np.append(k, size), np.append(x, 1.0)
            w = weight(k)
            s = x @ w
            p = np.exp(s - s.max())
            p /= p.sum()
            p[y] -= 1.0
            g = x[:, None] * p
            nk = n[k]
            sigma = (np.sqrt(nk + g * g) - np.sqrt(nk)) / alpha
            z[k] += g - sigma * w
            n[k] = nk + g * g
    w = weight(np.arange(size + 1))
    return w[:-1], w[-1]


def _temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature of least log-loss (golden section on its logarithm)."""
    def loss(t):
        s = logits / np.exp(t)
        s = s - s.max(axis=1, keepdims=True)
        return float((np.log(np.exp(s).sum(axis=1)) - s[np.arange(len(y)), y]).mean())
    lo, hi, g = -4.0, 4.0, (5 ** 0.5 - 1) / 2
    for _ in range(60):
        a, b = hi - g * (hi - lo), lo + g * (hi - lo)
        lo, hi = (lo, b) if loss(a) <= loss(b) else (a, hi)
    return float(np.exp((lo + hi) / 2))


def held_out(column: str = "doc_id") -> F.Column:
    """Documents that training never sees: crc32 of the id's text mod 3 is 1."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Model:
    """A model of all languages of the training documents.

    About ``per_language`` documents of each language are sampled by a hash of
    their text and id; document frequencies cover every training document.
    """
    seen = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"),
                       F.col("lang").cast("string").alias("lang")).where(
        ~held_out() & F.col("text").isNotNull() & F.col("lang").isNotNull())
    totals = {r.lang: r["n"] for r in seen.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(totals)
    if not languages:
        return Model([], np.zeros((1 << HASH_BITS, 0)), np.zeros(0), 1.0)
    idf = np.log((1 + sum(totals.values())) / (1 + _document_counts(seen))) + 1.0
    rates = docs.sparkSession.createDataFrame(            # one row a language
        [(k, min(1.0, per_language / v)) for k, v in totals.items()], "lang string, rate double")
    unit = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    chosen = seen.join(F.broadcast(rates), "lang").where(unit < F.col("rate"))

    def run(batches):
        for batch in batches:
            out = []
            for text in batch.column("text"):
                parts = list(features(text.as_py()))
                k, c = np.unique(np.concatenate(parts), return_counts=True) if parts else (
                    np.zeros(0, int), np.zeros(0, int))
                out.append((k.astype(np.int32).tobytes(), c.astype(np.int32).tobytes()))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("lang"),
                     pa.array([o[0] for o in out], pa.binary()),
                     pa.array([o[1] for o in out], pa.binary())], ["doc_id", "lang", "k", "c"])
    rows = []
    for r in map_arrow(chosen.select("doc_id", "lang", "text"), run,
                       "doc_id long, lang string, k binary, c binary").collect():
        k, c = np.frombuffer(r.k, dtype=np.int32), np.frombuffer(r.c, dtype=np.int32)
        if len(k):
            rows.append((r.doc_id or 0, r.k, k, c * idf[k] * SCALE / c.sum(),
                         languages.index(r.lang)))
    rows.sort(key=lambda r: (r[0], r[1]))
    rows = [r[2:] for r in rows]
    if not rows:
        return Model([], np.zeros((1 << HASH_BITS, 0)), np.zeros(0), 1.0)
    check = rows[::4] if len(rows) >= 8 else []
    w, b = fit_ftrl([r for i, r in enumerate(rows) if i % 4 or not check], len(languages))
    t = 1.0
    if check:
        t = _temperature(np.array([x @ w[k] + b for k, x, _ in check]),
                         np.array([y for _, _, y in check]))
    return Model(languages, (w * idf[:, None]).astype(np.float32), b, t)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row; reads whole texts.

    ``lang_pred`` is a language of the model, or "und" (score 0) if the text is
    null, empty or without a letter, or the model knows no language.  A tie of
    languages goes to the first by name.  Repeated rows each give a row, an
    empty table none; of ``docs`` only ``doc_id`` and ``text`` are read.
    """
    def run(batches):
        for batch in batches:
            got = [model.predict(t.as_py()) for t in batch.column("text")]
            if got:
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("held_out"),
                     pa.array([g[0] for g in got]), pa.array([g[1] for g in got])],
                    ["doc_id", "held_out", "lang_pred", "score"])
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text")).withColumn("held_out",
                                                                              held_out())
    return map_arrow(rows, run, "doc_id long, held_out boolean, lang_pred string, score double")
