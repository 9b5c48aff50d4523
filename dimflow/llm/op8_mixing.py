"""Operator 8: mixing sources to target weights by iterative proportional fitting.

Token counts are summed into cells (source, language, topic).  Raking scales
the cells until the shares of sources, languages and topics all match their
targets; a cell's weight is its raked share over its own share.  Documents are
then sampled with probabilities proportional to their cell's weight, the
largest being 1: the largest sample that holds the mix in expectation.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimflow.llm.common import cut

DIMS = ("source", "lang", "topic")
#: Exponent of the default targets: a share is the token share to this power.
TEMPER = 0.9
#: Cells up to this number are raked on the driver (three small arrays), more
#: of them by grouped sums on the cluster, with the same result.
DRIVER_CELLS = 200_000
NONE = "(none)"


def topic_of(text: F.Column) -> F.Column:
    """Default topic: the kind of writing, from shares of characters."""
    n = F.greatest(F.length(text), F.lit(1))
    pipes = n - F.length(F.replace(text, F.lit("|"), F.lit("")))
    marks = n - F.length(F.translate(text, "#*$%&<>", ""))
    return (F.when(pipes / n > 0.02, "table").when(marks / n > 0.05, "symbols")
            .when(n < 400, "short").otherwise("prose"))


def _text() -> F.Column:
    return F.coalesce(F.col("text").cast("string"), F.lit(""))


def _categories(topic: F.Column | None) -> list[F.Column]:
    named = [F.coalesce(F.col(d).cast("string"), F.lit(NONE)).alias(d) for d in DIMS[:2]]
    return [*named, (topic if topic is not None else topic_of(_text())).alias("topic")]


def _described(docs: DataFrame, topic: F.Column | None) -> DataFrame:
    """(doc_id, source, lang, topic, tokens); blank-separated words count."""
    squeezed = F.regexp_replace(_text(), "[^\\x20\\t-\\r]+", "w")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), *_categories(topic),
        (F.length(squeezed) - F.length(F.replace(squeezed, F.lit("w"), F.lit(""))))
        .cast("long").alias("tokens"))


def default_targets(cells: DataFrame) -> dict[str, DataFrame]:
    """Target shares of each dimension: tempered token shares."""
    out = {}
    for d in DIMS:
        sums = cells.groupBy(d).agg(F.pow(F.sum("tokens").cast("double"), F.lit(TEMPER))
                                    .alias("raw"))
        total = sums.agg(F.sum("raw")).scalar()
        out[d] = sums.select(d, (F.col("raw") / total).alias("target"))
    return out


def rake(cells: DataFrame, targets: dict[str, DataFrame], rounds: int = 200,
         tolerance: float = 1e-9, driver_cells: int = DRIVER_CELLS) -> DataFrame:
    """(source, lang, topic, weight): raked share over own share of each cell.

    A category without a target, or with target 0, gets weight 0.  Targets that
    no weights can meet together (empty cells) are met as far as the rounds go.
    """
    cells = cells.where("tokens > 0")
    for d in DIMS:
        cells = cells.join(targets[d].select(F.col(d), F.col("target").alias(f"t_{d}")), d, "left")
    cells = cut(cells.na.fill(0.0, [f"t_{d}" for d in DIMS]))
    if cells.count() > driver_cells:
        return _rake_cluster(cells, rounds, tolerance)
    rows = cells.select(*DIMS, "tokens", *(f"t_{d}" for d in DIMS)).collect()
    schema = "source string, lang string, topic string, weight double"
    if not rows:
        return cells.sparkSession.createDataFrame([], schema)
    rows.sort(key=lambda r: r[:3])
    own = np.array([float(r.tokens) for r in rows])
    own /= own.sum()
    x = own.copy()
    index, want = [], []
    for k, d in enumerate(DIMS):
        names = sorted({r[k] for r in rows})
        at = {n: i for i, n in enumerate(names)}
        index.append(np.array([at[r[k]] for r in rows]))
        t = np.zeros(len(names))
        t[index[-1]] = [r[f"t_{d}"] for r in rows]
        want.append(t / t.sum() if t.sum() > 0 else t)
    for _ in range(rounds):
        worst = 0.0
        for i, t in zip(index, want):
            have = np.bincount(i, weights=x, minlength=len(t))
            worst = max(worst, float(np.abs(have - t).max()))
            x *= (np.divide(t, have, out=np.zeros_like(t), where=have > 0))[i]
        if worst < tolerance:
            break
    return cells.sparkSession.createDataFrame(
        [(*r[:3], float(w)) for r, w in zip(rows, x / own)], schema)


def _rake_cluster(cells: DataFrame, rounds: int, tolerance: float) -> DataFrame:
    total = cells.agg(F.sum("tokens")).first()[0]
    now = cells.withColumn("own", F.col("tokens") / F.lit(float(total)))
    for d in DIMS:
        s = now.groupBy(d).agg(F.max(f"t_{d}").alias("t")).agg(F.sum("t")).first()[0]
        now = now.withColumn(f"t_{d}", F.col(f"t_{d}") / F.lit(s or 1.0))
    now = cut(now.withColumn("x", F.col("own")))
    for _ in range(rounds):
        worst = 0.0
        for d in DIMS:
            sums = now.groupBy(d).agg(F.sum("x").alias("have"), F.max(f"t_{d}").alias("t"))
            worst = max(worst, sums.agg(F.max(F.abs(F.col("have") - F.col("t")))).first()[0])
            now = now.join(sums.select(d, F.when(F.col("have") > 0, F.col("t") / F.col("have"))
                                       .otherwise(0.0).alias("f")), d)
            now = now.withColumn("x", F.col("x") * F.col("f")).drop("f")
        now = cut(now)
        if worst < tolerance:
            break
    return now.select(*DIMS, (F.col("x") / F.col("own")).alias("weight"))


def _weights(rows: DataFrame, targets) -> tuple[DataFrame, float, bool]:
    """(cell weights, the largest, whether they are few enough to broadcast)."""
    cells = cut(rows.groupBy(*DIMS).agg(F.sum("tokens").alias("tokens")))
    weights = cut(rake(cells, targets or default_targets(cells)))
    return (weights, weights.agg(F.max("weight")).first()[0] or 1.0,
            weights.count() <= DRIVER_CELLS)


def _unit(doc_id: F.Column, seed: int) -> F.Column:
    """A number in [0, 1) that depends on the id alone."""
    return F.pmod(F.xxhash64(doc_id.cast("long"), F.lit(seed)),
                  F.lit(1 << 40)) / F.lit(float(1 << 40))


def mix_sources(docs: DataFrame, targets: dict[str, DataFrame] | None = None,
                topic: F.Column | None = None, seed: int = 17) -> DataFrame:
    """(doc_id, source, lang, topic, tokens, weight, probability, kept) per row.

    ``targets`` maps source, lang and topic to (category, target) rows; by
    default shares are tempered.  A null source or language is the category
    "(none)".  Null, empty and wordless texts have no tokens, weight 0 and
    probability 0 unless their cell has tokens.  ``kept`` compares a hash of
    the id with the probability, so repeated rows are kept or dropped together.
    An empty table gives no rows.
    """
    rows = _described(docs, topic)
    weights, top, small = _weights(rows, targets)
    return (rows.join(F.broadcast(weights) if small else weights, list(DIMS), "left")
            .withColumn("weight", F.coalesce("weight", F.lit(0.0)))
            .withColumn("probability", F.least(F.lit(1.0), F.col("weight") / F.lit(top)))
            .withColumn("kept", _unit(F.col("doc_id"), seed) < F.col("probability"))
            .select("doc_id", *DIMS, "tokens", "weight", "probability", "kept"))


def sample_mix(docs: DataFrame, targets: dict[str, DataFrame] | None = None,
               topic: F.Column | None = None, seed: int = 17) -> DataFrame:
    """The rows of ``docs`` that ``mix_sources`` keeps, all columns as they are
    (``docs`` needs ``doc_id``, ``text``, ``source`` and ``lang``)."""
    rows = _described(docs, topic)
    weights, top, small = _weights(rows, targets)
    own = "mix"
    while own in docs.columns:
        own += "_"
    given = docs.withColumn(own, F.struct(*_categories(topic)))
    weights = weights.select(F.struct(*DIMS).alias(own), F.col("weight").alias(own + "w"))
    return (given.join(F.broadcast(weights) if small else weights, own, "left")
            .where(_unit(F.col("doc_id"), seed) < F.coalesce(own + "w", F.lit(0.0)) / F.lit(top))
            .select(*docs.columns))
