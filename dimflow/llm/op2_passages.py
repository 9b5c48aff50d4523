"""Operator 2: fuzzy repeated passages by collinear chaining of shared seeds.

Seeds are runs of SEED words chosen by winnowing: of every WINDOW consecutive
runs the one of least hash, so that chosen seeds leave no word between them.
They only name pairs of documents: all pairs of a seed's documents, if there are
no more than RARE of them, else each document with the first one and with the
one before.  Seeds of more than RARE documents are also joined in runs: the
chosen common seeds within each of SPANS words.  A pair needs two seeds near
each other in both documents, or one run.

What that leaves of common seeds comes after the passages found so far: pairs of
seeds LEAST to FAR words apart, one of them common, name all pairs of documents
that no links connect there yet, whatever their number.  So two documents that
share such seeds are compared or already in one class.

Passages come in classes: where all consecutive seeds of MIN_WORDS words and
more stand in an earlier document at one distance, the words are equal, and the
earlier document stands for the later one there.  What a pair shares within such
words is left to the pair with the earlier document, if that pair is there too.

The words around what a pair shares are then compared in full, by all their
runs of SEED words, so a pair needs no more than that one link.  Everything is sorted over the whole table, so the result does
not depend on files or batches.  Matches in order in both documents are chained
with costs for the gaps, chains are aligned word by word in their gaps and at
their ends, and passages of enough matched words and identity are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dimflow.llm import textkit as tk
from dimflow.llm.common import (FILTER_BITS, components, cut, id_filter, map_arrow, maybe,
                                partitions, slot_of)

#: 40 words of identity 0.8 hold a run of 4 equal words; chosen are about 2 of 5.
SEED, WINDOW = 4, 4
#: Documents of a seed that are all compared with each other.
RARE = 32
#: Words between two seeds of a pair that are near each other.
NEAR = 128
#: Words that a run of common seeds may take.
SPANS = (16, 32, 48)
#: Words between two seeds that are joined where one of them is common.
LEAST, FAR = 16, 64
#: Documents of a key that one task compares with as many others of it.
BLOCK = 512
#: Words compared on either side of what a pair shares.
MARGIN = 64
#: Places in the other document that a run of words is matched with, nearest rank first.
PLACES = 8
#: Words of pairs compared at a time.
COMPARED = 1 << 17
#: Pairs, or groups of matches, from which on they are handled all at once.
MANY = 8
#: Matches that are collected to be chained at once; groups that are too few for it.
COLLECTED, ALONE = 1 << 19, 16
#: Matches before another that are looked at first.
NEXT = 24
#: Words of the other side are looked up in a table of 2**SLOT_BITS bits.
SLOT_BITS = 21
#: Cost of each word of a gap, on either side, against SEED for each match.
GAP = 0.15
MAX_GAP = 40
MIN_SEEDS = 3
#: Least matched words and identity of a passage.
MIN_WORDS, MIN_IDENTITY = 40, 0.8
#: Words looked at beyond a chain's ends.
REACH = 24
_U = np.uint64


def _picked(batch: pa.RecordBatch) -> Iterator[tuple]:
    """(doc, pos, step, seed) arrays of the chosen seeds, by document and
    position; step is the distance to the document's next one, 0 for its last."""
    ids = batch.column("doc_id").to_numpy()
    for texts in tk.texts_of(batch.column("text")):
        s, e, cuts = texts.words()
        h = texts.hashes(s, e, tk.LOWER_VALUES)
        count = np.maximum(np.diff(cuts) - SEED + 1, 0)
        total = int(count.sum())
        if not total:
            continue
        doc = np.repeat(np.arange(len(texts)), count)
        first = np.cumsum(count) - count
        pos = np.arange(total) - np.repeat(first, count)
        # runs, each document followed by WINDOW - 1 greatest values
        at = np.arange(total) + doc * (WINDOW - 1)
        runs = np.full(total + len(texts) * (WINDOW - 1), ~_U(0))
        runs[at] = tk.windows(h, SEED)[np.repeat(cuts[:-1], count) + pos]
        least = runs[:len(runs) - WINDOW + 1].copy()
        low = np.zeros(len(least), dtype=np.int64)
        for k in range(1, WINDOW):                       # the first of the least of each window
            here = runs[k:k + len(least)]
            np.copyto(low, k, where=here < least)
            np.minimum(here, least, out=least)
        chosen = np.zeros(len(runs), dtype=bool)
        chosen[at + low[at]] = True
        pick = np.flatnonzero(chosen[at])
        step = np.append(np.diff(pos[pick]), 0)
        step[:-1][np.diff(doc[pick]) != 0] = 0
        yield ids[texts.first + doc[pick]], pos[pick], step, runs[at[pick]]


#: (word << STEP_BITS) + step, in one column that packs well in a shuffle; a step
#: is at most WINDOW.
STEP_BITS = 3


def _once(key: np.ndarray, doc: np.ndarray, lo: np.ndarray, hi: np.ndarray,
          step: np.ndarray) -> pa.RecordBatch:
    """One row for each key and document: the first word and the step of the
    first place, and the words to the last."""
    order = np.lexsort((lo, doc, key))
    key, doc, lo, hi, step = (c[order] for c in (key, doc, lo, hi, step))
    new = np.flatnonzero(np.concatenate(
        [[True], (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])])) if len(key) else order
    return pa.RecordBatch.from_arrays(
        [pa.array(key[new].view(np.int64)), pa.array(doc[new]),
         pa.array((lo[new] << STEP_BITS) + step[new]),
         pa.array((np.maximum.reduceat(hi, new) - lo[new] if len(new) else hi)
                  .astype(np.int32))],
        ["key", "doc", "at", "width"])


def _seeds(docs: DataFrame) -> DataFrame:
    """(key, doc, at, width): the seeds of each document, their first word and
    step, and the words they take."""
    def run(batches):
        for batch in batches:
            for doc, pos, step, seed in _picked(batch):
                yield _once(seed, doc, pos, pos + SEED, step)
    return map_arrow(docs, run, "key long, doc long, at long, width int")


_LOW = _U((1 << FILTER_BITS) - 1)
_CHOSEN = [("doc", np.int64), ("pos", np.int64), ("seed", _U)]


def _chosen(docs: DataFrame, bits: np.ndarray, shared: np.ndarray) -> DataFrame:
    """(doc, pos, seed): the chosen seeds that are in one of the filters, many of
    them in one row, so that the texts are not split and hashed for each step."""
    def run(batches):
        for batch in batches:
            for doc, pos, _, seed in _picked(batch):
                slot = (seed & _LOW).astype(np.int64)
                some = maybe(bits, slot) | maybe(shared, slot)
                if some.any():
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([np.ascontiguousarray(c[some], dtype=t).tobytes()])
                         for c, (_, t) in zip((doc, pos, seed), _CHOSEN)],
                        [name for name, _ in _CHOSEN])
    return _kept(map_arrow(docs, run, "doc binary, pos binary, seed binary"))


def _unpacked(batch: pa.RecordBatch) -> Iterator[tuple]:
    """(doc, pos, seed) arrays of each row of ``_chosen``."""
    for i in range(batch.num_rows):
        yield tuple(np.frombuffer(batch.column(name)[i].as_buffer(), dtype=t)
                    for name, t in _CHOSEN)


def _runs(chosen: DataFrame, bits: np.ndarray) -> DataFrame:
    """(key, doc, at, width): from each common seed, the common seeds and
    their distances within each of SPANS words; at has no step."""
    def run(batches):
        for batch in batches:
            for doc, pos, seed in _unpacked(batch):
                hot = maybe(bits, (seed & _LOW).astype(np.int64))
                doc, pos, seed = doc[hot], pos[hot], seed[hot]
                if not len(doc):
                    continue
                rows = np.arange(len(doc))
                part = np.cumsum(np.concatenate(
                    [[0], (doc[1:] != doc[:-1]) | (pos[1:] <= pos[:-1])]))
                place = part * (1 << 32) + pos
                out = []
                ends = [np.searchsorted(place, place + span - SEED, side="right")
                        for span in SPANS]
                key = seed.copy()
                for k in range(1, int((ends[-1] - rows).max())):
                    later = np.minimum(rows + k, len(rows) - 1)
                    key = tk.mix(key ^ tk.mix(seed[later] + (pos[later] - pos).astype(_U)))
                    last = np.zeros(len(rows), dtype=bool)
                    for end in ends:
                        last |= rows + k == end - 1
                    i = np.flatnonzero(last)
                    out.append((key[i], doc[i], pos[i], pos[later[i]] + SEED, 0 * i))
                if out:
                    yield _once(*(np.concatenate(c) for c in zip(*out)))
    return map_arrow(chosen, run, "key long, doc long, at long, width int")


def _links(rows: DataFrame) -> DataFrame:
    """(doc, other, at, width, oat, owidth), other < doc: all pairs of the documents
    of a key, or for more than RARE documents each with the first and with the
    one before; and a row (key, null) for each such key, or where lo is 1 for
    each other key of several documents."""
    def links(i, j, c):
        return [c[1][i], c[1][j], c[2][i], c[3][i], c[2][j], c[3][j]]

    def close(c, first):
        """Links of rows c; first is the first row of their first key, if rows
        of it have gone out before (c then begins with the last of these)."""
        key, n = c[0], len(c[0])
        start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        size = np.diff(np.append(start, n))
        common = size > RARE
        common[0] |= first is not None
        begin, hot = np.repeat(start, size), np.repeat(common, size)
        place = np.arange(n) - begin
        out = []
        for k in range(1, RARE):
            i = np.flatnonzero(~hot & (place >= k))
            if not len(i):
                break
            out.append(links(i, i - k, c))
        i = np.flatnonzero(hot & (place >= 1))
        out.append(links(i, i - 1, c))
        held, d = begin, c
        if first is not None:
            held = np.where(begin == 0, 0, begin + 1)
            d = [np.concatenate([[f], x]) for f, x in zip(first, c)]
        i = np.flatnonzero(hot & (place >= np.where((begin == 0) & (first is not None), 1, 2)))
        out.append([c[1][i], d[1][held[i]], c[2][i], c[3][i], d[2][held[i]], d[3][held[i]]])
        marked = size > 1
        marked[0] &= first is None
        marks = key[start[marked]]
        none, zero = np.zeros(len(marks), dtype=np.int64), np.zeros(len(marks), dtype=np.int32)
        kind = np.where(common[marked], none, 1 << STEP_BITS)
        cols = [np.concatenate([*x, y]) for x, y in
                zip(zip(*out), [marks, marks, kind, zero, none, zero])]
        if len(cols[0]):
            null = np.arange(len(cols[0])) >= len(cols[0]) - len(marks)
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0]), pa.array(cols[1], mask=null), *map(pa.array, cols[2:])],
                ["doc", "other", "at", "width", "oat", "owidth"])

    def run(batches):
        held = first = None          # rows of the last key; its first row, if some went out
        for batch in batches:
            if not batch.num_rows:
                continue
            c = [batch.column(i).to_numpy() for i in range(4)]
            if held is not None:
                c = [np.concatenate(x) for x in zip(held, c)]
            fresh = np.concatenate(
                [[True], (c[0][1:] != c[0][:-1]) | (c[1][1:] != c[1][:-1])])
            c = [x[fresh] for x in c]
            last = int(np.searchsorted(c[0], c[0][-1]))
            if last:
                yield from close([x[:last] for x in c], first)
                c, first = [x[last:] for x in c], None
            if len(c[0]) > RARE:
                yield from close(c, first)
                first = first or [x[0] for x in c]
                c = [x[-1:] for x in c]
            held = c
        if held is not None:
            yield from close(held, first)
    rows = rows.repartition(partitions(rows.sparkSession), "key").sortWithinPartitions(
        "key", "doc")
    return map_arrow(rows, run,
                     "doc long, other long, at long, width int, oat long, owidth int")


def _places(links: DataFrame) -> list[F.Column]:
    """The ends of links' words, ``lo hi olo ohi``."""
    lo, olo = (F.shiftright(c, STEP_BITS).cast("int") for c in ("at", "oat"))
    return [lo.alias("lo"), (lo + F.col("width")).alias("hi"),
            olo.alias("olo"), (olo + F.col("owidth")).alias("ohi")]


#: Spark's setting that removes an execution's shuffle files at its end.
_FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _kept(df: DataFrame) -> DataFrame:
    """``df`` kept in the shared folder, and the files of the shuffles that led
    to it removed: no later step reads them."""
    conf = df.sparkSession.conf
    before = conf.get(_FREE, None)
    conf.set(_FREE, "true")
    try:
        return cut(df.select("*"))                       # planned under the setting
    finally:
        if before is None:
            conf.unset(_FREE)
        else:
            conf.set(_FREE, before)


def _near(links: DataFrame, min_words: int) -> DataFrame:
    """(doc, other, shift, lo, hi, olo, ohi, from, to): the links of a pair that lie
    at one distance, if two of them, or another distance's near by, are there;
    ``from`` and ``to`` are the bounds of equal words, if they are min_words and
    more, and WINDOW - 1 words on either side: so far an equal run may go on
    without a seed that both texts choose.  Rows without ``other`` pass."""
    pair = Window.partitionBy("doc", "other").orderBy("lo", "olo")

    def close(step) -> F.Column:
        return ((F.abs(step("lo", 1).over(pair) - F.col("lo")) <= NEAR)
                & (F.abs(step("olo", 1).over(pair) - F.col("olo")) <= NEAR))
    step = (1 << STEP_BITS) - 1
    last = F.shiftright("last", STEP_BITS).cast("int")
    end = last + SEED
    # the steps before the last seed lead from the first to it, if none is missing
    equal = ((F.col("steps") - F.col("last").bitwiseAND(step) == last - F.col("lo"))
             & (end - F.col("lo") >= min_words))
    return (links.repartition(partitions(links.sparkSession), "doc", "other")
            .select("doc", "other", "at", *_places(links))
            .groupBy("doc", "other", (F.col("lo") - F.col("olo")).alias("shift"))
            .agg(*_extent(), F.max("at").alias("last"),
                 F.sum(F.col("at").bitwiseAND(step)).alias("steps"), F.count("*").alias("seeds"))
            .withColumn("near", (F.col("seeds") >= 2) | F.coalesce(close(F.lag), F.lit(False))
                        | F.coalesce(close(F.lead), F.lit(False)))
            .where("near or other is null")
            .select("doc", "other", "shift", "lo", "hi", "olo", "ohi",
                    F.when(equal, F.col("lo") - (WINDOW - 1)).alias("from"),
                    F.when(equal, end + (WINDOW - 1)).alias("to")))


_ENDS = ["lo", "hi", "olo", "ohi"]


def _extent() -> list[F.Column]:
    return [F.min("lo").alias("lo"), F.max("hi").alias("hi"),
            F.min("olo").alias("olo"), F.max("ohi").alias("ohi")]


def _of_classes(rows: DataFrame, same: DataFrame) -> DataFrame:
    """``rows`` but those whose words, on either side, equal an earlier
    document's, where the pair with that document is among them too.  ``same``
    holds (at, home, from, to): words of document ``at`` that equal some of
    ``home``.  A row gives way to one of smaller documents only, so of equal
    passages the pair of the earliest documents always stays."""
    key = ["doc", "other", "shift"]
    later = rows.join(same, (F.col("doc") == F.col("at")) & (F.col("home") < F.col("other"))
                      & (F.col("from") <= F.col("lo")) & (F.col("to") >= F.col("hi"))).select(
        *key, F.col("other").alias("x"), F.col("home").alias("y"))
    earlier = rows.join(same, (F.col("other") == F.col("at")) & (F.col("from") <= F.col("olo"))
                        & (F.col("to") >= F.col("ohi"))).select(
        *key, F.col("doc").alias("x"), F.col("home").alias("y"))
    there = rows.select(F.col("doc").alias("x"), F.col("other").alias("y")).distinct()
    gone = later.unionAll(earlier).join(there, ["x", "y"], "left_semi").select(
        *key, *(F.lit(None).cast("int").alias(c) for c in _ENDS))
    return (rows.select(*key, *_ENDS, F.lit(False).alias("gone"))
            .unionAll(gone.withColumn("gone", F.lit(True)))
            .repartition(partitions(rows.sparkSession), "doc", "other")
            .groupBy(*key).agg(*_extent(), F.max("gone").alias("gone")).where("not gone"))


def _key_filter(keys: DataFrame, column: str) -> np.ndarray:
    return id_filter(keys, column, F.pmod(column, F.lit(1 << FILTER_BITS)))


def _pairs(docs: DataFrame, min_words: int
           ) -> tuple[DataFrame, np.ndarray, np.ndarray, DataFrame]:
    """(doc, other, lo, hi, olo, ohi): documents that share two near seeds or a
    run of common seeds, and the words from the first to the last shared; and
    filters of the common seeds and of the others that documents share, and the
    chosen seeds of these."""
    by_seed = _kept(_near(_links(_seeds(docs)), min_words))
    marks = by_seed.where("other is null")
    bits = _key_filter(marks.where("shift = 0"), "doc")
    shared = _key_filter(marks.where("shift = 1"), "doc")
    by_seed = by_seed.where("other is not null")
    chosen = _chosen(docs, bits, shared)
    by_run = _links(_runs(chosen, bits)).where("other is not null")
    by_run = by_run.select("doc", "other", *_places(by_run)).withColumn(
        "shift", F.col("lo") - F.col("olo"))
    key = ["doc", "other", "shift"]
    rows = _kept(by_seed.select(*key, *_ENDS).unionAll(by_run.select(*key, *_ENDS))
                 .groupBy(*key).agg(*_extent()))
    same = by_seed.where(F.col("to").isNotNull()).select(
        F.col("doc").alias("at"), F.col("other").alias("home"), "from", "to")
    # words that equal those of several documents: the earliest stands for them
    wider = same.select(*(F.col(c).alias(f"w_{c}") for c in same.columns))
    same = _kept(same.join(wider, (F.col("at") == F.col("w_at")) & (F.col("w_home") < F.col("home"))
                           & (F.col("w_from") <= F.col("from") + WINDOW - 1)
                           & (F.col("w_to") >= F.col("to") - WINDOW + 1),
                           "left_anti"))
    return _of_classes(rows, same).groupBy("doc", "other").agg(*_extent()), bits, shared, chosen


def _hot(chosen: DataFrame, bits: np.ndarray) -> DataFrame:
    """(key, doc, at, width): the common seeds of each document."""
    def run(batches):
        for batch in batches:
            for doc, pos, seed in _unpacked(batch):
                hot = maybe(bits, (seed & _LOW).astype(np.int64))
                doc, pos, seed = doc[hot], pos[hot], seed[hot]
                if len(doc):
                    yield _once(seed, doc, pos, pos + SEED, 0 * pos)
    return map_arrow(chosen, run, "key long, doc long, at long, width int")


def _twos(chosen: DataFrame, open_: np.ndarray, shared: np.ndarray) -> DataFrame:
    """(key, doc, at, width): seeds of each document LEAST to FAR words apart, one
    of them in the filter ``open_`` and the other in either filter."""
    def run(batches):
        for batch in batches:
            for doc, pos, seed in _unpacked(batch):
                slot = (seed & _LOW).astype(np.int64)
                hot = maybe(open_, slot)
                some = hot | maybe(shared, slot)
                doc, pos, seed, hot = doc[some], pos[some], seed[some], hot[some]
                part = np.cumsum(np.concatenate(
                    [[0], (doc[1:] != doc[:-1]) | (pos[1:] <= pos[:-1])])) if len(doc) else pos
                place = part * (1 << 32) + pos
                # seeds after each of the filter, then those before it that are not of it
                at = np.flatnonzero(hot)
                for lo in range(0, len(at), 1 << 15):
                    i = at[lo:lo + (1 << 15)]
                    a, b = _spread(i, np.searchsorted(place, place[i] + LEAST),
                                   np.searchsorted(place, place[i] + FAR, side="right"))
                    d, c = _spread(i, np.searchsorted(place, place[i] - FAR),
                                   np.searchsorted(place, place[i] - LEAST, side="right"))
                    c, d = c[~hot[c]], d[~hot[c]]
                    a, b = np.concatenate([a, c]), np.concatenate([b, d])
                    if len(a):
                        yield _once(tk.mix(seed[a] ^ tk.mix(seed[b] + _U(1))), doc[a], pos[a],
                                    pos[b] + SEED, 0 * a)
    return map_arrow(chosen, run, "key long, doc long, at long, width int")


def _spread(i: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each i with each of the numbers lo .. hi - 1."""
    n = hi - lo
    j = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    return np.repeat(i, n), j


def _labelled(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """(key, doc, label, lo, hi): the words of ``rows`` and the class of the
    passage around all of them, or else a label of their document's own."""
    lo = F.shiftright("at", STEP_BITS).cast("int")
    rows = (rows.select("key", "doc", lo.alias("lo"), (lo + F.col("width")).alias("hi"))
            .groupBy("doc", "key").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")))
    return rows.join(classes, (F.col("doc") == F.col("doc_id")) & (F.col("start") <= F.col("lo"))
                     & (F.col("end") >= F.col("hi")), "left").select(
        "key", "doc", F.coalesce("component", F.xxhash64(F.lit(1), "doc")).alias("label"),
        "lo", "hi")


def _mixed(rows: DataFrame) -> DataFrame:
    """(key, n): keys whose rows have several labels, and their rows."""
    return (rows.groupBy("key").agg(F.count("*").alias("n"), F.min("label").alias("x"),
                                    F.max("label").alias("y"))
            .where("x <> y").select("key", "n"))


def _across(rows: DataFrame) -> DataFrame:
    """(doc, other, lo, hi, olo, ohi), other < doc: all pairs of a key's documents
    whose labels differ.  A large key's documents are dealt into blocks of about
    BLOCK, and each two blocks are one group."""
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    other = F.explode(F.sequence(F.lit(0), blocks - 1)).alias("o")
    rows = (rows.join(_mixed(rows), "key")
            .withColumn("b", F.pmod(F.xxhash64("doc", F.lit(2)), blocks).cast("int"))
            .select("key", "doc", "label", "lo", "hi", "b", other)
            .select("key", F.least("b", "o").alias("i"), F.greatest("b", "o").alias("j"),
                    "doc", "label", "lo", "hi", "b")
            .repartition(partitions(rows.sparkSession), "key", "i", "j")
            .sortWithinPartitions("key", "i", "j", "doc"))

    def close(c):
        key, bi, bj, doc, label, lo, hi, b = c
        new = np.concatenate([[True], (key[1:] != key[:-1]) | (bi[1:] != bi[:-1])
                              | (bj[1:] != bj[:-1])])
        start = np.flatnonzero(new)
        size = np.diff(np.append(start, len(key)))
        place = np.arange(len(key)) - np.repeat(start, size)
        at = np.arange(len(key))
        for k in range(1, int(size.max())):
            at = at[place[at] >= k]
            x, y = at, at - k
            some = (label[x] != label[y]) & (doc[x] != doc[y]) & ((bi[x] == bj[x]) | (b[x] != b[y]))
            x, y = x[some], y[some]
            if len(x):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v) for v in (doc[x], doc[y], lo[x], hi[x], lo[y], hi[y])],
                    ["doc", "other", "lo", "hi", "olo", "ohi"])

    def run(batches):
        held = None                                      # rows of the last group
        for batch in batches:
            if not batch.num_rows:
                continue
            c = [batch.column(i).to_numpy() for i in range(8)]
            if held is not None:
                c = [np.concatenate(x) for x in zip(held, c)]
            last = (c[0] == c[0][-1]) & (c[1] == c[1][-1]) & (c[2] == c[2][-1])
            n = len(last) - int(last.sum())
            if n:
                yield from close([x[:n] for x in c])
            held = [x[n:] for x in c]
        if held is not None:
            yield from close(held)
    return map_arrow(rows, run, "doc long, other long, lo int, hi int, olo int, ohi int")


def _rest(chosen: DataFrame, bits: np.ndarray, shared: np.ndarray, tried: DataFrame,
          found: DataFrame) -> DataFrame | None:
    """(doc, other, lo, hi, olo, ohi): documents that share two seeds LEAST to
    FAR words apart, one of them common, that the passages ``found`` do not
    connect there and that were not ``tried`` with those words."""
    if not bits.any():
        return None
    places = _placed(found)
    classes = _kept(_nodes(places).join(components(_node_links(found, places)),
                                        F.col("node") == F.col("v"))
                    .select("doc_id", "start", "end", "component"))
    open_ = _key_filter(_mixed(_labelled(_hot(chosen, bits), classes)), "key")
    if not open_.any():
        return None
    rows = _kept(_labelled(_twos(chosen, open_, shared), classes))
    tried = tried.select(*(F.col(c).alias(f"t_{c}") for c in ("doc", "other", *_ENDS)))
    covers = ((F.col("doc") == F.col("t_doc")) & (F.col("other") == F.col("t_other"))
              & (F.col("t_lo") <= F.col("lo")) & (F.col("t_hi") >= F.col("hi"))
              & (F.col("t_olo") <= F.col("olo")) & (F.col("t_ohi") >= F.col("ohi")))
    return _kept(_across(rows).groupBy("doc", "other").agg(*_extent())
                 .join(tried, covers, "left_anti"))


class _Fenwick:
    """Range maxima over places, with matches that enter and leave again: node i
    holds the best of the places i - lowbit(i) + 1 .. i."""

    def __init__(self, size: int):
        self.size = size
        self.none = (-np.inf, -1)
        self.tree = [self.none] * (size + 1)
        self.here: list[dict[int, float]] = [{} for _ in range(size)]   # live matches of a place
        self.top = [self.none] * size

    def _best_of(self, place: int) -> tuple[float, int]:
        # of equal values the match that entered first
        here = self.here[place]
        if not here:
            return -np.inf, 1
        value = max(here.values())
        return value, -next(m for m, v in here.items() if v == value)

    def enter(self, place: int, value: float, match: int) -> None:
        self.here[place][match] = value
        if value > self.top[place][0]:
            tree, best = self.tree, (value, match)
            self.top[place] = best
            i = place + 1
            while i <= self.size:
                if best > tree[i]:
                    tree[i] = best
                i += i & -i

    def leave(self, place: int, match: int) -> None:
        del self.here[place][match]
        if self.top[place][1] != match:
            return
        value, other = self._best_of(place)
        self.top[place] = (value, -other)
        i, tree, top = place + 1, self.tree, self.top
        while i <= self.size:                            # rebuild the nodes above it
            best, step, low = top[i - 1], 1, i & -i
            while step < low:
                node = tree[i - step]
                if node > best:
                    best = node
                step *= 2
            tree[i] = best
            i += low

    def best(self, lo: int, hi: int) -> tuple[float, int]:
        """(value, match) of the best live match at the places lo .. hi - 1."""
        tree, top, best = self.tree, self.top, self.none
        while hi > lo:
            below = hi & (hi - 1)
            if below >= lo:                              # a whole node
                node = tree[hi]
                hi = below
            else:
                hi -= 1
                node = top[hi]
            if node > best:
                best = node
        return best


def chains(p: np.ndarray, q: np.ndarray, least: int = 1) -> Iterator[np.ndarray]:
    """Chains (index arrays) of ``least`` and more matches sorted by (p, q),
    best first; each match is in one chain at most."""
    n = len(p)
    score, back = np.zeros(n), np.full(n, -1)
    if (np.diff(p) > 0).all() and (np.diff(q) > 0).all():
        # all in order: costs add up, so every match is worth taking
        cost = GAP * (np.diff(p) + np.diff(q))
        far = (np.diff(p) > MAX_GAP) | (np.diff(q) > MAX_GAP)
        if not far.any() and (cost < SEED).all():        # each adds to the score
            if n >= least:
                yield np.arange(n)
            return
        s = score[0] = SEED
        for j, (c, f) in enumerate(zip(cost.tolist(), far.tolist()), 1):
            if f or s <= c:
                s = SEED
            else:
                s += SEED - c
                back[j] = j - 1
            score[j] = s
    else:
        # the best of the matches before it in both, and near enough in both: a
        # tree over q holds those whose p lies in the window
        places, rank = np.unique(q, return_inverse=True)
        low = np.searchsorted(places, q - MAX_GAP).tolist()
        first = np.searchsorted(p, p - MAX_GAP).tolist()
        before = np.searchsorted(p, p).tolist()
        tree = _Fenwick(len(places))
        cost, rank = (GAP * (p + q)).tolist(), rank.tolist()
        value, scores, links = [0.0] * n, [float(SEED)] * n, [-1] * n
        entered = left = 0
        for j in range(n):
            while entered < before[j]:
                tree.enter(rank[entered], value[entered], entered)
                entered += 1
            while left < first[j]:
                tree.leave(rank[left], left)
                left += 1
            best, i = tree.best(low[j], rank[j])
            if i >= 0 and best - cost[j] > 0:
                scores[j] += best - cost[j]
                links[j] = i
            value[j] = scores[j] + cost[j]
        score, back = np.array(scores), np.array(links)
    used, back = [False] * n, back.tolist()
    for j in np.argsort(-score, kind="stable").tolist():
        path = []
        while j >= 0 and not used[j]:
            used[j] = True
            path.append(j)
            j = back[j]
        if len(path) >= least:
            yield np.array(path[::-1])


def _company(row: np.ndarray, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Which matches have another one of their row in their cell of MAX_GAP + 1
    words a side or the eight around it: the others can be in no chain."""
    side = MAX_GAP + 1
    cell = (row.astype(np.int64) << 44) + ((p // side + 1) << 22) + q // side + 1
    cells, at, count = np.unique(cell, return_inverse=True, return_counts=True)
    near = np.zeros(len(cells), dtype=np.int64)
    for dp in (-1, 0, 1):
        for dq in (-1, 0, 1):
            want = cells + (dp << 22) + dq
            i = np.minimum(np.searchsorted(cells, want), len(cells) - 1)
            near += np.where(cells[i] == want, count[i], 0)
    return near[at] >= 2


def _cuts(row: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Bounds of the groups of matches: no gap in p of more than MAX_GAP."""
    new = np.flatnonzero((row[1:] != row[:-1]) | (p[1:] - p[:-1] > MAX_GAP)) + 1
    return np.concatenate([[0], new, [len(row)]])


def _grouped(row: np.ndarray, p: np.ndarray, q: np.ndarray, hopeful=None) -> tuple:
    """(row, p, q, lo, hi): matches, and the bounds of the groups that may chain:
    no gap in p of more than MAX_GAP, MIN_SEEDS and more, and ``hopeful`` of them,
    if given."""
    if len(row):
        kept = _company(row, p, q)
        row, p, q = row[kept], p[kept], q[kept]
    cuts = _cuts(row, p) if len(row) else np.zeros(1, dtype=np.int64)
    some = np.flatnonzero(np.diff(cuts) >= MIN_SEEDS)
    if hopeful is not None and len(some):
        some = some[hopeful(row, p, q, cuts[some], cuts[some + 1])]
    return row, p, q, cuts[some], cuts[some + 1]


def _groups(row: np.ndarray, p: np.ndarray, q: np.ndarray, hopeful=None) -> Iterator[tuple]:
    """(row, p, q) of each group of matches that may chain."""
    row, p, q, lo, hi = _grouped(row, p, q, hopeful)
    for a, b in zip(lo.tolist(), hi.tolist()):
        yield int(row[a]), p[a:b], q[a:b]


def _linked(p: np.ndarray, q: np.ndarray, lo: np.ndarray, hi: np.ndarray
            ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(group, match, score, back, depth): as in ``chains`` for matches out of order,
    for all groups at once, a word p of each in one step.  Back is a place among
    ``match``, or -1.  The matches of a group stand from the last to the first, so that
    those before one, the latest first, are the next after it and others of its p."""
    size = hi - lo
    group, match = _spread(np.arange(len(lo)), lo, hi)
    finish = np.cumsum(size)[group]
    match = (lo + hi - 1)[group] - match
    n, at = len(match), np.arange(len(match))
    x, y, cost = p[match], q[match].astype(np.int32), GAP * (p[match] + q[match])
    new = np.flatnonzero(np.concatenate(
        [[True], (group[1:] != group[:-1]) | (x[1:] != x[:-1])]))
    count = np.diff(np.append(new, n))
    after = np.repeat(new + count, count)                # the first of the words p before
    place = (group << 40) - x
    end = np.searchsorted(place, place + MAX_GAP, side="right")      # of the window
    # steps: the words p of each group, from the first on
    words = np.bincount(group[new], minlength=len(lo))
    step = np.cumsum(words)[group] - 1 - np.repeat(np.arange(len(new)), count)
    order = np.argsort(step, kind="stable")
    steps = np.split(order, np.cumsum(np.bincount(step))[:-1])
    # the match before at the same place, or none
    there = (group << 40) + q[match]
    by = np.argsort(there, kind="stable")
    follows = np.flatnonzero(np.diff(there[by]) == 0)
    before = np.full(n, 2 * n)
    before[by[follows]] = by[follows + 1]

    pad = int((end - after).max()) + NEXT + 1
    y = np.concatenate([y, np.zeros(pad, dtype=y.dtype)])
    # the most of the values so far, and of those before at the same place; what hides
    # a match: the one of its value before at its place
    value, top, high = np.full((3, n + pad), -np.inf)
    hidden = np.full(n + pad, 4 * n, dtype=np.int32)
    score, back, depth = np.full(n, float(SEED)), np.full(n, -1), np.zeros(n, dtype=np.int64)

    def windows(k):
        return [np.ndarray((len(c) - k + 1, k), c.dtype, c, 0, 2 * c.strides)
                for c in (value, y, hidden)]

    def best_of(m, values, places, hidden):
        """The best match before each of m, or the first of the window, and its value."""
        here, stop = y[m, None], end[m, None].astype(np.int32)
        live = (here - places - 1).view(np.uint32) < MAX_GAP
        live &= np.arange(values.shape[1]) < stop - after[m, None]
        # of equal values at one place the earliest, of places the latest match
        live &= hidden >= stop
        values = np.where(live, values, -np.inf)
        best = values.argmax(axis=1)
        return after[m] + best, values[np.arange(len(m)), best]
    near = windows(NEXT)
    for m in steps:
        first = after[m]
        last, places, hides = (c[first] for c in near)
        i, best = best_of(m, last, places, hides)
        wide = end[m] - first
        more = np.flatnonzero((wide > NEXT) & (top[np.minimum(first + NEXT, n)] >= best))
        if len(more):                                    # there may be as good a match before them
            i[more], best[more] = best_of(m[more], *(
                c[first[more]] for c in windows(int(wide[more].max()))))
        gain = best - cost[m]
        some = np.flatnonzero(gain > 0)
        linked, i = m[some], i[some]
        score[linked] += gain[some]
        back[linked] = i
        depth[linked] = depth[i] + 1
        now = score[m] + cost[m]
        value[m] = now
        starts = np.flatnonzero(np.append(True, first[1:] != first[:-1]))
        most = np.maximum.reduceat(now, starts)
        i = first[starts]
        most = np.where(i < finish[m[starts]], np.maximum(most, top[np.minimum(i, n)]), most)
        top[m] = np.repeat(most, np.diff(np.append(starts, len(m))))
        some = np.flatnonzero(before[m] < n)
        i = before[m[some]]
        high[m[some]] = np.maximum(value[i], high[i])
        some = some[(i < end[m[some]]) & (high[m[some]] >= now[some])]
        if len(some):
            i = before[m[some]]
            same = value[i] == now[some]
            hidden[m[some[same]]] = i[same]
            some = some[~same]
        if len(some):
            last, places, _ = (c[first[some]] for c in windows(int(wide[some].max())))
            same = (last == now[some, None]) & (places == y[m[some], None])
            i = same.argmax(axis=1)
            got = same[np.arange(len(some)), i]
            hidden[m[some[got]]] = first[some[got]] + i[got]
    return group, match, score, back, depth


def _parted(group: np.ndarray, match: np.ndarray, score: np.ndarray, back: np.ndarray,
            depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which matches are in chains of MIN_SEEDS and more, and these chains, numbered
    best first by group.  A match is in the chain of the best that leads to it."""
    order = np.lexsort((match, -score, group))
    owner = np.empty(len(score), dtype=np.int64)
    owner[order] = np.arange(len(score))
    levels = np.argsort(-depth, kind="stable")
    for at in np.split(levels, np.flatnonzero(np.diff(depth[levels])) + 1):
        at = at[back[at] >= 0]
        np.minimum.at(owner, back[at], owner[at])
    some = np.flatnonzero(np.bincount(owner)[owner] >= MIN_SEEDS)
    return some, owner[some]


def _paths(p: np.ndarray, q: np.ndarray, lo: np.ndarray, hi: np.ndarray
           ) -> tuple[np.ndarray, np.ndarray]:
    """(match, first): the matches of all groups' chains of MIN_SEEDS and more, by
    group and best first, and where each chain begins among them."""
    size = hi - lo
    whole = together = np.zeros(len(lo), dtype=bool)
    if len(lo) >= MANY:
        dp, dq = np.diff(p, append=0), np.diff(q, append=0)

        def throughout(some):
            some = np.concatenate([[0], np.cumsum(some)])
            return some[hi - 1] - some[lo] == size - 1
        ordered = throughout((dp > 0) & (dq > 0))
        whole = ordered & throughout((dp <= MAX_GAP) & (dq <= MAX_GAP) & (GAP * (dp + dq) < SEED))
        # but few that would take most of the steps alone
        words = np.concatenate([[0], np.cumsum(dp != 0)])
        words = words[hi - 1] - words[lo]
        if (~ordered).sum() >= ALONE:
            together = ~ordered & (words <= 2 * np.sort(words[~ordered])[-ALONE])
    group, match = _spread(np.flatnonzero(whole), lo[whole], hi[whole])
    out = [(match, 0 * match, group)]                    # match, chain in its group, group
    for g in np.flatnonzero(~whole & ~together).tolist():
        for k, path in enumerate(chains(p[lo[g]:hi[g]], q[lo[g]:hi[g]], MIN_SEEDS)):
            out.append((lo[g] + path, np.full(len(path), k), np.full(len(path), g)))
    if together.any():
        at = np.flatnonzero(together)
        group, match, *links = _linked(p, q, lo[at], hi[at])
        i, chain = _parted(group, match, *links)
        out.append((match[i], chain, at[group[i]]))
    match, chain, group = (np.concatenate(c) for c in zip(*out))
    order = np.lexsort((match, chain, group))
    match, chain, group = match[order], chain[order], group[order]
    return match, np.flatnonzero(np.concatenate(
        [[True], (chain[1:] != chain[:-1]) | (group[1:] != group[:-1])]))[:len(match)]


def _in_common(a: np.ndarray, lo: np.ndarray, hi: np.ndarray,
               b: np.ndarray, olo: np.ndarray, ohi: np.ndarray) -> np.ndarray:
    """For each i, how many words of a[lo:hi] and b[olo:ohi] are the same, in any
    order: no alignment of them matches more."""
    def counted(words, lo, hi):
        group, at = _spread(np.arange(len(lo)), lo, hi)
        return np.unique((group.astype(_U) << _U(32)) + words.view(np.uint32)[at].astype(_U),
                         return_counts=True)
    x, m = counted(a, lo, hi)
    y, n = counted(b, olo, ohi)
    if not len(y):
        return np.zeros(len(lo), dtype=np.int64)
    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
    same = np.where(y[at] == x, np.minimum(m, n[at]), 0)
    return np.bincount((x >> _U(32)).astype(np.int64), same, len(lo)).astype(np.int64)


def _hopes(a: np.ndarray, ca: np.ndarray, b: np.ndarray, cb: np.ndarray,
           min_words: int, min_identity: float) -> np.ndarray:
    """The rows whose words may hold a passage: on either side a stretch in which
    min_words and more, and min_identity of them, stand somewhere on the other."""
    def slots(words, cuts):
        row = np.repeat(np.arange(len(cuts) - 1), np.diff(cuts))
        with np.errstate(over="ignore"):
            key = (words.view(np.uint32) + (row.astype(_U) << _U(32))) * _U(0x9E3779B97F4A7C15)
        return row, (key >> _U(64 - SLOT_BITS)).astype(np.int64)

    def stretches(row, slot, by, cuts):
        seen = np.zeros(1 << SLOT_BITS, dtype=bool)
        seen[by] = True
        at = np.flatnonzero(seen[slot])
        if len(at) < min_words:
            return np.empty(0, dtype=np.int64)
        row = row[at]
        # from word k to word l of them are l - k + 1 in at[l] - at[k] + 1 words; what
        # is left of the row before is too high to be the least
        left = np.arange(len(at)) - min_identity * at
        high = left - row * (2.0 * len(slot) + 1)
        least = np.minimum.accumulate(high)[:len(at) - min_words + 1]
        return np.unique(row[min_words - 1:][high[min_words - 1:] - least >= min_identity - 1.001])
    row, slot = slots(a, ca)
    other, by = slots(b, cb)
    some = np.zeros(len(ca) - 1, dtype=bool)
    some[stretches(row, slot, by, ca)] = True
    kept = some[other]
    return stretches(other[kept], by[kept], slot, cb)


def _rows(words: np.ndarray, cuts: np.ndarray, kept: np.ndarray):
    """The words of the rows ``kept``, and their bounds."""
    _, at = _spread(kept, cuts[kept], cuts[kept + 1])
    return words[at], np.concatenate([[0], np.cumsum(cuts[kept + 1] - cuts[kept])])


def _reaches(a: np.ndarray, i: np.ndarray, b: np.ndarray, j: np.ndarray, n: np.ndarray,
             step: int) -> tuple[np.ndarray, np.ndarray]:
    """``_reach`` of many: from a[i] and b[j] on by ``step``, n words at most."""
    k = np.arange(REACH)
    there = k < n[:, None]
    x, y = (np.where(there, at[:, None] + step * k, 0) for at in (i, j))
    same = there & (a[x] == b[y])
    score = np.cumsum(np.where(same, 1, -2), axis=1)
    row = np.arange(len(i))
    best = score.argmax(axis=1)
    some = score[row, best] > 0
    return (np.where(some, best + 1, 0),
            np.where(some, np.cumsum(same, axis=1)[row, best], 0))


def _matches(a: np.ndarray, ca: np.ndarray, b: np.ndarray, cb: np.ndarray,
             min_words: int, min_identity: float) -> tuple:
    """(rows, a, ca, b, cb, row, p, q): the matches of the groups that may hold a
    passage, and the words of the rows that have some.  What cannot have enough
    matched words, or not the identity, is not among them: first whole rows by the
    words in common, then groups of matches."""
    def hopeful(row, p, q, lo, hi):
        r, bounds = row[lo], np.column_stack([lo, hi]).ravel()
        q = np.append(q, 0)                              # a bound may be the length
        q_lo, q_hi = (f.reduceat(q, bounds)[::2] for f in (np.minimum, np.maximum))
        return _in_common(
            a, ca[r] + np.maximum(p[lo] - REACH, 0),
            np.minimum(ca[r] + p[hi - 1] + SEED + REACH, ca[r + 1]),
            b, cb[r] + np.maximum(q_lo - REACH, 0),
            np.minimum(cb[r] + q_hi + SEED + REACH, cb[r + 1])) >= min_words
    rows = np.arange(len(ca) - 1)

    def left(kept):
        nonlocal rows, a, ca, b, cb
        if len(kept) < len(rows):
            rows, (a, ca), (b, cb) = rows[kept], _rows(a, ca, kept), _rows(b, cb, kept)
    if len(rows) >= MANY:
        left(_hopes(a, ca, b, cb, min_words, min_identity))
    left(np.flatnonzero(_in_common(a, ca[:-1], ca[1:], b, cb[:-1], cb[1:]) >= min_words))
    if not len(rows):
        none = np.empty(0, dtype=np.int64)
        return rows, a, ca, b, cb, none, none, none
    row, p, q, lo, hi = _grouped(*_shared(a, ca, b, cb), hopeful)
    _, at = _spread(lo, lo, hi)
    kept, row = np.unique(row[at], return_inverse=True)
    left(kept)
    return rows, a, ca, b, cb, row, p[at], q[at]


def _joined(parts: list[tuple]) -> tuple:
    """Several results of ``_matches``, the rows numbered through."""
    rows, a, ca, b, cb, row, p, q = zip(*parts)
    before = np.cumsum([0, *map(len, rows)])

    def bounds(cuts):
        size = np.concatenate([np.diff(c) for c in cuts])
        return np.concatenate([[0], np.cumsum(size)])
    return (np.concatenate(rows), np.concatenate(a), bounds(ca), np.concatenate(b), bounds(cb),
            np.concatenate([r + n for r, n in zip(row, before)]),
            np.concatenate(p), np.concatenate(q))


def _chained(rows, a, ca, b, cb, row, p, q, min_words: int, min_identity: float) -> list[tuple]:
    """(row, start, end, other_start, other_end, matched, identity): the passages of
    what ``_matches`` gives.  Chains that cannot have enough matched words, or not the
    identity, are not aligned."""
    if not len(row):
        return []
    cuts = _cuts(row, p)
    match, first = _paths(p, q, cuts[:-1], cuts[1:])
    if not len(match):
        return []
    # the most that each chain can match: all words of its gaps' shorter sides
    p, q, r = p[match], q[match], row[match[first]]
    last = np.append(first[1:], len(match)) - 1
    step = np.minimum(np.diff(p, append=0), np.diff(q, append=0))
    step[last] = 0
    most = SEED + np.add.reduceat(step, first)
    p0, q0, p1, q1 = p[first], q[first], p[last] + SEED, q[last] + SEED
    left, before = _reaches(a, ca[r] + p0 - 1, b, cb[r] + q0 - 1, np.minimum(p0, q0), -1)
    right, after = _reaches(a, ca[r] + p1, b, cb[r] + q1,
                            np.minimum(ca[r + 1] - ca[r] - p1, cb[r + 1] - cb[r] - q1), 1)
    most += before + after
    longer = np.maximum(p1 - p0, q1 - q0) + left + right
    some = np.flatnonzero((most >= min_words) & (most / longer >= min_identity))
    # of those the words of the gaps are aligned
    chain, at = _spread(some, first[some], last[some])
    gap = step[at] > SEED
    chain, at = chain[gap], at[gap]
    words = _all_common(a, ca[r[chain]] + p[at] + SEED, p[at + 1] - p[at] - SEED,
                        b, cb[r[chain]] + q[at] + SEED, q[at + 1] - q[at] - SEED)
    matched = (SEED + np.add.reduceat(np.minimum(step, SEED), first) + before + after
               + np.bincount(chain, words, len(first)).astype(np.int64))
    some = some[(matched[some] >= min_words) & (matched[some] / longer[some] >= min_identity)]
    return [(*place, matched, matched / longer) for *place, matched, longer in zip(*(
        c[some].tolist() for c in (rows[r], p0 - left, p1 + right, q0 - left, q1 + right,
                                   matched, longer)))]


def _passages(a: np.ndarray, ca: np.ndarray, b: np.ndarray, cb: np.ndarray,
              min_words: int, min_identity: float) -> list[tuple]:
    """(row, start, end, other_start, other_end, matched, identity): passages of
    a[ca[row]:ca[row + 1]] and b[cb[row]:cb[row + 1]]."""
    return _chained(*_matches(a, ca, b, cb, min_words, min_identity), min_words, min_identity)


def _shared(a: np.ndarray, ca: np.ndarray, b: np.ndarray, cb: np.ndarray):
    """(row, p, q), sorted: equal runs of SEED words of a[ca[row]:ca[row + 1]]
    and b[cb[row]:cb[row + 1]].  Of matches that follow each other word by word
    every SEED-th and the last are kept."""
    def keyed(words, cuts):
        row = np.repeat(np.arange(len(cuts) - 1), np.diff(cuts))
        place = np.arange(len(words)) - cuts[row]
        whole = np.flatnonzero(place <= np.diff(cuts)[row] - SEED)
        key = tk.windows(words.view(np.uint32).astype(_U), SEED)[whole]
        return tk.mix(key ^ tk.mix(row[whole].astype(_U))), row[whole], place[whole]
    def met(of, by):
        """Which keys ``of`` may be among ``by``; none that is gets lost."""
        low = _U(16 * COMPARED - 1)
        seen = np.zeros(16 * COMPARED, dtype=bool)
        seen[by & low] = True
        return seen[of & low]
    x, row, p = keyed(a, ca)
    y, _, q = keyed(b, cb)
    some = met(x, y)
    x, row, p = x[some], row[some], p[some]
    some = met(y, x)
    y, q = y[some], q[some]
    order = np.argsort(y, kind="stable")
    y, q = y[order], q[order]
    if not len(y):
        x = x[:0]
    left = np.searchsorted(y, x)
    size = np.diff(np.append(np.flatnonzero(np.append(True, y[1:] != y[:-1])), len(y)))
    size = np.repeat(size, size)                         # rows of a key
    there = np.minimum(left, len(y) - 1)
    count = np.where(y[there] == x, size[there], 0) if len(x) else left
    some = np.flatnonzero(count)
    x, row, p, left, count = (c[some] for c in (x, row, p, left, count))
    take = np.minimum(count, PLACES)
    if (count > PLACES).any():
        order = np.argsort(x, kind="stable")
        new = np.concatenate([[True], x[order][1:] != x[order][:-1]])
        rank = np.empty(len(x), dtype=np.int64)
        rank[order] = np.arange(len(x)) - np.maximum.accumulate(
            np.where(new, np.arange(len(x)), 0))
        left = left + np.clip(rank - PLACES // 2, 0, count - take)
    i = np.repeat(np.arange(len(x)), take)
    row, p = row[i], p[i]
    q = q[left[i] + np.arange(len(i)) - np.repeat(np.cumsum(take) - take, take)]
    order = np.lexsort((p, q - p, row))
    row, p, q = row[order], p[order], q[order]
    if len(row):
        new = np.concatenate([[True], (row[1:] != row[:-1]) | (p[1:] != p[:-1] + 1)
                              | (q[1:] != q[:-1] + 1)])
        at = np.arange(len(row))
        step = at - np.maximum.accumulate(np.where(new, at, 0))
        kept = (step % SEED == 0) | np.append(new[1:], True)
        row, p, q = row[kept], p[kept], q[kept]
        order = np.lexsort((q, p, row))
        row, p, q = row[order], p[order], q[order]
    return row, p, q


def _words(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(doc_id, words): 32-bit hashes of the words of the wanted documents."""
    bits = id_filter(wanted, "doc_id")

    def run(batches):
        for batch in batches:
            batch = batch.filter(pa.array(maybe(bits, batch.column("slot").to_numpy())))
            if batch.num_rows:
                for texts in tk.texts_of(batch.column("text")):
                    s, e, cuts = texts.words()
                    h = (texts.hashes(s, e, tk.LOWER_VALUES) >> _U(32)).astype(np.uint32)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("doc_id").slice(texts.first, len(texts)),
                         pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)),
                                                  pa.array(h.view(np.int32)))],
                        ["doc_id", "words"])
    return map_arrow(docs.select("doc_id", "text", slot_of("doc_id")), run,
                     "doc_id long, words array<int>").join(wanted, "doc_id", "left_semi")


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence of two short gaps, a row of the
    table as the bits of one number: they are 0 where it rises."""
    if not len(a) or not len(b):
        return 0
    if len(a) == len(b) and (a == b).all():
        return len(a)
    places: dict[int, int] = {}
    for j, y in enumerate(b.tolist()):
        places[y] = places.get(y, 0) | 1 << j
    row = whole = (1 << len(b)) - 1
    for x in a.tolist():
        if same := row & places.get(x, 0):
            row = (row + same | row - same) & whole
    return len(b) - row.bit_count()


def _all_common(a: np.ndarray, i: np.ndarray, m: np.ndarray,
                b: np.ndarray, j: np.ndarray, n: np.ndarray) -> np.ndarray:
    """``_common`` of a[i:i + m] and b[j:j + n] for each of many gaps, none of them of
    more than 63 words: the same rows of bits, in one word of 64."""
    out = np.zeros(len(i), dtype=np.int64)
    order = np.argsort(-m, kind="stable")
    for lo in range(0, len(order), 1 << 14):
        at = order[lo:lo + (1 << 14)]
        x, u, y, v = i[at], m[at], j[at], n[at]
        there = np.arange(int(v.max())) < v[:, None]
        words = b[np.where(there, y[:, None] + np.arange(there.shape[1]), 0)]
        whole = (_U(1) << v.astype(_U)) - _U(1)
        row = whole.copy()
        same = np.zeros((len(at), 64), dtype=bool)
        active = np.searchsorted(-u, -np.arange(int(u[0]))).tolist()
        for k, g in enumerate(active):
            same[:g, :there.shape[1]] = (words[:g] == a[x[:g] + k, None]) & there[:g]
            bits = np.packbits(same[:g], axis=1, bitorder="little").view("<u8")[:, 0] & row[:g]
            row[:g] = ((row[:g] + bits) | (row[:g] - bits)) & whole[:g]
        out[at] = v - np.bitwise_count(row)
    return out


def _reach(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """(words, matches) of the best ungapped run from the start of a and b."""
    n = min(len(a), len(b))
    if not n:
        return 0, 0
    same = a[:n] == b[:n]
    score = np.cumsum(np.where(same, 1, -2))
    best = int(score.argmax())
    return (best + 1, int(same[:best + 1].sum())) if score[best] > 0 else (0, 0)


def align(a: np.ndarray, b: np.ndarray, ps: np.ndarray, qs: np.ndarray):
    """(a_start, a_end, b_start, b_end, matched) of a chain over two word
    sequences; ps, qs are its matches' positions in them."""
    left = _reach(a[:ps[0]][::-1][:REACH], b[:qs[0]][::-1][:REACH])
    right = _reach(a[ps[-1] + SEED:][:REACH], b[qs[-1] + SEED:][:REACH])
    step = np.minimum(np.diff(ps), np.diff(qs))
    matched = left[1] + right[1] + SEED + int(np.minimum(step, SEED).sum())
    for i in (np.flatnonzero(step > SEED) + 1).tolist():
        matched += _common(a[ps[i - 1] + SEED:ps[i]], b[qs[i - 1] + SEED:qs[i]])
    return (ps[0] - left[0], ps[-1] + SEED + right[0], qs[0] - left[0],
            qs[-1] + SEED + right[0], matched)


def repeated_passages(docs: DataFrame, min_words: int = MIN_WORDS,
                      min_identity: float = MIN_IDENTITY) -> DataFrame:
    """(doc_id, other_id, start, end, other_start, other_end, matched, identity):
    passages of ``doc_id`` that an earlier document (smaller id) also has.

    Positions count words (end exclusive) of the text with A-Z lower-cased.
    ``matched`` counts aligned equal words, ``identity`` is their share of the
    longer side.  Words that equal an earlier document's are its class: they are
    reported against the earliest such document only, and other texts' passages
    against that one, not against each copy.  A changed passage is reported
    against all earlier classes that have its seeds, if they are few (RARE), else
    against the first ones and the ones before of its seeds and their runs, and
    against all that are in no class with it by then.  Null and empty texts
    and texts without repeats give no rows; neither do repeats within a text
    or repeated rows of one id.  Rows with a null id are left out.  An empty
    table gives no rows; other columns than ``doc_id`` and ``text`` are not read.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text")).where("doc_id is not null")
    tried, bits, shared, chosen = _pairs(docs, min_words)
    tried = _kept(tried)
    found = _kept(_compared(docs, tried, min_words, min_identity))
    rest = _rest(chosen, bits, shared, tried, found)
    if rest is None:
        return found
    return found.unionAll(_compared(docs, rest, min_words, min_identity, spread=True))


def _compared(docs: DataFrame, found: DataFrame, min_words: int,
              min_identity: float, spread: bool = False) -> DataFrame:
    """The passages that the pairs ``found`` share around their words; few pairs
    that take long are to be ``spread`` over all tasks, whatever their bytes."""
    wanted = _kept(found.select(F.explode(F.array("doc", "other")).alias("doc_id")).distinct())
    words = _words(docs, wanted)

    def part(low: str, high: str) -> F.Column:
        return F.slice("words", F.col(low) + 1, F.col(high) + MARGIN - F.col(low))
    for low in ("lo", "olo"):
        found = found.withColumn(low, F.greatest(F.lit(0), F.col(low) - MARGIN))
    pairs = (found.join(words.withColumnRenamed("doc_id", "other"), "other")
             .select("doc", "other", "lo", "hi", "olo", part("olo", "ohi").alias("b"))
             .join(words.withColumnRenamed("doc_id", "doc"), "doc")
             .select("doc", "other", "lo", "olo", part("lo", "hi").alias("a"), "b"))
    if spread:
        pairs = pairs.repartition(partitions(pairs.sparkSession), "doc", "other")

    def run(batches):
        for batch in batches:
            doc, other, lo, olo = (batch.column(i).to_numpy() for i in range(4))
            (a, ca), (b, cb) = ((c.flatten().to_numpy(), np.concatenate(
                [[0], np.cumsum(pa.compute.list_value_length(c).to_numpy())]).astype(np.int64))
                for c in (batch.column(4), batch.column(5)))
            out, parts, size, i, n = [], [], 0, 0, batch.num_rows
            while i < n:
                k = int(np.searchsorted(ca + cb, ca[i] + cb[i] + COMPARED, side="right")) - 1
                k = min(n, max(i + 1, k))
                rows, *part = _matches(a[ca[i]:ca[k]], ca[i:k + 1] - ca[i], b[cb[i]:cb[k]],
                                       cb[i:k + 1] - cb[i], min_words, min_identity)
                if len(rows):
                    parts.append((rows + i, *part))
                    size += len(part[-1])
                i = k
                if parts and (size >= COLLECTED or i == n):
                    for r, s, e, t, u, *rest in _chained(*_joined(parts), min_words, min_identity):
                        out.append((int(doc[r]), int(other[r]), s + int(lo[r]), e + int(lo[r]),
                                    t + int(olo[r]), u + int(olo[r]), *rest))
                    parts, size = [], 0
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in zip(*out)],
                    ["doc_id", "other_id", "start", "end", "other_start", "other_end",
                     "matched", "identity"])
    return map_arrow(pairs, run, "doc_id long, other_id long, start long, end long, "
                                 "other_start long, other_end long, matched long, identity double")


_SIDES = (["doc_id", "start", "end"], ["other_id", "other_start", "other_end"])


def _placed(found: DataFrame) -> DataFrame:
    """(doc_id, start, end, .., node): the places of ``found`` and the passage
    that overlapping ones are."""
    places = found.select(*_SIDES[0]).unionAll(found.select(*_SIDES[1])).distinct()
    order = Window.partitionBy("doc_id").orderBy("start", "end")
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    return _kept(places.withColumn("fresh", (F.col("start") >= F.coalesce(before, "start"))
                                   .cast("int"))
                 .withColumn("passage", F.sum("fresh").over(order))
                 .withColumn("node", F.xxhash64("doc_id", "passage")))


def _nodes(places: DataFrame) -> DataFrame:
    return places.groupBy("node", "doc_id").agg(F.min("start").alias("start"),
                                                F.max("end").alias("end"))


def _node_links(found: DataFrame, places: DataFrame) -> DataFrame:
    """(a, b, identity): linked passages and their best identity."""
    def node(columns, name) -> DataFrame:
        return places.select(*(F.col(p).alias(c) for p, c in zip(_SIDES[0], columns)),
                             F.col("node").alias(name))
    return _kept(found.join(node(_SIDES[0], "a"), _SIDES[0]).join(node(_SIDES[1], "b"), _SIDES[1])
                 .groupBy("a", "b").agg(F.max("identity").alias("identity")))


def passage_classes(found: DataFrame) -> DataFrame:
    """(doc_id, start, end, class_id, n_links, best_identity): one row for each
    passage of a document that another document has too.

    ``found`` are rows of ``repeated_passages``.  Places of a document that
    overlap are one passage, words ``start`` to ``end``.  ``n_links`` counts the
    passages linked with it directly (equal ones only through the earliest of
    their class), ``class_id`` is the smallest document reachable by links and
    ``best_identity`` that of its best link.  No links give no rows.  Nodes of
    the links are 64-bit hashes of document and passage number.
    """
    found = _kept(found)
    places = _placed(found)
    nodes, links = _nodes(places), _node_links(found, places)
    degree = (links.unionAll(links.select("b", "a", "identity")).groupBy("a")
              .agg(F.count("*").alias("n_links"), F.max("identity").alias("best_identity")))
    member = nodes.join(components(links), F.col("node") == F.col("v"))
    least = member.groupBy("component").agg(F.min("doc_id").alias("class_id"))
    return (member.join(least, "component").join(degree, F.col("node") == F.col("a"))
            .select("doc_id", "start", "end", "class_id", "n_links", "best_identity"))
