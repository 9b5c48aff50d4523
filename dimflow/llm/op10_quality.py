"""Operator 10: quality rules with a line-labelling conditional random field.

Every line of a text is described by indicator features; a linear-chain CRF
with the states boilerplate (0) and content (1) scores line sequences, Viterbi
decoding gives the best one, and the share of words on content lines decides
whether the document stays.  The CRF is trained here by maximum likelihood
(forward-backward gradients, L2 penalty) on a bounded sample of labelled
documents.  Labels are given to documents, states belong to lines: a line starts
as content or boilerplate by the documents in which lines of its kind occur (a
naive Bayes score of its features and its document's label), and the chain is
then trained in a few rounds, each on the states that the last one decoded with
the document's label as a prior.  Count rules reject very short and very repetitive documents
first; they and the decoding read whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimflow.llm import textkit as tk
from dimflow.llm.common import map_arrow

#: Bounds of the training sample: labelled documents, and lines of each, taken in
#: blocks of neighbouring lines spread over the whole text.
SAMPLE_DOCS = 3000
SAMPLE_LINES = 200
SAMPLE_BLOCKS = 4
#: Log-odds that a document's label gives each of its lines, and training rounds.
PRIOR = 1.0
ROUNDS = 3
MIN_SHARE = 0.5

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_CONT = np.zeros(256, dtype=bool)
_CONT[0x80:0xC0] = True
_UPPER = np.zeros(256, dtype=bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[48:58] = True
_STOP = np.zeros(256, dtype=bool)
_STOP[list(b".!?:;")] = True
_BANG = np.zeros(256, dtype=bool)
_BANG[list(b"!?")] = True

#: Upper bounds of the bins that each share of a line falls into.
_BINS = {"symbol": (0.005, 0.02, 0.05, 0.1, 0.2), "upper": (0.02, 0.06, 0.15, 0.3, 0.6),
         "digit": (0.005, 0.02, 0.1, 0.3), "bang": (0.01, 0.03, 0.08),
         "word_len": (2.5, 4.0, 5.5, 7.0, 10.0), "words": (1.5, 3.5, 8.5, 20.5, 60.5),
         "repeat": (0.05, 0.2, 0.5, 0.9)}
N_FEATURES = 1 + sum(len(b) + 1 for b in _BINS.values()) + 2


class _Lines:
    """Counts of the documents of a piece, and features of their lines."""

    def __init__(self, texts: tk.Texts):
        data, offs = texts.data, texts.offsets
        n = len(texts)
        s, e, cut = texts.words()
        h = texts.hashes(s, e)
        per_doc = np.diff(cut)
        doc_of_word = np.repeat(np.arange(n), per_doc)
        chars = _cum(~_CONT[data])
        solid_chars = chars[e] - chars[s]
        self.n_words = per_doc
        self.word_chars = _sums(solid_chars, cut)
        symbols = _cum(_SYMBOL[data])
        self.n_symbols = (symbols[offs[1:]] - symbols[offs[:-1]]).astype(np.int64)
        del symbols
        repeated = _repeated(h, doc_of_word)
        self.n_repeat = _sums(repeated, cut)
        # lines that hold a word, as byte ranges
        breaks = np.flatnonzero(data == 10)
        lo = np.unique(np.concatenate([offs[:-1], breaks + 1]))
        lo = lo[lo < len(data)]
        hi = np.concatenate([lo[1:], [len(data)]])
        line_doc = np.searchsorted(offs, lo, side="right") - 1
        hi = hi - ((hi > lo) & (data[np.maximum(hi - 1, 0)] == 10)
                   if len(data) else np.zeros(0, dtype=bool))
        w0, w1 = np.searchsorted(s, lo), np.searchsorted(s, hi)
        full = w1 > w0
        lo, hi, line_doc, w0, w1 = (x[full] for x in (lo, hi, line_doc, w0, w1))
        again = _later_equal(texts.hashes(lo, hi), line_doc)
        self.n_dup_lines = np.bincount(line_doc[again], minlength=n) if len(lo) else \
            np.zeros(n, dtype=np.int64)
        self.cut = np.searchsorted(line_doc, np.arange(n + 1))
        self.words = w1 - w0
        size = np.maximum(chars[hi] - chars[lo], 1)

        def share(table):
            c = _cum(table[data])
            return (c[hi] - c[lo]) / size
        rep = _cum(repeated)
        wc = np.concatenate([[0], np.cumsum(solid_chars)])
        values = {"symbol": share(_SYMBOL), "upper": share(_UPPER), "digit": share(_DIGIT),
                  "bang": share(_BANG), "word_len": (wc[w1] - wc[w0]) / np.maximum(self.words, 1),
                  "words": self.words, "repeat": (rep[w1] - rep[w0]) / np.maximum(self.words, 1)}
        x = np.zeros((len(lo), N_FEATURES), dtype=np.float32)
        x[:, 0] = 1
        col = 1
        for name, bins in _BINS.items():
            if len(lo):
                x[np.arange(len(lo)), col + np.searchsorted(bins, values[name])] = 1
            col += len(bins) + 1
        x[:, col] = again
        if len(lo):
            x[:, col + 1] = _STOP[data[e[w1 - 1] - 1]]
        self.features = x


def _cum(flags: np.ndarray) -> np.ndarray:
    """Running counts; half the memory as long as they fit."""
    kind = np.int32 if len(flags) < 1 << 31 else np.int64
    out = np.zeros(len(flags) + 1, dtype=kind)
    np.cumsum(flags, dtype=kind, out=out[1:])
    return out


def _sums(values: np.ndarray, cut: np.ndarray) -> np.ndarray:
    c = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return c[cut[1:]] - c[cut[:-1]]


def _keyed(hashes: np.ndarray, owner: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return tk.mix(hashes ^ tk.mix(owner.astype(np.uint64) + np.uint64(1)))


def _repeated(h: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Which words are in a 3-word window that occurs again in their document."""
    out = np.zeros(len(h), dtype=bool)
    if len(h) < 3:
        return out
    own = np.flatnonzero(doc[:-2] == doc[2:])
    keys = _keyed(tk.windows(h, 3)[own], doc[own])
    order = np.argsort(keys)
    k = keys[order]
    same = k[1:] == k[:-1]
    twice = np.zeros(len(k), dtype=bool)
    twice[1:] |= same
    twice[:-1] |= same
    at = own[order[twice]]
    for i in range(3):
        out[at + i] = True
    return out


def _later_equal(hashes: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Which lines equal an earlier line of their document."""
    out = np.zeros(len(hashes), dtype=bool)
    keys = _keyed(hashes, doc)
    order = np.argsort(keys, kind="stable")
    out[order[1:][keys[order[1:]] == keys[order[:-1]]]] = True
    return out


def viterbi(emit: np.ndarray, trans: np.ndarray) -> list[int]:
    """Best state sequence of a two-state chain (ties: state 0)."""
    (t00, t01), (t10, t11) = trans.tolist()
    a, b = 0.0, 0.0
    back = []
    first = True
    for x, y in emit.tolist():
        if first:
            a, b, first = x, y, False
            continue
        f0, f1 = b + t10 > a + t00, b + t11 > a + t01
        back.append((f0, f1))
        a, b = (b + t10 if f0 else a + t00) + x, (b + t11 if f1 else a + t01) + y
    state = int(b > a)
    path = [state]
    for f in reversed(back):
        state = int(f[state])
        path.append(state)
    return path[::-1]


def fit_crf(docs: list[tuple[np.ndarray, np.ndarray]], steps: int = 120, rate: float = 0.15,
            l2: float = 1e-3) -> tuple[np.ndarray, np.ndarray]:
    """(emission weights [features, 2], transition scores [2, 2]) by Adam on the
    mean log-likelihood of (features, states) sequences."""
    docs = sorted((d for d in docs if len(d[1])), key=lambda d: -len(d[1]))
    n, longest = len(docs), len(docs[0][1])
    lengths = np.array([len(d[1]) for d in docs])
    flat = np.concatenate([d[0] for d in docs]).astype(np.float64)
    states = np.concatenate([d[1] for d in docs])
    begin = np.cumsum(lengths) - lengths
    alive = [int((lengths > t).sum()) for t in range(longest)]
    gold = np.zeros((flat.shape[1], 2))
    for y in (0, 1):
        gold[:, y] = flat[states == y].sum(axis=0)
    gold_t = np.zeros((2, 2))
    inner = np.ones(len(states), dtype=bool)
    inner[begin] = False
    at = np.flatnonzero(inner)
    np.add.at(gold_t, (states[at - 1], states[at]), 1)
    w, t = np.zeros((flat.shape[1], 2)), np.zeros((2, 2))
    moments = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(t), np.zeros_like(t)]
    for step in range(1, steps + 1):
        emit = flat @ w
        alpha, beta = np.empty_like(emit), np.zeros_like(emit)
        alpha[begin] = emit[begin]
        for i in range(1, longest):
            k = begin[:alive[i]] + i
            prev = alpha[k - 1]
            alpha[k] = emit[k] + np.logaddexp(prev[:, :1] + t[0], prev[:, 1:] + t[1])
        for i in range(longest - 2, -1, -1):
            k = begin[:alive[i + 1]] + i
            nxt = emit[k + 1] + beta[k + 1]
            beta[k] = np.logaddexp(nxt[:, :1] + t[:, 0], nxt[:, 1:] + t[:, 1])
        last = alpha[begin + lengths - 1]
        z = np.repeat(np.logaddexp(last[:, 0], last[:, 1]), lengths)
        p = np.exp(alpha + beta - z[:, None])
        pair = np.exp(alpha[at - 1][:, :, None] + t + (emit[at] + beta[at])[:, None, :]
                      - z[at][:, None, None]).sum(axis=0)
        grads = (gold - flat.T @ p) / n - l2 * w, (gold_t - pair) / n - l2 * t
        for j, (value, g) in enumerate(zip((w, t), grads)):
            m, v = moments[2 * j], moments[2 * j + 1]
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            value += rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return w, t


def train(docs: DataFrame, labels: DataFrame, max_docs: int = SAMPLE_DOCS,
          max_lines: int = SAMPLE_LINES):
    """A CRF fitted on at most ``max_docs`` labelled documents (those of the
    smallest id hashes) and ``max_lines`` lines of each; None if the labels do
    not hold both qualities."""
    sample = (labels.select(F.col("doc_id").cast("long").alias("doc_id"),
                            F.col("quality").cast("int").alias("quality"))
              .where("doc_id is not null and quality in (0, 1)")
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs))
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                         F.col("text").cast("string").alias("text")).join(
        F.broadcast(sample), "doc_id")          # at most max_docs rows

    def run(batches):
        for batch in batches:
            for texts in tk.texts_of(batch.column("text")):
                lines = _Lines(texts)
                spans = [(i, lo, hi) for i, (a, b) in enumerate(zip(lines.cut[:-1], lines.cut[1:]))
                         for lo, hi in _blocks(int(a), int(b), max_lines)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("quality").slice(texts.first, len(texts)).take(
                        pa.array([i for i, _, _ in spans], pa.int64())),
                     pa.array([lines.features[lo:hi].astype(np.uint8).tobytes()
                               for _, lo, hi in spans], pa.binary())], ["quality", "x"])
    rows = map_arrow(chosen, run, "quality int, x binary").collect()
    data = [(np.frombuffer(r.x, dtype=np.uint8).reshape(-1, N_FEATURES), r.quality) for r in rows]
    if len({q for _, q in data}) < 2:
        return None
    data.sort(key=lambda d: (d[1], d[0].shape[0], d[0].tobytes()))
    states = first_states(data)
    for i in range(ROUNDS):
        model = fit_crf([(x, y) for (x, _), y in zip(data, states)],
                        steps=60 if i + 1 < ROUNDS else 120)
        states = [np.array(viterbi(x @ model[0] + _prior(q), model[1])) for x, q in data]
    return model


def _blocks(a: int, b: int, limit: int) -> list[tuple[int, int]]:
    """At most ``limit`` of the lines a..b: all, or blocks spread evenly."""
    if b - a <= limit:
        return [(a, b)] if b > a else []
    size = max(1, limit // SAMPLE_BLOCKS)
    starts = np.linspace(a, b - size, SAMPLE_BLOCKS).astype(int).tolist()
    return [(s, s + size) for s in starts]


def _prior(quality: int) -> np.ndarray:
    return np.array([0.0, PRIOR]) if quality else np.array([PRIOR, 0.0])


def first_states(data: list[tuple[np.ndarray, int]]) -> list[np.ndarray]:
    """The state of each line from its kind: how much more often its features
    occur on lines of good documents than of bad ones (every document counts
    once, however many lines it has), and its own document's label."""
    seen = np.full((2, N_FEATURES), 0.5)
    total = np.ones(2)
    for x, q in data:
        seen[q] += x.mean(axis=0)
        total[q] += 1
    p = np.clip(seen / total[:, None], 1e-3, 1 - 1e-3)
    weight = np.log(p[1] / p[0])
    weight[0] = 0.0
    return [(x @ weight + (_prior(q)[1] - _prior(q)[0]) > 0).astype(np.int64) for x, q in data]


_FIELDS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
           "kept", "n_lines", "n_content_lines", "content_share"]


def _judge(column: pa.Array, model, min_words: int, min_share: float) -> Iterator[list]:
    """Per piece of a text column, one numpy array for each of _FIELDS."""
    for texts in tk.texts_of(column):
        x = _Lines(texts)
        failed = (x.n_words < min_words) | (100 * x.n_repeat > 50 * x.n_words)
        n_lines = np.diff(x.cut)
        content_lines = n_lines.copy()
        share = (x.n_words > 0).astype(float)
        if model is not None:
            weights, trans = model
            emit = x.features @ weights
            for d in np.flatnonzero(n_lines):
                a, b = x.cut[d], x.cut[d + 1]
                path = np.array(viterbi(emit[a:b], trans))
                content_lines[d] = path.sum()
                share[d] = (path * x.words[a:b]).sum() / x.words[a:b].sum()
        yield [x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat, failed,
               ~failed & (share >= min_share), n_lines, content_lines, share]


def quality_rules(docs: DataFrame, model, min_words: int = 50,
                  min_share: float = MIN_SHARE) -> DataFrame:
    """(doc_id, counts, base_failed, kept, line counts, content_share) per row.

    ``model`` comes from ``train``; None means that only the count rules judge.
    Null, empty and wordless texts have no words, fail the rules and are not
    kept.  Repeated rows are judged alike.  A tie of label sequences goes to
    boilerplate, a content share of exactly ``min_share`` is kept.  Only
    ``doc_id`` and ``text`` are read; an empty table gives no rows.
    """
    def run(batches):
        for batch in batches:
            at = 0
            for got in _judge(batch.column("text"), model, min_words, min_share):
                n = len(got[0])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(at, n), *(pa.array(g) for g in got)],
                    ["doc_id", *_FIELDS])
                at += n
    return map_arrow(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                    F.col("text").cast("string").alias("text")), run,
        "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
        "n_repeat_words long, base_failed boolean, kept boolean, n_lines long, "
        "n_content_lines long, content_share double")


def keep_quality(docs: DataFrame, model, min_words: int = 50,
                 min_share: float = MIN_SHARE) -> DataFrame:
    """The rows of ``docs`` that ``quality_rules`` keeps, all columns as they are."""
    at = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                kept = np.concatenate([g[6] for g in _judge(batch.column(at), model, min_words,
                                                            min_share)])
                yield batch.filter(pa.array(kept))
    return map_arrow(docs, run, docs.schema)
