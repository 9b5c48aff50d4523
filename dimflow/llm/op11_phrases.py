"""Operator 11: phrase collocations, counted in HAT-tries.

Words and phrases of up to four words are counted in three passes over the
texts: words, then pairs of frequent words, then phrases of three and four
words whose pairs are all frequent (no phrase is more frequent than its parts;
the frequent parts travel as a bitmap of fixed size, which lets too much pass
when full but loses nothing).  A task counts in a trie over the ids that it
gives to words: the first word leads to a hash container of the remaining ids,
and a container that grows too large bursts into one container a next word.
When the trie is full, its largest subtrees leave whole, each as one sorted run
(a row of Spark's shuffle), and the runs of all tasks are merged prefix by
prefix; a prefix is a first word, and those of frequent words are salted, so that
they spread over tasks.  (Single words have no prefix: they are counted by id
and leave as runs of hashed parts.)  Candidates are then scored and filtered by
joins of the frequent phrases only.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from dimflow.llm import textkit as tk
from dimflow.llm.common import FILTER_BITS, cut, id_filter, map_arrow, maybe

#: Bytes of text worked on at a time.
CHUNK = 1 << 20
#: Entries and words that a task holds before it spills; results do not depend
#: on them.
CAPACITY = 400_000
#: Entries at which a container bursts.
BURST = 4096
#: Parts over which the runs of a frequent first word are spread (it is frequent
#: with 1 / HOT of all words, so there are at most HOT such words), and those of
#: single words, which have no prefix.
SALT, HOT, SINGLES = 256, 1000, 4096
#: Parts of a lang that are ranked before the lang is.
RANKED = 32
#: Bytes of runs that are merged together.
MERGE = 8 << 20
_ID = 21
_MASK = (1 << _ID) - 1

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BREAK = np.zeros(256, dtype=bool)
_BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_GAP = _BREAK.copy()
_GAP[[0x20, 0x09]] = True


class HatTrie:
    """Counts of word-id sequences of one to four words.

    A sequence is a first id and a key that packs the ids after it, next id
    lowest.  Below each first id hangs a container (dict key -> count) or, once
    burst, a node (``_Node``: next id -> container of the keys after it)."""

    def __init__(self, words: int):
        self.depth = words - 1                           # ids that may follow the first
        self.root: dict[int, dict] = {}
        self.sizes: dict[int, int] = {}
        self.entries = 0

    def add(self, first: int, keys: list[int], counts: list[int]) -> None:
        child = self.root.get(first)
        if child is None:
            child = self.root[first] = {}
            self.sizes[first] = 0
        child, more = self._add(child, keys, counts, self.depth)
        self.root[first] = child
        self.sizes[first] += more
        self.entries += more

    def _add(self, child, keys, counts, depth):
        if isinstance(child, _Node):
            apart: dict[int, tuple[list, list]] = {}
            for key, n in zip(keys, counts):
                part = apart.setdefault(key & _MASK, ([], []))
                part[0].append(key >> _ID)
                part[1].append(n)
            more = 0
            for word, (k, n) in apart.items():
                child[word], grown = self._add(child.get(word, {}), k, n, depth - 1)
                more += grown
            return child, more
        before = len(child)
        get = child.get
        for key, n in zip(keys, counts):
            child[key] = get(key, 0) + n
        more = len(child) - before
        if len(child) > BURST and depth > 1:
            node = _Node()
            node, _ = self._add(node, list(child), list(child.values()), depth)
            return node, more
        return child, more

    def _walk(self, child, prefix: tuple):
        if isinstance(child, _Node):
            for word, below in child.items():
                yield from self._walk(below, (*prefix, word) if word else prefix)
            return
        for key, n in child.items():
            ids = prefix
            while key:
                ids = (*ids, key & _MASK)
                key >>= _ID
            yield ids, n

    def spill(self, keep: int):
        """(first id, [(ids, count)]) of whole subtrees, largest first, until
        at most ``keep`` entries are left."""
        for first in sorted(self.sizes, key=self.sizes.get, reverse=True):
            if self.entries <= keep and (keep or not self.root):
                break
            self.entries -= self.sizes.pop(first)
            yield first, list(self._walk(self.root.pop(first), (first,)))


class _Node(dict):
    """A burst container: next id -> container or node."""


class _Lang:
    """Word ids and trie of one language in one task."""

    def __init__(self, lang: str, words: int, hot: frozenset = frozenset()):
        self.lang, self.words = lang, words
        self.hot = {name for of, name in hot if of == lang}
        self.salt = _word_hashes(pa.array([lang]).cast(pa.large_binary()))[0]
        self.total = 0
        self.clear()

    def clear(self) -> None:
        self.trie = HatTrie(self.words)
        self.singles = np.zeros(1024, dtype=np.int64)    # by word id, if single words count
        self.ids: dict[str, int] = {}
        self.names: list[str] = [""]                     # ids start at 1

    def held(self) -> int:
        return self.trie.entries + len(self.names)

    def number(self, names: list[str]) -> list[int]:
        ids, out = self.ids, []
        for name in names:
            i = ids.get(name)
            if i is None:
                i = ids[name] = len(self.names)
                self.names.append(name)
            out.append(i)
        return out

    def runs(self, keep: int):
        """(lang, prefix, salt, run, counts): subtrees as sorted runs.  Single
        words have the empty prefix."""
        names = self.names
        if self.words == 1:
            at = np.flatnonzero(self.singles)
            yield from self._salted("", [names[i] for i in at.tolist()], self.singles[at].tolist(),
                                    SINGLES)
        for first, found in self.trie.spill(keep):
            if self.words == 2:
                rest = [names[ids[1]] for ids, _ in found]
            else:
                rest = [" ".join([names[i] for i in ids[1:]]) for ids, _ in found]
            prefix, counts = names[first], [n for _, n in found]
            if prefix in self.hot:
                yield from self._salted(prefix, rest, counts)
            else:
                yield self._run(prefix, 0, sorted(zip(rest, counts)))

    def _salted(self, prefix: str, rest: list[str], counts: list[int], salt: int = SALT):
        parts: list[list] = [[] for _ in range(salt)]
        for pair in zip(rest, counts):
            parts[zlib.crc32(pair[0].encode()) % salt].append(pair)
        for i, part in enumerate(parts):
            if part:
                yield self._run(prefix, i, sorted(part))

    def _run(self, prefix, salt, pairs):
        counts = np.array([n for _, n in pairs], dtype="<i8")
        small = counts.max() < 256
        return (self.lang, prefix, salt, "\n".join([r for r, _ in pairs]),
                b"\x01" + counts.astype(np.uint8).tobytes() if small
                else b"\x08" + counts.tobytes())


_RUN = "lang string, prefix string, salt int, run string, counts binary"


def _run_batches(rows):
    """Runs as Arrow batches of a few MB."""
    types = [pa.string(), pa.string(), pa.int32(), pa.string(), pa.binary()]
    names = ["lang", "prefix", "salt", "run", "counts"]
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[3]) + len(row[4]) + 32
        if size > 4 << 20:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*held), types)], names)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*held), types)], names)


def _decoded(batch: pa.RecordBatch) -> pa.Table:
    """(lang, salt, phrase, n) of every entry of some runs."""
    rest = pc.split_pattern(batch.column("run").cast(pa.large_string()), "\n")
    at = pc.list_parent_indices(rest)
    counts = np.concatenate([
        np.frombuffer(c.as_buffer(), np.uint8, offset=1) if c.as_buffer()[0] == 1
        else np.frombuffer(c.as_buffer(), "<i8", offset=1) for c in batch.column("counts")])
    prefix = pc.binary_join_element_wise(
        batch.column("prefix").cast(pa.large_string()), pa.scalar("", pa.large_string()),
        pa.scalar(" ", pa.large_string()))
    prefix = pc.if_else(pc.equal(batch.column("prefix"), ""), pa.scalar("", pa.large_string()),
                        prefix)
    phrase = pc.binary_join_element_wise(prefix.take(at), rest.flatten(),
                                         pa.scalar("", pa.large_string()))
    return pa.table({"lang": batch.column("lang").take(at), "salt": batch.column("salt").take(at),
                     "phrase": phrase,
                     "n": pa.array(counts.astype(np.int64))})


def _merged(tables: list[pa.Table]) -> pa.Table:
    out = pa.concat_tables(tables).combine_chunks().group_by(
        ["lang", "salt", "phrase"]).aggregate([("n", "sum")])
    return out.rename_columns({"n_sum": "n"}).select(["lang", "salt", "phrase", "n"])


def _finished(table: pa.Table, min_count: int):
    """Frequent phrases of whole prefixes, with size and filter slot."""
    table = table.filter(pc.greater_equal(table.column("n"), min_count)).combine_chunks()
    for batch in table.to_batches(max_chunksize=1 << 16):
        if not len(batch):
            continue
        parts = pc.split_pattern(batch.column("phrase"), " ")
        sizes = pc.list_value_length(parts).to_numpy()
        hashes = _word_hashes(parts.flatten().cast(pa.large_binary()))
        begin = np.cumsum(sizes) - sizes
        langs = batch.column("lang").dictionary_encode()
        salt = _word_hashes(langs.dictionary.cast(pa.large_binary()))[langs.indices.to_numpy()]
        slot = np.zeros(len(batch), dtype=np.int64)
        for m in np.unique(sizes):
            at = np.flatnonzero(sizes == m)
            slot[at] = _slots(_phrase_hash([hashes[begin[at] + j] for j in range(m)], salt[at]))
        yield pa.RecordBatch.from_arrays(
            [batch.column("lang").cast(pa.string()), batch.column("phrase").cast(pa.string()),
             pa.array(sizes, pa.int32()), batch.column("n"), pa.array(slot)],
            ["lang", "phrase", "words", "n", "slot"])


def _merge(batches, min_count: int):
    """Sum up sorted runs, which come prefix by prefix.  Memory follows MERGE
    and the distinct phrases of one salted prefix."""
    held, size, limit = [], 0, MERGE
    for batch in batches:
        for lo in range(0, len(batch), 1 << 12):
            part = batch.slice(lo, 1 << 12)
            held.append(_decoded(part))
            size += held[-1].nbytes
            if size <= limit:
                continue
            # the last prefix may go on; all before it are complete
            last = [part.column(c)[len(part) - 1].as_py() for c in ("lang", "salt", "prefix")]
            done, rest = _split(_merged(held), *last)
            yield from _finished(done, min_count)
            held, size = [rest], rest.nbytes
            limit = max(MERGE, 2 * size)
    if held:
        yield from _finished(_merged(held), min_count)


def _split(table: pa.Table, lang: str, salt: int, prefix: str) -> tuple[pa.Table, pa.Table]:
    """(rows of other prefixes, rows that may belong to this one)."""
    mine = pc.and_(pc.equal(table.column("lang"), lang), pc.equal(table.column("salt"), salt))
    if prefix:
        mine = pc.and_(mine, pc.starts_with(table.column("phrase"), prefix + " "))
    return table.filter(pc.invert(mine)), table.filter(mine)


def _phrase_hash(parts, salt) -> np.ndarray:
    """Hash of a phrase from its words' hashes (one array a word)."""
    with np.errstate(over="ignore"):
        acc = np.full(len(parts[0]), salt, dtype=np.uint64)
        for h in parts:
            acc = tk.mix(acc * np.uint64(0x9FB21C651E98DF25) + h)
    return acc


def _slots(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)


def _chunks(column: pa.Array):
    """Lower-cased bytes of the texts, a line break between texts, in parts of
    about CHUNK bytes that end at a break."""
    empty = pa.scalar("", pa.large_string())
    ended = pc.binary_join_element_wise(column.cast(pa.large_string()).fill_null(""), empty,
                                        pa.scalar("\n", pa.large_string()))
    if not len(ended):
        return
    data = np.frombuffer(ended.buffers()[2], dtype=np.uint8)
    lo = 0
    while lo < len(data):
        hi = lo + CHUNK
        while hi < len(data):
            found = np.flatnonzero(_BREAK[data[hi:hi + CHUNK]])
            if len(found):
                hi += int(found[0])
                break
            hi += CHUNK
        yield _LOWER[data[lo:hi]]
        lo = hi


def _words(data: np.ndarray):
    """(words, code, linked): distinct words, the word at each place, and
    whether a place and the next one lie in one piece."""
    solid = ~_GAP[data]
    edge = np.diff(np.r_[False, solid, False].astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    breaks = np.cumsum(_BREAK[data], dtype=np.int32)
    linked = breaks[starts[1:]] == breaks[ends[:-1] - 1]
    offsets = np.r_[0, np.cumsum(ends - starts)].astype(np.int64)
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(offsets),
                                         pa.py_buffer(np.ascontiguousarray(data[solid]))])
    coded = words.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(), linked


def _word_hashes(words: pa.LargeBinaryArray) -> np.ndarray:
    offsets = np.frombuffer(words.buffers()[1], dtype=np.int64)[
        words.offset:words.offset + len(words) + 1]
    data = np.frombuffer(words.buffers()[2] or b"", dtype=np.uint8)
    return tk.Texts(data, offsets, 0).hashes(offsets[:-1], offsets[1:])


def _count(state: _Lang, data: np.ndarray, words: int, frequent, pairs) -> None:
    """Add the phrases of one chunk to the trie: single words (``words`` 1),
    pairs of frequent words (2), or phrases of three and four words of frequent
    pairs (4)."""
    distinct, code, linked = _words(data)
    if not len(code):
        return
    if words == 1:
        state.total += len(code)
        ids = np.array(state.number(distinct.cast(pa.large_string()).to_pylist()))
        if len(state.names) > len(state.singles):
            state.singles = np.concatenate(
                [state.singles, np.zeros(len(state.names), dtype=np.int64)])
        state.singles[ids] += np.bincount(code, minlength=len(distinct))
        return
    hashes = _word_hashes(distinct)
    good = maybe(frequent, _slots(_phrase_hash([hashes], state.salt)))
    both = linked & good[code[:-1]] & good[code[1:]]
    at = np.flatnonzero(both)
    if not len(at):
        return
    if words == 4:
        # only pairs that may be frequent go on
        ok = maybe(pairs, _slots(_phrase_hash(
            [hashes[code[at]], hashes[code[at + 1]]], state.salt)))
        at = at[ok]
        both = np.zeros(len(code) + 2, dtype=bool)
        both[at] = True
        three = both[at + 1]
        if not three.any():
            return
        needed = np.zeros(len(code), dtype=bool)
        for j in range(3):
            needed[at[three] + j] = True
    else:
        needed = np.zeros(len(code), dtype=bool)
        needed[at] = needed[at + 1] = True
    used = np.unique(code[needed])
    number = np.zeros(len(distinct), dtype=np.int64)
    number[used] = state.number(distinct.take(pa.array(used)).cast(pa.large_string()).to_pylist())
    ids = number[code]
    if words == 2:
        key, n = np.unique(ids[at] << _ID | ids[at + 1], return_counts=True)
        _insert(state.trie, key >> _ID, key & _MASK, n)
        return
    pair = np.zeros(len(code) + 2, dtype=np.int64)
    ranks, inverse = np.unique(ids[at] << _ID | ids[at + 1], return_inverse=True)
    pair[at] = inverse
    starts = at[three]
    for m in (3, 4):
        if m == 4:
            starts = starts[both[starts + 2]]
        if not len(starts):
            break
        # pair ranks sort by first word, so the phrases come grouped by it
        _, where, n = np.unique(pair[starts] * len(ranks) + pair[starts + m - 2],
                                return_index=True, return_counts=True)
        where = starts[where]
        key = sum(ids[where + j] << (_ID * (j - 1)) for j in range(1, m))
        _insert(state.trie, ids[where], key, n)


def _insert(trie: HatTrie, first: np.ndarray, key: np.ndarray, n: np.ndarray) -> None:
    ends = np.flatnonzero(np.diff(first)) + 1
    lo = 0
    firsts, keys, counts = first.tolist(), key.tolist(), n.tolist()
    for hi in [*ends.tolist(), len(first)]:
        trie.add(firsts[lo], keys[lo:hi], counts[lo:hi])
        lo = hi


def _counted(docs: DataFrame, words: int, min_count: int, frequent=None, pairs=None,
             hot: frozenset = frozenset()) -> DataFrame:
    """(lang, phrase, words, n, slot) of the phrases with n >= min_count, kept in
    the shared folder; for single words also the number of words of each lang,
    as a row of ``words`` 0."""
    def spilled(batches):
        states: dict[str, _Lang] = {}
        for batch in batches:
            langs = batch.column("lang").dictionary_encode()
            for i, lang in enumerate(langs.dictionary.to_pylist()):
                state = states.setdefault(lang, _Lang(lang, words, hot))
                mine = batch.column("text").filter(pc.equal(langs.indices, i))
                for data in _chunks(mine):
                    _count(state, data, words, frequent, pairs)
                    if sum(s.held() for s in states.values()) <= CAPACITY:
                        continue
                    if state.trie.entries > CAPACITY // 2:
                        yield from state.runs(CAPACITY // 4)
                    else:                                # words or many langs: start anew
                        for s in states.values():
                            yield from s.runs(0)
                            s.clear()
        for state in states.values():
            yield from state.runs(0)
            if state.total:                              # no word holds a blank
                yield state._run(" ", 0, [("", state.total)])

    def run(batches):
        yield from _run_batches(spilled(batches))

    def merge(batches):
        for batch in _merge(batches, min_count):
            total = pc.equal(batch.column("phrase"), "  ")
            yield batch.set_column(2, "words", pc.if_else(
                total, pa.scalar(0, pa.int32()), batch.column("words"))) if words == 1 else batch
    runs = map_arrow(docs, run, _RUN).repartition("lang", "prefix", "salt").sortWithinPartitions(
        "lang", "prefix", "salt")
    return cut(map_arrow(runs, merge, "lang string, phrase string, words int, n long, slot long"))


def frequent_phrases(docs: DataFrame, min_count: int) -> tuple[DataFrame, DataFrame]:
    """(phrases, totals): (lang, phrase, words, f) of all phrases of one to four
    words with f >= min_count, and (lang, total) words of each lang."""
    docs = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
                       F.col("text").cast("string").alias("text")).where("text is not null")
    singles = _counted(docs, 1, min_count)
    words = singles.where("words = 1")
    totals = singles.where("words = 0").select("lang", F.col("n").alias("total"))
    all_words = totals.agg(F.sum("total")).first()[0] or 0
    hot = frozenset((r.lang, r.phrase) for r in
                    words.where(F.col("n") * HOT >= all_words).collect())
    frequent = id_filter(words, "slot", F.col("slot"))
    pairs = _counted(docs, 2, min_count, frequent, hot=hot)
    longer = _counted(docs, 4, min_count, frequent,
                      id_filter(pairs, "slot", F.col("slot")), hot)
    phrases = words.unionAll(pairs).unionAll(longer).select(
        "lang", "phrase", "words", F.col("n").alias("f"))
    return phrases, totals


def _exact(column: str) -> F.Column:
    return F.col(column).cast("decimal(20,0)")


def collocations(docs: DataFrame, min_count: int = 30, top: int = 2000, inside: int = 80,
                 scale: int = 2_000_000) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each lang.

    Texts are lower-cased (A-Z), split into pieces at ``.,;:!?`` and line ends,
    and those into words at blanks and tabs.  A candidate is a phrase of two to
    four words with ``a`` >= ``min_count`` occurrences within pieces.  Cut after
    k words, with ``l`` and ``r`` occurrences of its parts, it scores
    floor(scale * a / (l + r)); its lowest cut counts, the smallest k of equal
    ones.  Candidates inside a longer candidate with at least ``inside`` % of
    their occurrences are dropped.  Ties in rank go by ``a`` descending, then by
    the phrase's bytes.  ``n`` is the number of words of the lang.

    A null lang is read as ``und``; null, empty and wordless texts add nothing;
    repeated rows count each time; an empty table gives no rows; only ``text``
    and ``lang`` are read.  Texts are worked on in chunks that end between
    pieces, so memory follows the longest piece, not the text.
    """
    phrases, totals = frequent_phrases(docs, max(1, min_count))
    candidates = phrases.where("words > 1").select("lang", "phrase", "words", F.col("f").alias("a"))
    # contained in a longer candidate that is nearly as frequent
    within = (candidates.where("words > 2")
              .select("lang", "a", "words", F.split("phrase", " ").alias("w"))
              .withColumn("m", F.explode(F.expr("sequence(2, words - 1)")))
              .withColumn("i", F.explode(F.expr("sequence(1, words - m + 1)")))
              .select("lang", F.array_join(F.slice("w", F.col("i"), F.col("m")), " ").alias(
                  "phrase"), "a")
              .groupBy("lang", "phrase").agg(F.max("a").alias("longer")))
    free = candidates.join(within, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (_exact("longer") * 100 < _exact("a") * inside)).drop("longer")
    parts = (free.withColumn("w", F.split("phrase", " "))
             .withColumn("k", F.explode(F.expr("sequence(1, words - 1)")))
             .select("lang", "phrase", "a", "k",
                     F.array_join(F.expr("slice(w, 1, k)"), " ").alias("head"),
                     F.array_join(F.expr("slice(w, k + 1, words - k)"), " ").alias("tail")))
    known = phrases.select("lang", "phrase", "f")
    parts = (parts.join(known.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l")),
                        ["lang", "head"])
             .join(known.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r")),
                   ["lang", "tail"]))
    parts = parts.withColumn("score", F.expr(
        f"cast({scale} as decimal(12,0)) * cast(a as decimal(20,0)) "
        "div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))"))
    scored = (parts.groupBy("lang", "phrase")
              .agg(F.min(F.struct("score", "k", "l", "r")).alias("best"), F.first("a").alias("a"))
              .select("lang", "phrase", "a", "best.l", "best.r", "best.score"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # the first of each salted part, then of those: no task sorts a whole lang
    scored = scored.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(RANKED)))
    scored = scored.withColumn("rank", F.row_number().over(
        Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    scored = scored.withColumn("rank", F.row_number().over(
        Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return scored.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r",
        F.col("total").alias("n"), F.col("score").cast("long").alias("score"))


#: The same in DuckDB SQL, with the query's parameters.
ORACLE_SQL = r"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang,
         translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents WHERE text IS NOT NULL),
p AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
w AS (SELECT row_number() OVER () AS id, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
      FROM p),
g AS (SELECT id, lang, unnest(w) AS w1, generate_subscripts(w, 1) AS i FROM w),
e AS (SELECT lang, w1, lead(w1, 1) OVER x AS w2, lead(w1, 2) OVER x AS w3, lead(w1, 3) OVER x AS w4
      FROM g WINDOW x AS (PARTITION BY id ORDER BY i)),
h AS (SELECT lang, 1 AS m, w1 AS phrase FROM e
      UNION ALL SELECT lang, 2, w1 || ' ' || w2 FROM e WHERE w2 IS NOT NULL
      UNION ALL SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3 FROM e WHERE w3 IS NOT NULL
      UNION ALL SELECT lang, 4, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4 FROM e
                WHERE w4 IS NOT NULL),
f AS (SELECT lang, m, phrase, count(*) AS f FROM h GROUP BY ALL),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE m = 1 GROUP BY lang),
c AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM f
      WHERE m > 1 AND f >= 30),
s AS (SELECT lang, a, w, m, unnest(range(2, m)) AS k FROM c WHERE m > 2),
s2 AS (SELECT lang, a, w, k, unnest(range(1, m - k + 2)) AS i FROM s),
inside AS (SELECT lang, array_to_string(list_slice(w, i, i + k - 1), ' ') AS phrase, max(a) AS b
           FROM s2 GROUP BY ALL),
free AS (SELECT c.* FROM c LEFT JOIN inside USING (lang, phrase)
         WHERE b IS NULL OR 100 * CAST(b AS HUGEINT) < 80 * CAST(a AS HUGEINT)),
k AS (SELECT lang, phrase, a, w, m, unnest(range(1, m)) AS k FROM free),
x AS (SELECT k.lang, k.phrase, k.a, k.k, l.f AS l, r.f AS r,
             CAST(2000000 * CAST(k.a AS HUGEINT) // (CAST(l.f AS HUGEINT) + r.f) AS BIGINT) AS score
      FROM k JOIN f l ON l.lang = k.lang AND l.phrase = array_to_string(list_slice(k.w, 1, k.k), ' ')
      JOIN f r ON r.lang = k.lang AND r.phrase = array_to_string(list_slice(k.w, k.k + 1, k.m), ' ')),
y AS (SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
z AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
      FROM y)
SELECT lang, rank, phrase, a, l, r, n, score FROM z JOIN n USING (lang) WHERE rank <= 2000
"""
