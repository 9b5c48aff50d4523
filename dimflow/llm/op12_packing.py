"""Operator 12: packing documents into training windows by Karmarkar-Karp.

Documents become token ids and are cut into whole windows and a rest in pieces
of at most a quarter of a window; only a document's rest is packed with others.
Pieces are dealt at random into groups of bounded size.  Inside a group,
Karmarkar-Karp multiway differencing forms k windows: every piece starts as a
partition of its own, the two partitions with the largest imbalance are merged
again and again, the fullest window of one onto the emptiest of the other,
until one partition with near-equal windows is left.  k starts at the least
possible count and rises whenever a window exceeds its capacity.
"""

from __future__ import annotations

import codecs
import functools
import heapq
import json
import os
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimflow.llm.common import cut, map_arrow, partitions

#: Pieces that one group holds on average; a group is packed by one task.
GROUP = 2048
#: Characters of a text that are tokenized at a time.
BLOCK = 1 << 18
#: Characters and ids that a worker's memory of units holds before it starts
#: anew; only speed depends on it.
MEMORY = 24_000_000

#: Texts of these characters only: lower case is one letter for one, NFC leaves
#: them, all are in Latin-1, and every unit (a run of letters, a run of marks or
#: one digit) is one pre-token of the tokenizer.
_SAFE = re.compile(r"[\t-\r -&(-;=-~À-ÖØ-öø-ÿ]*")
_WORD = re.compile(r"[^\t-\r ]+")
#: What stands for a word of other characters; no safe text holds it.
_ODD = "\0"
_LETTER, _SINGLE, _MARK = 1, 2, 3
_KINDS = bytearray([_MARK] * 256)
for _b in (0x20, *range(0x09, 0x0E)):
    _KINDS[_b] = 0
for _b in (*range(0x61, 0x7B), *range(0xDF, 0x100)):
    _KINDS[_b] = _LETTER
for _b in (ord(_ODD), *range(0x30, 0x3A)):
    _KINDS[_b] = _SINGLE
#: The bytes of a key that a unit of 0 to 8 characters takes.
_HEAD = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def _plain(tokenizer) -> tuple | None:
    """(tokenizer, letters, ends): the same model for lower-case units that are
    one pre-token each, set apart by blanks; the letter of each byte of theirs;
    and which ids end a unit.  None if the ids cannot tell that."""
    from tokenizers import Tokenizer
    from tokenizers.pre_tokenizers import ByteLevel
    spec = json.loads(tokenizer.to_str())
    model = spec["model"]
    suffix, vocab = model.get("end_of_word_suffix"), model["vocab"]
    if model["type"] != "BPE" or not suffix or not all(
            c in vocab and c + suffix in vocab for c in ByteLevel.alphabet()):
        return None
    spec.update(normalizer=None, post_processor=None, added_tokens=[],
                pre_tokenizer={"type": "CharDelimiterSplit", "delimiter": " "})
    # in UTF-8 a unit's bytes are ASCII, 0xC3 and 0x80 to 0xBF
    level = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
    letters = [chr(b) for b in range(256)]
    for c in range(0xC0, 0x100):
        for b, letter in zip(chr(c).encode(), level(chr(c))[0][0]):
            letters[b] = letter
    letters = "".join(letters)
    ends = np.zeros(max(vocab.values()) + 1, dtype=bool)
    ends[[i for token, i in vocab.items() if token.endswith(suffix)]] = True
    return Tokenizer.from_str(json.dumps(spec)), letters, ends


class Units(dict):
    """Ids of units of text, by the tokenizers library, each unit encoded once.

    The tokenizer drops white space, so a text's ids are those of its words one
    after the other; words of plain Latin letters, digits and marks are split
    further into the tokenizer's own pre-tokens, which recur far more often.
    A unit of up to 8 characters is known by its Latin-1 bytes as a number, a
    longer one by its bytes, any other word by its text.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.plain = _plain(self.tokenizer)
        self.reset()

    def reset(self) -> None:
        self.clear()
        self.new: list[int | bytes | str] = []
        self.held = 0
        self.ids = np.empty(0, np.uint32)
        self.bounds = np.zeros(1, np.int64)

    def __missing__(self, unit: int | bytes | str) -> int:
        self[unit] = n = len(self)
        self.new.append(unit)
        self.held += 16 if isinstance(unit, int) else len(unit) + 8
        return n

    def _learn(self) -> None:
        """The ids of the new units, in the order of their numbers."""
        texts = [u if isinstance(u, str) else
                 (u.to_bytes(8, "little").rstrip(b"\0") if isinstance(u, int) else u)
                 .decode("latin-1") for u in self.new]
        odd = np.array([isinstance(u, str) or self.plain is None for u in self.new])
        flat, count = [], np.zeros(len(texts), dtype=np.int64)
        for own, rows in ((False, np.flatnonzero(~odd)), (True, np.flatnonzero(odd))):
            for lo in range(0, len(rows), 1 << 16):
                part = rows[lo:lo + (1 << 16)]
                ids, n = (self._each if own else self._together)(
                    [texts[i] for i in part.tolist()])
                flat.append(ids)
                count[part] = n
        # kept as encoded: plain units first
        order = np.argsort(odd, kind="stable")
        begin = np.empty(len(texts), dtype=np.int64)
        begin[order] = np.cumsum(count[order]) - count[order]
        ids = np.concatenate(flat)[_ranges(begin, count)]
        self.ids = np.concatenate([self.ids, ids])
        self.bounds = np.concatenate([self.bounds, self.bounds[-1] + np.cumsum(count)])
        self.held += len(ids)
        self.new = []

    def _each(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids of each) of texts, each encoded by itself."""
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        count = np.array([len(x) for x in found], dtype=np.int64)
        return np.fromiter((i for x in found for i in x), np.uint32, int(count.sum())), count

    def _together(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same of units that are one pre-token each, many in one text."""
        tokenizer, letters, ends = self.plain
        lines = [codecs.charmap_decode(" ".join(units[i:i + 128]).encode(), "strict", letters)[0]
                 for i in range(0, len(units), 128)]
        found = [np.array(e.ids, dtype=np.uint32)
                 for e in tokenizer.encode_batch_fast(lines, add_special_tokens=False)]
        ids = np.concatenate(found)
        last = np.flatnonzero(ends[ids])
        if len(last) != len(units):                      # not told apart by their ends
            return self._each(units)
        return ids, np.diff(last, prepend=-1)

    def _numbers(self, texts: list[str]) -> list[np.ndarray]:
        """The numbers of each text's units."""
        odd: list[str] = []

        def safe(word: re.Match) -> str:
            if _SAFE.fullmatch(word[0]):
                return word[0]
            odd.append(word[0])
            return _ODD
        texts = [t if _SAFE.fullmatch(t) else _WORD.sub(safe, t) for t in texts]
        sizes = np.array([len(t) + 1 for t in texts], dtype=np.int64)
        # blanks before, between and after; as many as a key has bytes at the end
        raw = (" " + " ".join(texts).lower() + " " * 8).encode("latin-1")
        kind = np.frombuffer(raw.translate(_KINDS), dtype=np.uint8)
        edge = kind[1:] != kind[:-1]
        edge |= kind[1:] == _SINGLE
        edge = np.flatnonzero(edge) + 1
        unit = np.flatnonzero(kind[edge])
        start, stop = edge[unit], edge[unit + 1]
        number = self.__getitem__
        out = np.empty(len(start), dtype=np.int64)
        short = stop - start <= 8
        at = start[short]
        heads = np.ndarray(len(raw) - 7, dtype="<u8", buffer=raw, strides=(1,))
        keys, where = np.unique(heads[at] & _HEAD[stop[short] - at], return_inverse=True)
        keys = keys.tolist()
        if keys and keys[0] == 0:                        # odd words, looked up below
            out[short] = np.array([-1, *map(number, keys[1:])], dtype=np.int64)[where]
        else:
            out[short] = np.array([*map(number, keys)], dtype=np.int64)[where]
        out[~short] = [number(raw[a:b]) for a, b in
                       zip(start[~short].tolist(), stop[~short].tolist())]
        if odd:
            out[out < 0] = [number(word) for word in odd]
        return np.split(out, np.searchsorted(start, 1 + np.cumsum(sizes)[:-1]))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of a few texts, about BLOCK characters together."""
        if self.held > MEMORY:
            self.reset()
        plan = self._numbers(texts)
        if self.new:
            self._learn()
        out = []
        for units in plan:
            lo = self.bounds[units]
            out.append(self.ids[_ranges(lo, self.bounds[units + 1] - lo)])
        return out


def _ranges(lo: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The ``n`` numbers from each ``lo`` on, one after the other."""
    ends = np.cumsum(n)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(lo - (ends - n), n)


@functools.lru_cache(maxsize=2)
def units_of(path: str) -> Units:
    return Units(path)


def blocks_of(text: str, size: int = BLOCK):
    """``text`` in parts of about ``size`` characters, cut at white space."""
    lo = 0
    while len(text) - lo > size:
        at = re.compile(r"[\t-\r ]").search(text, lo + size)
        if not at:
            break
        yield text[lo:at.start()]
        lo = at.end()
    yield text[lo:] if lo else text


def encode_texts(units: Units, texts: list[str]):
    """(position, ids) of each text in turn; short texts are encoded together."""
    lo, size = 0, 0
    for i in range(len(texts) + 1):
        if i < len(texts) and len(texts[i]) < BLOCK:
            size += len(texts[i])
            if size < BLOCK:
                continue
            yield from enumerate(units.encode(texts[lo:i + 1]), lo)
            lo, size = i + 1, 0
            continue
        yield from enumerate(units.encode(texts[lo:i]), lo) if i > lo else ()
        if i < len(texts):
            yield i, np.concatenate([units.encode([b])[0] for b in blocks_of(texts[i])])
        lo, size = i + 1, 0


def piece_lengths(tokens: int, window: int) -> list[int]:
    """Whole windows, then the rest in pieces of at most a quarter of a window:
    windows of several small pieces come out more equal."""
    rest, quarter = tokens % window, max(1, window // 4)
    out = [window] * (tokens // window) + [quarter] * (rest // quarter)
    return out + [rest % quarter] * (rest % quarter > 0)


class _Differencing:
    """Partitions as sorted imbalances over the slots that hold pieces, and a
    forest that remembers which partial windows were joined."""

    def __init__(self, sizes: np.ndarray, k: int):
        n = len(sizes)
        self.k, self.sizes = k, sizes
        self.left, self.right = [], []
        # (imbalance, order, sums of the used slots descending, their trees)
        self.heap = [(-int(s), i, np.array([s]), np.array([i])) for i, s in enumerate(sizes)]
        heapq.heapify(self.heap)
        self.order = n
        while len(self.heap) > 1:
            self._merge(heapq.heappop(self.heap), heapq.heappop(self.heap))

    def _merge(self, a, b) -> None:
        (_, _, x, p), (_, _, y, q) = a, b
        both = len(x) + len(y) - self.k                  # slots that meet
        if both > 0:                                     # largest of one, smallest of the other
            alone = len(x) - both
            node = len(self.sizes) + len(self.left)
            self.left += p[alone:].tolist()
            self.right += q[::-1][:both].tolist()
            sums = np.concatenate([x[:alone], x[alone:] + y[::-1][:both], y[:len(y) - both]])
            tree = np.concatenate([p[:alone], np.arange(node, node + both), q[:len(y) - both]])
        else:
            sums, tree = np.concatenate([x, y]), np.concatenate([p, q])
        by = np.argsort(-sums, kind="stable")
        sums, tree = sums[by], tree[by]
        if len(sums) == self.k:
            sums = sums - sums[-1]
        low = sums[-1] if len(sums) == self.k else 0
        heapq.heappush(self.heap, (-int(sums[0] - low), self.order, sums, tree))
        self.order += 1

    def windows(self) -> np.ndarray:
        """The window of each piece."""
        n = len(self.sizes)
        out = np.full(n + len(self.left), -1, dtype=np.int64)
        trees = self.heap[0][3]
        out[trees] = np.arange(len(trees))
        for i in range(len(self.left) - 1, -1, -1):      # children are older than their join
            out[self.left[i]] = out[self.right[i]] = out[n + i]
        return out[:n]


def pack(sizes: np.ndarray, window: int) -> np.ndarray:
    """The window number of each piece size (at most ``window`` each), no window
    holding more than ``window``."""
    sizes = np.asarray(sizes, dtype=np.int64)
    out = np.empty(len(sizes), dtype=np.int64)
    full = sizes == window
    rest = np.flatnonzero(~full)
    k = 0
    if len(rest):
        k = max(1, -int(-sizes[rest].sum() // window))
        while True:
            found = _Differencing(sizes[rest], k).windows()
            over = np.bincount(found, weights=sizes[rest], minlength=k) - window
            if (over <= 0).all():
                break
            k += max(1, -int(-over[over > 0].sum() // window))
        out[rest] = found
    out[full] = k + np.arange(int(full.sum()))
    return out


def _pieces(docs: DataFrame, path: str, window: int, end_id: int, keep_ids: bool) -> DataFrame:
    def run(batches):
        units = units_of(path)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            rows, held = [], 0
            for i, ids in encode_texts(units, texts):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                start = 0
                for n in piece_lengths(len(ids), window):
                    part = ids[start:start + n]
                    rows.append((i, start, n, zlib.crc32(part.tobytes()), len(ids),
                                 part.astype(np.int32) if keep_ids else None))
                    start += n
                held += len(ids) * keep_ids + 1
                if held >= 1 << 20:
                    yield _piece_batch(batch, rows, keep_ids)
                    rows, held = [], 0
            if rows:
                yield _piece_batch(batch, rows, keep_ids)
    return map_arrow(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                    F.col("text").cast("string").alias("text")), run,
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
        + ", ids array<int>" * keep_ids)


_NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]


def _piece_batch(batch: pa.RecordBatch, rows: list[tuple], keep_ids: bool) -> pa.RecordBatch:
    at, *columns = zip(*rows)
    arrays = [batch.column("doc_id").take(pa.array(at, pa.int64()))]
    arrays += [pa.array(c, pa.int64()) for c in columns[:4]]
    if keep_ids:
        arrays.append(pa.array(list(columns[4]), pa.list_(pa.int32())))
    return pa.RecordBatch.from_arrays(arrays, _NAMES + ["ids"] * keep_ids)


def _packed(pieces: DataFrame, window: int, keep_ids: bool) -> DataFrame:
    """Sequence and offset of each piece; ``pieces`` has whole groups per
    partition, sorted by group and row."""
    names = _NAMES + ["ids"] * keep_ids

    def solve(group: int, table: pa.Table):
        sizes = table.column("length").to_numpy()
        number = pack(sizes, window)
        by = np.argsort(number, kind="stable")
        ends = np.cumsum(sizes[by])
        first = np.r_[True, number[by][1:] != number[by][:-1]]
        begin = (ends - sizes[by])[first]
        offset = np.empty(len(sizes), dtype=np.int64)
        offset[by] = ends - sizes[by] - np.repeat(begin, np.diff(np.r_[np.flatnonzero(first),
                                                                       len(by)]))
        out = table.select(names).append_column("sequence_id", pa.array(
            (np.int64(group) << 32) + number)).append_column("offset", pa.array(offset))
        yield from out.combine_chunks().to_batches(max_chunksize=1 << 14)

    def run(batches):
        held: list[pa.RecordBatch] = []
        current = None
        for batch in batches:
            group = batch.column("group").to_numpy()
            cuts = [0, *(np.flatnonzero(group[1:] != group[:-1]) + 1).tolist(), len(group)]
            for lo, hi in zip(cuts, cuts[1:]):
                if lo == hi:
                    continue
                if held and group[lo] != current:
                    yield from solve(current, pa.Table.from_batches(held))
                    held = []
                current = int(group[lo])
                held.append(batch.slice(lo, hi - lo))
        if held:
            yield from solve(current, pa.Table.from_batches(held))
    return map_arrow(pieces, run,
                     "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
                     + ", ids array<int>" * keep_ids + ", sequence_id long, offset long")


def pack_documents(docs: DataFrame, vocabulary: str | None = None, window: int = 4096,
                   end_id: int = 2, group: int = GROUP, keep_ids: bool = False) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens[, ids], sequence_id,
    offset), one row for each piece of each row of ``docs``.

    A document is its ids by the tokenizer file ``vocabulary`` (a path that
    every executor can read) and then ``end_id``.  It is cut into whole windows
    and a rest in pieces of at most a quarter of a window.  ``offset`` is a piece's place in its
    sequence; a sequence holds at most ``window`` ids.  Null and empty texts are
    documents of ``end_id`` alone; equal and repeated rows are packed each for
    itself; null doc_ids stay null; an empty table gives no rows; only
    ``doc_id`` and ``text`` are read.  Texts of any length are tokenized in
    blocks cut at white space (a run without white space is one block).
    """
    if window < 2:
        raise ValueError("window must be 2 or more")
    path = vocabulary or default_vocabulary()
    # kept in the shared folder: a piece's number, and so its group, is fixed by it
    pieces = cut(_pieces(docs, path, window, end_id, keep_ids).withColumn(
        "row", F.monotonically_increasing_id()))
    groups = max(1, -(-pieces.count() // group))
    spark = docs.sparkSession
    dealt = (pieces.withColumn("group", F.pmod(F.xxhash64("row"), F.lit(groups)))
             .repartition(max(1, min(groups, partitions(spark))), "group")
             .sortWithinPartitions("group", "row"))
    return _packed(dealt, window, keep_ids)
