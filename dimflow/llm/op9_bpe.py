"""Operator 9: byte-level BPE by speculation and verification.

The text is split as the tokenizer's pre-tokenizer does.  For each distinct
word, greedy longest match over the vocabulary proposes tokens.  A sequence of
tokens is the BPE encoding exactly if every adjacent pair is compatible (the
pair's own text encodes to the pair); all pairs of all new words are tested
together with array operations, and only words with a failing pair are merged
exactly, rank by rank.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimflow.llm.common import map_arrow

#: Fixed pattern of the byte-level pre-tokenizer.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The same for ASCII texts, whose letters, digits and blanks are plain ranges.
ASCII_PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\t-\r A-Za-z0-9]+"
                 r"|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+")
#: Characters of distinct words (and 32 a word) that a worker remembers before it
#: starts anew (a matter of memory only; results do not depend on it).
MEMORY = 16_000_000
#: Characters of a text that are split into words at a time.
BLOCK = 1 << 20
_CUT = re.compile(r"(?<=[!-~]) (?=[!-~])")
_FAR = np.int64(1) << 40


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_letters() -> dict[str, int]:
    """Letters that byte-level vocabularies write for the 256 bytes: printable
    ones stand for themselves, the others follow from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in shown]
    return {**{chr(b): b for b in shown}, **{chr(256 + i): b for i, b in enumerate(rest)}}


class Bpe:
    """Vocabulary, merges and word memory of one worker process."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = _byte_letters()

        def raw(token: str) -> bytes:
            return bytes(letters[c] for c in token)
        vocab = spec["model"]["vocab"]
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.id_of = {raw(t): i for t, i in vocab.items() if t not in self.specials}
        size = 1 + max([*self.id_of.values(), *self.specials.values()])
        self.bytes_of: list[bytes] = [b""] * size
        for t, i in self.id_of.items():
            self.bytes_of[i] = t
        for t, i in self.specials.items():
            self.bytes_of[i] = t.encode()
        # longest token for each beginning of three bytes
        self.reach: dict[bytes, int] = {}
        for t in self.id_of:
            self.reach[t[:3]] = max(self.reach.get(t[:3], 0), len(t))
        self.rank: dict[tuple[int, int], tuple[int, int]] = {}
        self.left = np.full(size, -1, dtype=np.int64)
        self.right = np.full(size, -1, dtype=np.int64)
        self.formed = np.full(size, -1, dtype=np.int64)       # rank at which a token forms
        keys, ranks, wholes = [], [], []
        for r, pair in enumerate(spec["model"]["merges"]):
            a, b = (raw(x) for x in (pair.split(" ") if isinstance(pair, str) else pair))
            ia, ib, whole = self.id_of[a], self.id_of[b], self.id_of[a + b]
            if (ia, ib) in self.rank:
                continue
            self.rank[ia, ib] = (r, whole)
            keys.append(ia << 32 | ib)
            ranks.append(r)
            wholes.append(whole)
            if self.formed[whole] < 0:
                self.left[whole], self.right[whole], self.formed[whole] = ia, ib, r
        order = np.argsort(keys)
        self.keys = np.array(keys, dtype=np.int64)[order]
        self.ranks = np.array(ranks, dtype=np.int64)[order]
        self.wholes = np.array(wholes, dtype=np.int64)[order]
        self.byte_ids = np.array([self.id_of[bytes([b])] for b in range(256)], dtype=np.int64)
        self.sound: dict[bytes, bool] = {}
        self.split, self.split_ascii = regex.compile(PATTERN), re.compile(ASCII_PATTERN)
        self.special_split = regex.compile(
            "(" + "|".join(regex.escape(s) for s in sorted(self.specials, key=len, reverse=True))
            + ")") if self.specials else None
        self.index = _Index()
        self.reset()

    def reset(self) -> None:
        self.index.clear()
        self.ids = np.empty(0, dtype=np.uint32)
        self.cut = np.zeros(1, dtype=np.int64)

    def merge(self, word: bytes) -> list[int]:
        """Exact encoding of one word: the pair of lowest rank first, leftmost
        among equals."""
        parts = [self.id_of[word[i:i + 1]] for i in range(len(word))]
        if len(parts) > 64:
            return self._merge_long(parts)
        while len(parts) > 1:
            best = min((self.rank.get(p, (_FAR, 0))[0], i)
                       for i, p in enumerate(zip(parts, parts[1:])))
            if best[0] == _FAR:
                break
            i = best[1]
            parts[i:i + 2] = [self.rank[parts[i], parts[i + 1]][1]]
        return parts

    def merge_many(self, words: list[bytes]) -> list[list[int]]:
        """``merge`` of many words: all of about one length go step by step
        together, each step merging the best pair of each word."""
        out: list = [None] * len(words)
        size = np.array([len(w) for w in words])
        for lo, hi in ((0, 8), (8, 12), (12, 20), (20, 40)):
            rows = np.flatnonzero((size > lo) & (size <= hi))
            for i in range(0, len(rows), 20_000):
                part = rows[i:i + 20_000]
                for r, t in zip(part.tolist(), self._merge_block([words[r] for r in part])):
                    out[r] = t
        for r in np.flatnonzero(size > 40):
            out[r] = self.merge(words[r])
        return out

    def _lookup(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = a << 32 | b
        k = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = (self.keys[k] == key) & (a >= 0) & (b >= 0)
        return np.where(hit, self.ranks[k], _FAR), np.where(hit, self.wholes[k], -1)

    def _merge_block(self, words: list[bytes]) -> list[list[int]]:
        n, width = len(words), max(map(len, words)) + 1
        raw = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), dtype=np.uint8)
        length = np.array([len(w) for w in words])
        tokens = np.where(np.arange(width) < length[:, None],
                          self.byte_ids[raw.reshape(n, width)], -1)
        rank, whole = self._lookup(tokens[:, :-1].ravel(), tokens[:, 1:].ravel())
        rank = np.column_stack([rank.reshape(n, width - 1), np.full(n, _FAR)])
        whole = np.column_stack([whole.reshape(n, width - 1), np.full(n, -1)])
        done = np.full((n, width), -1, dtype=np.int64)
        at, cols = np.arange(n), np.arange(width)
        while len(at):
            best = rank.argmin(axis=1)
            rows = np.arange(len(at))
            live = rank[rows, best] < _FAR
            done[at[~live]] = tokens[~live]
            at, tokens, rank, whole, best = (x[live] for x in (at, tokens, rank, whole, best))
            rows = np.arange(len(at))
            new = whole[rows, best]
            after = np.minimum(cols + (cols > best[:, None]), width - 1)
            tokens = np.take_along_axis(tokens, after, 1)
            rank = np.take_along_axis(rank, after, 1)
            whole = np.take_along_axis(whole, after, 1)
            tokens[:, -1], rank[:, -1], whole[:, -1] = -1, _FAR, -1
            tokens[rows, best] = new
            rank[rows, best], whole[rows, best] = self._lookup(
                new, tokens[rows, np.minimum(best + 1, width - 1)])
            back = best > 0
            rows, best = rows[back], best[back]
            rank[rows, best - 1], whole[rows, best - 1] = self._lookup(
                tokens[rows, best - 1], tokens[rows, best])
        return [t[:k] for t, k in zip(done.tolist(), (done >= 0).sum(axis=1).tolist())]

    def _merge_long(self, parts: list[int]) -> list[int]:
        """The same with a heap over a linked list, for long words."""
        import heapq
        n = len(parts)
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(self.rank[p][0], i, *p) for i, p in enumerate(zip(parts, parts[1:]))
                if p in self.rank]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = nxt[i] if parts[i] >= 0 else n
            if parts[i] != a or j >= n or parts[j] != b:
                continue
            parts[i], parts[j] = self.rank[a, b][1], -1
            nxt[i] = nxt[j]
            if nxt[i] < n:
                prv[nxt[i]] = i
            for x, y in ((prv[i], i), (i, nxt[i])):
                if x >= 0 and y < n and (parts[x], parts[y]) in self.rank:
                    heapq.heappush(heap, (self.rank[parts[x], parts[y]][0], x, parts[x], parts[y]))
        return [p for p in parts if p >= 0]

    def propose(self, word: bytes) -> list[int]:
        """Greedy longest match among tokens that encode to themselves."""
        out, i, n = [], 0, len(word)
        known, reach = self.id_of.get, self.reach.get
        while i < n:
            for j in range(min(n, i + reach(word[i:i + 3], 2)), i, -1):
                piece = word[i:j]
                token = known(piece)
                if token is not None:
                    ok = self.sound.get(piece)
                    if ok is None:
                        ok = self.sound[piece] = self.merge(piece) == [token]
                    if ok:
                        break
            out.append(token)
            i = j
        return out

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For each pair of tokens, whether their joined text encodes to the
        pair: going back in time, the pieces that touch at the border (the last
        of a, the first of b) must never be a pair that merges before one of
        them is merged away."""
        ok = np.ones(len(a), dtype=bool)
        at = np.arange(len(a))
        a, b = a.astype(np.int64), b.astype(np.int64)
        gone_a = np.full(len(a), _FAR)       # rank at which the piece is merged away
        gone_b = np.full(len(a), _FAR)
        while len(at):
            key = a << 32 | b
            k = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            r = np.where(self.keys[k] == key, self.ranks[k], _FAR)
            # of equal ranks the left pair goes first: a's own merge wins, b's loses
            bad = (r < _FAR) & (r < gone_a) & (r <= gone_b)
            ok[at[bad]] = False
            fa, fb = self.formed[a], self.formed[b]
            live = ~bad & ((fa >= 0) | (fb >= 0))
            at, a, b, gone_a, gone_b, fa, fb = (x[live] for x in
                                                (at, a, b, gone_a, gone_b, fa, fb))
            # undo the later merge; of equal ranks the right one was later
            undo_a = fa > fb
            gone_a, gone_b = np.where(undo_a, fa, gone_a), np.where(undo_a, gone_b, fb)
            a, b = np.where(undo_a, self.right[a], a), np.where(undo_a, b, self.left[b])
        return ok

    def learn(self) -> None:
        """Encode the words added to the index since the last call."""
        words = [w.encode() for w in self.index.fresh]
        self.index.fresh = []
        if not words:
            return
        tokens = [self.propose(w) for w in words]
        count = np.array([len(t) for t in tokens])
        flat = np.fromiter((x for t in tokens for x in t), np.int64, int(count.sum()))
        word = np.repeat(np.arange(len(words)), count)
        pairs = np.flatnonzero(word[1:] == word[:-1])
        key, inverse = np.unique(flat[pairs] << 32 | flat[pairs + 1], return_inverse=True)
        ok = self.compatible(key >> 32, key & 0xFFFFFFFF)[inverse]
        failed = np.unique(word[pairs[~ok]]).tolist()
        for i, t in zip(failed, self.merge_many([words[i] for i in failed])):
            tokens[i] = t
        count = np.array([len(t) for t in tokens])
        flat = np.fromiter((x for t in tokens for x in t), np.uint32, int(count.sum()))
        self.ids = np.concatenate([self.ids, flat])
        self.cut = np.concatenate([self.cut, self.cut[-1] + np.cumsum(count)])

    def encode_batch(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text as uint32 arrays."""
        if self.index.held > MEMORY:
            self.reset()
        number = self.index.__getitem__
        plan = []
        for text in texts:
            pieces = self.special_split.split(text) if self.special_split and any(
                s in text for s in self.specials) else [text]
            parts = []
            for i, piece in enumerate(pieces):
                if i % 2:
                    parts.append(self.specials[piece])
                else:
                    split = self.split_ascii if piece.isascii() else self.split
                    for block in _blocks(piece):
                        found = split.findall(block)
                        parts.append(np.fromiter(map(number, found), np.int64, len(found)))
            plan.append(parts)
        self.learn()
        return [np.concatenate([np.array([p], dtype=np.uint32) if isinstance(p, int)
                                else self._gather(p) for p in parts]) for parts in plan]

    def _gather(self, words: np.ndarray) -> np.ndarray:
        lo = self.cut[words]
        n = self.cut[words + 1] - lo
        ends = np.cumsum(n)
        total = int(ends[-1]) if len(ends) else 0
        return self.ids[np.arange(total) + np.repeat(lo - (ends - n), n)]

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist())).decode(
            "utf-8", errors="replace")


def _blocks(text: str, size: int = BLOCK):
    """``text`` in parts of about ``size`` characters, cut before a single blank
    between two other characters: a new word begins there in any case."""
    lo = 0
    while len(text) - lo > size:
        at = _CUT.search(text, lo + size)
        if not at:
            break
        yield text[lo:at.start()]
        lo = at.start()
    yield text[lo:] if lo else text


class _Index(dict):
    """Word -> number; new words are listed until they are learned."""

    def __init__(self):
        self.fresh: list[str] = []
        self.held = 0

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        self.fresh.append(word)
        self.held += len(word) + 32
        return n

    def clear(self) -> None:
        super().clear()
        self.__init__()


@functools.lru_cache(maxsize=2)
def tokenizer(path: str) -> Bpe:
    return Bpe(path)


def _pieces(texts: list[str], limit: int = 1 << 20):
    """Slices of about ``limit`` characters."""
    lo, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= limit:
            yield lo, i + 1
            lo, size = i + 1, 0
    if lo < len(texts):
        yield lo, len(texts)


def encode_documents(docs: DataFrame, vocabulary: str | None = None,
                     keep_ids: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256[, ids]) for every row.

    ``vocabulary`` is the path of a byte-level BPE file that every executor can
    read.  Special tokens written out in a text are read as such.  Null and
    empty texts have no tokens (digests of the empty string).  Repeated rows
    each give their row, an empty table none; only ``doc_id`` and ``text`` are
    read.  ``ids_sha256`` digests the ids as little-endian unsigned 32-bit
    integers, ``decoded_sha256`` the text decoded from them.
    """
    path = vocabulary or default_vocabulary()

    def run(batches):
        bpe = tokenizer(path)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for lo, hi in _pieces(texts):
                encoded = bpe.encode_batch(texts[lo:hi])
                columns = [
                    batch.column("doc_id").slice(lo, hi - lo),
                    pa.array([len(x) for x in encoded], pa.int64()),
                    pa.array([hashlib.sha256(x.astype("<u4").tobytes()).hexdigest()
                              for x in encoded]),
                    pa.array([hashlib.sha256(bpe.decode(x).encode()).hexdigest()
                              for x in encoded])]
                if keep_ids:
                    columns.append(pa.array([x.astype(np.int32) for x in encoded],
                                            pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(
                    columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256",
                              *["ids"] * keep_ids])
    return map_arrow(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                    F.col("text").cast("string").alias("text")), run,
        "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
        + ", ids array<int>" * keep_ids)
