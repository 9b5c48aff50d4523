"""Operator 3: secret scan with one combined deterministic automaton.

The rules' regexes are compiled to one nondeterministic automaton over bytes,
made deterministic by subset construction (restarting at every byte) and
minimised; the result is a transition array over byte classes and, for each
state, the set of rules that end there.  One pass over the bytes of a batch
finds every end of every rule: the batch is cut into lanes at document bounds
and at bytes that lead every state back to the start, and all lanes step
together.  Where a rule ends, its own automaton gives the spans: leftmost, then
longest, without overlaps within a kind.
"""

from __future__ import annotations

import array
import functools
import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimflow.llm import textkit as tk
from dimflow.llm.common import map_arrow


@dataclass(frozen=True)
class Rule:
    """``lead + body`` finds a span; spans whose part after the longest lead is
    shorter than ``least`` bytes are dropped (their bytes stay used)."""
    kind: str
    lead: str
    body: str
    least: int = 1


def either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c.lower()}]" if c.isalpha() else c for c in word)


_WORDS = "|".join(either_case(w) for w in ("password", "passwd", "secret", "token", "api_?key"))

#: The first three are the base kinds; the others are well-known public formats.
RULES = (
    Rule("assign", f"({_WORDS})[\"']?\\x20*[:=]\\x20*[\"']?", "[A-Za-z0-9+/_.=-]+", 6),
    Rule("access", "", "AKIA[A-Z0-9]+", 20),
    Rule("hex", "", "[0-9a-f]{24,}", 24),
    Rule("private_key", "", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("code_host", "gh[pousr]_", "[A-Za-z0-9]+", 36),
    Rule("chat", "xox[abprs]-", "[A-Za-z0-9-]+", 10),
    Rule("map_key", "AIza", "[A-Za-z0-9_-]+", 35),
    Rule("signed_token", "eyJ", "[A-Za-z0-9_-]+\\.[A-Za-z0-9_-]+\\.[A-Za-z0-9_-]+", 20),
)
BASE = ("assign", "access", "hex")


class _Nfa:
    """Thompson construction of a regex of literals, classes, groups,
    alternatives and the repeats ? * + {m} {m,} {m,n} over bytes."""

    def __init__(self):
        self.empty: list[list[int]] = []
        self.moves: list[tuple[frozenset[int], int] | None] = []

    def state(self) -> int:
        self.empty.append([])
        self.moves.append(None)
        return len(self.empty) - 1

    def add(self, regex: str) -> tuple[int, int]:
        tree, at = self._alternatives(regex, 0)
        if at != len(regex):
            raise ValueError(f"unbalanced regex at {at}: {regex}")
        return self._build(tree)

    def _alternatives(self, s: str, i: int):
        options = []
        while True:
            items = []
            while i < len(s) and s[i] not in "|)":
                atom, i = self._atom(s, i)
                if i < len(s) and s[i] in "?*+{":
                    if s[i] == "{":
                        j = s.index("}", i)
                        lo, _, hi = s[i + 1:j].partition(",")
                        times = int(lo), int(hi or lo) if "," not in s[i:j] or hi else None
                        i = j + 1
                    else:
                        times = {"?": (0, 1), "*": (0, None), "+": (1, None)}[s[i]]
                        i += 1
                    atom = ("repeat", atom, *times)
                items.append(atom)
            options.append(("all", items))
            if i < len(s) and s[i] == "|":
                i += 1
                continue
            return ("any", options), i

    def _atom(self, s: str, i: int):
        if s[i] == "(":
            tree, j = self._alternatives(s, i + 1)
            if j >= len(s) or s[j] != ")":
                raise ValueError(f"unbalanced regex: {s}")
            return tree, j + 1
        if s[i] == "[":
            members, i = set(), i + 1
            while s[i] != "]":
                lo, i = self._char(s, i)
                hi = lo
                if s[i] == "-" and s[i + 1] != "]":
                    hi, i = self._char(s, i + 1)
                members.update(range(lo, hi + 1))
            return ("one", frozenset(members)), i + 1
        c, i = self._char(s, i)
        return ("one", frozenset([c])), i

    @staticmethod
    def _char(s: str, i: int) -> tuple[int, int]:
        if s[i] != "\\":
            return ord(s[i]), i + 1
        if s[i + 1] == "x":
            return int(s[i + 2:i + 4], 16), i + 4
        return ord(s[i + 1]), i + 2

    def _build(self, tree) -> tuple[int, int]:
        start, end = self.state(), self.state()
        if tree[0] == "one":
            self.moves[start] = (tree[1], end)
        elif tree[0] == "all":
            at = start
            for item in tree[1]:
                a, b = self._build(item)
                self.empty[at].append(a)
                at = b
            self.empty[at].append(end)
        elif tree[0] == "any":
            for option in tree[1]:
                a, b = self._build(option)
                self.empty[start].append(a)
                self.empty[b].append(end)
        else:
            _, item, lo, hi = tree
            at = start
            for _ in range(lo):
                a, b = self._build(item)
                self.empty[at].append(a)
                at = b
            if hi is None:
                a, b = self._build(item)
                self.empty[at] += [a, end]
                self.empty[b] += [a, end]
            else:
                self.empty[at].append(end)
                for _ in range(hi - lo):
                    a, b = self._build(item)
                    self.empty[at].append(a)
                    self.empty[b].append(end)
                    at = b
        return start, end

    def closure(self, states) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for t in self.empty[todo.pop()]:
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        return frozenset(seen)


@dataclass(frozen=True)
class Dfa:
    """``table[state, cls[byte]]`` is the next state (0: start or, if anchored,
    state 1 is the start and 0 is dead); ``ends[state]``: bit per rule."""
    table: np.ndarray
    cls: np.ndarray
    ends: np.ndarray


def compile_dfa(regexes: tuple[str, ...], anchored: bool) -> Dfa:
    """Subset construction and minimisation (partition refinement)."""
    nfa = _Nfa()
    bounds = [nfa.add(r) for r in regexes]
    rule_of = {end: i for i, (_, end) in enumerate(bounds)}
    sets = {m[0] for m in nfa.moves if m}
    signature = [tuple(b in s for s in sets) for b in range(256)]
    names = {sig: i for i, sig in enumerate(dict.fromkeys(signature))}
    cls = np.array([names[sig] for sig in signature])
    sample = [signature.index(sig) for sig in names]
    begin = nfa.closure([a for a, _ in bounds])
    # only states with a move or an end matter to what comes next
    useful = {s for s in range(len(nfa.moves)) if nfa.moves[s] or s in rule_of}
    known: dict[frozenset[int], int] = {}
    order: list[frozenset[int]] = []

    def number(states: frozenset[int]) -> int:
        key = frozenset(states & useful)
        if key not in known:
            known[key] = len(order)
            order.append(key)
        return known[key]
    if anchored:
        number(frozenset())
    number(begin)
    closures: dict[int, frozenset[int]] = {}
    rows, i = [], 0
    while i < len(order):
        row = []
        for byte in sample:
            out = set() if anchored else set(begin)
            for s in order[i]:
                move = nfa.moves[s]
                if move and byte in move[0]:
                    if move[1] not in closures:
                        closures[move[1]] = nfa.closure([move[1]])
                    out |= closures[move[1]]
            row.append(number(frozenset(out)))
        rows.append(row)
        i += 1
    table = np.array(rows)
    ends = np.array([sum(1 << rule_of[s] for s in states if s in rule_of) for states in order])
    block = np.unique(ends, return_inverse=True)[1]
    while True:
        key = np.column_stack([block, block[table]])
        finer = np.unique(key, axis=0, return_inverse=True)[1].ravel()
        if finer.max() == block.max():
            break
        block = finer
    first = np.unique(block, return_index=True)[1]
    rank = {int(block[s]): r for r, s in enumerate(sorted(first))}     # keeps 0 (and 1) first
    renumber = np.array([rank[int(b)] for b in block])
    reps = np.sort(first)
    return Dfa(renumber[table[reps]], cls, ends[reps])


@functools.lru_cache(maxsize=None)
def automata(rules: tuple[Rule, ...]):
    """(combined automaton, per rule: its anchored automaton, its lead's, and
    which bytes it can read)."""
    own = []
    for r in rules:
        whole = compile_dfa((r.lead + r.body,), True)
        lead = compile_dfa((r.lead,), True) if r.lead else None
        alphabet = (whole.table != 0).any(axis=0)[whole.cls]
        own.append((whole, lead, alphabet))
    # An end of the shortest match is an end: a last repeat need not be followed.
    short = (r.lead + re.sub(r"\+$|(\{\d+),\}$", lambda m: m[1] + "}" if m[1] else "", r.body)
             for r in rules)
    return compile_dfa(tuple(short), False), own


class _Ahead:
    """The automaton read backwards, its subsets built as texts ask for them.
    Subset s tells from which states a match can still end in the bytes ahead
    (``live[s][state]``); subset 0 holds where no byte is left."""

    def __init__(self, table: np.ndarray, ends: np.ndarray):
        self.table, self.ends = table, ends > 0
        self.live = [self.ends.tobytes()]
        self.number = {self.live[0]: 0}
        self.moves: list[dict[int, int]] = [{}]

    def _move(self, s: int, byte: int) -> int:
        before = np.frombuffer(self.live[s], dtype=bool)
        now = (before[self.table[:, byte]] | self.ends).tobytes()
        out = self.number.setdefault(now, len(self.live))
        if out == len(self.live):
            self.live.append(now)
            self.moves.append({})
        self.moves[s][byte] = out
        return out

    def subsets(self, data: bytes) -> np.ndarray:
        """The subset at each place of ``data`` and at its end, in one pass."""
        out = array.array("i", bytes(4 * (len(data) + 1)))
        s, moves = 0, self.moves
        for i in range(len(data) - 1, -1, -1):
            byte = data[i]
            nxt = moves[s].get(byte)
            s = out[i] = self._move(s, byte) if nxt is None else nxt
        return np.frombuffer(out, dtype=np.int32)


class Scanner:
    """Tables of the rules, ready for byte passes."""

    def __init__(self, rules: tuple[Rule, ...] = RULES):
        self.rules = rules
        both, own = automata(rules)
        k = both.table.shape[1]
        self.k = k
        self.flat = (both.table * k).ravel().astype(np.int64)
        self.cls = both.cls.astype(np.int64)
        self.ends = np.repeat(both.ends, k)
        self.reset = (both.table == 0).all(axis=0)[both.cls]
        self.reset[0xFF] = True
        self.own = [((w.table[:, w.cls]).tolist(),
                     (l.table[:, l.cls]).tolist() if l else None, l.ends.tolist() if l else None,
                     a) for w, l, a in own]
        self.ahead = [_Ahead(w.table[:, w.cls], w.ends) for w, _, _ in own]

    def hits(self, texts: tk.Texts) -> dict[int, int]:
        """{document: rules that end somewhere in it}, from one pass."""
        n = len(texts)
        buf = np.insert(texts.data, texts.offsets[1:], 0xFF)
        offs = texts.offsets + np.arange(n + 1)
        total = len(buf)
        safe = np.unique(np.concatenate([np.flatnonzero(self.reset[buf]) + 1, offs]))
        want = np.arange(0, total, max(1024, total // 1024))
        lo = np.unique(safe[np.searchsorted(safe, want)])
        lo = np.unique(np.concatenate([[0], lo[lo < total]]))
        length = np.diff(np.concatenate([lo, [total]]))
        order = np.argsort(-length, kind="stable")
        lo, length = lo[order], length[order]
        classes = self.cls[buf]
        state = np.zeros(len(lo), dtype=np.int64)
        found: dict[int, int] = {}
        step, width = 0, len(lo)
        while step < length[0]:
            width = int(np.searchsorted(-length, -step))          # lanes longer than step
            until = min(int(length[width - 1]), step + 1024)       # all of them reach here
            idx = lo[:width] + np.arange(step, until)[:, None]
            rows = classes[idx]
            states = np.empty(rows.shape, dtype=np.int64)
            now = state[:width]
            for i in range(until - step):
                now = self.flat.take(now + rows[i])
                states[i] = now
            state = now
            ended = self.ends.take(states)
            at = np.flatnonzero(ended)
            if len(at):
                docs = np.searchsorted(offs, idx.ravel()[at], side="right") - 1
                for d, mask in zip(docs.tolist(), ended.ravel()[at].tolist()):
                    found[d] = found.get(d, 0) | mask
            step = until
        return found

    def spans(self, data: bytes, mask: int) -> list[tuple[int, int, int]]:
        """(start, rule, end) byte spans of the rules in ``mask``, by start."""
        out = []
        raw = np.frombuffer(data, dtype=np.uint8)
        for r, rule in enumerate(self.rules):
            if mask >> r & 1:
                out += [(s, r, e) for s, e in self._rule_spans(data, raw, r, rule.least)]
        return sorted(out)

    def _rule_spans(self, data: bytes, raw: np.ndarray, r: int, least: int):
        """Leftmost longest matches of rule r.  A pass from behind tells where a
        match begins and how far it goes on, so no byte is tried in vain and the
        time is in proportion to the text."""
        table, lead, lead_ends, alphabet = self.own[r]
        inside = np.concatenate([[False], alphabet[raw], [False]])
        edge = np.flatnonzero(inside[1:] != inside[:-1])
        ahead = self.ahead[r]
        for lo, hi in zip(edge[::2].tolist(), edge[1::2].tolist()):
            subset = ahead.subsets(data[lo:hi])
            live = ahead.live
            begins = np.frombuffer(bytes(x[1] for x in live), dtype=bool)[subset]
            subset, pos = subset.tolist(), lo
            for begin in (np.flatnonzero(begins) + lo).tolist():
                if begin < pos:                          # inside the match before
                    continue
                pos = end = begin
                state = 1
                while end < hi:                          # on as long as a match ends ahead
                    nxt = table[state][data[end]]
                    if not live[subset[end + 1 - lo]][nxt]:
                        break
                    state, end = nxt, end + 1
                value = pos
                if lead:
                    state = 1
                    for i in range(pos, end):
                        state = lead[state][data[i]]
                        if not state:
                            break
                        if lead_ends[state]:
                            value = i + 1
                if end - value >= least:
                    yield pos, end
                pos = end


def _scan(column: pa.Array, scanner: Scanner) -> Iterator[tuple[int, bytes, list]]:
    """(row, text bytes, spans) of the rows in which a rule ends."""
    for texts in tk.texts_of(column):
        for d, mask in sorted(scanner.hits(texts).items()):
            data = texts.data[texts.offsets[d]:texts.offsets[d + 1]].tobytes()
            spans = scanner.spans(data, mask)
            if spans:
                yield texts.first + d, data, spans


def _points(data: bytes, spans) -> list[tuple[int, int, int]]:
    """Byte spans as code-point spans."""
    if data.isascii():
        return spans
    lead = np.concatenate([[0], np.cumsum(
        (np.frombuffer(data, dtype=np.uint8) & 0xC0) != 0x80)])
    return [(int(lead[s]), r, int(lead[e])) for s, r, e in spans]


def scan_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_spans) per row.

    ``spans`` lists kind:start:end (code points, end exclusive) by start, then
    in the order of the rules; ``base_sha256`` digests those of the base kinds.
    Null and empty texts have no spans (the digest of the empty string).  Spans
    of different kinds may overlap.  Repeated rows each give their row, an empty
    table none.  Only ``doc_id`` and ``text`` are read.
    """
    scanner = Scanner(rules)
    kinds = [r.kind for r in rules]
    none = hashlib.sha256(b"").hexdigest()

    def run(batches):
        for batch in batches:
            n = batch.num_rows
            counts = np.zeros((n, len(kinds)), dtype=np.int64)
            digest, listed = [none] * n, [""] * n
            for row, data, spans in _scan(batch.column("text"), scanner):
                named = [(kinds[r], f"{kinds[r]}:{s}:{e}") for s, r, e in _points(data, spans)]
                for _, r, _ in spans:
                    counts[row, r] += 1
                base = ",".join(t for k, t in named if k in BASE)
                digest[row] = hashlib.sha256(base.encode()).hexdigest()
                listed[row] = ",".join(t for _, t in named)
            if n:
                base = [pa.array(counts[:, kinds.index(k)] if k in kinds else counts[:, 0] * 0)
                        for k in BASE]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), *base, pa.array(digest), pa.array(listed),
                     pa.array(counts.sum(axis=1))],
                    ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_spans"])
    return map_arrow(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                    F.col("text").cast("string").alias("text")), run,
        "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, "
        "spans string, n_spans long")


def redact_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES,
                   mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span of ``text`` (overlapping ones together) replaced
    by ``mark``, and ``n_chars``, if there, counted anew in changed rows.  All
    rows and other columns stay; a null text stays null."""
    scanner = Scanner(rules)
    at = docs.columns.index("text")
    size = docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def run(batches):
        for batch in batches:
            changed: dict[int, str] = {}
            for row, data, spans in _scan(batch.column(at), scanner):
                out, pos = [], 0
                for s, _, e in spans:
                    if s >= pos:
                        out += [data[pos:s], mark.encode()]
                    pos = max(pos, e)
                changed[row] = b"".join([*out, data[pos:]]).decode()
            if changed:
                columns = list(batch.columns)
                rows = pa.array(sorted(changed), pa.int64())
                texts = [changed[r] for r in sorted(changed)]
                columns[at] = _put(columns[at], rows, pa.array(texts, columns[at].type))
                if size is not None:
                    columns[size] = _put(columns[size], rows, pa.array(
                        [len(t) for t in texts]).cast(columns[size].type))
                batch = pa.RecordBatch.from_arrays(columns, schema=batch.schema)
            yield batch
    return map_arrow(docs, run, docs.schema)


def _put(column: pa.Array, rows: pa.Array, values: pa.Array) -> pa.Array:
    mask = np.zeros(len(column), dtype=bool)
    mask[rows.to_numpy()] = True
    return pa.compute.replace_with_mask(column, pa.array(mask), values)
