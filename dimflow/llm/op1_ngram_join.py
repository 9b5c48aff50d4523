"""Operator 1: exact n-gram Jaccard join by universe partition and pigeonhole.

A document is the set of its distinct word shingles.  Two sets r, s reach
Jaccard t = num/den only if |r| + |s| - 2|r & s| <= H = floor((den - num) *
(|r| + |s|) / (den + num)).  Sets are banded by size; in a band the universe of
shingles is hashed into m segments, m - 1 being the largest H of the band.  If
a probing set gives segment i a value v_i (0: not probed, 1: equal subsets are
found, 2: subsets at most one deletion apart are found) and the values sum to
H + 1, each partner is found: otherwise every segment would differ by at least
v_i shingles.  Every set indexes the hash of each segment's subset, and the
one-deletion neighbourhood of POOL segments; each set probes its own band and
the one below with the cheapest values (``allocate``).  Candidate pairs are
verified on the whole sets.

Documents with equal sets are one node from the start.  In a bucket of up to
SMALL nodes all pairs are candidates; in larger ones each node is first paired
with the bucket's hub, and later with a node of another component, so a group
of near copies costs about its size.  What is then left of large buckets, pairs
in different components, is compared inside tasks by parity bitmaps: two sets'
bitmaps differ in at most |r - s| + |s - r| bits, so a pair that differs in more
than H bits cannot link, and only the others leave the task to be verified.
Components are exact: no pair in different components stays untested.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimflow.llm import textkit as tk
from dimflow.llm.common import components, cut, id_filter, map_arrow, maybe, partitions, slot_of

SUBSET, DELETED, PROBE, PROBE_TWO, PROBE_DELETED = 1, 2, 4, 8, 16
POOL = 2
SMALL = 8
#: Nodes of a block when what is left of a large bucket is compared in a task.
BLOCK = 4096
#: Cost model of the allocation: chance that a shingle of one set is in an
#: unrelated set.
SHARED = 0.05
_U = np.uint64


@functools.lru_cache(maxsize=None)
def _least_sizes(num: int, den: int, upto: int) -> np.ndarray:
    out = [1]
    while out[-1] <= upto:
        lo = out[-1] + 1
        while -(-num * lo // den) < out[-1]:
            lo += 1
        out.append(lo)
    return np.array(out)


def band_of(n: int, num: int, den: int) -> int:
    """Bands are as narrow as may be with each partner of a set in the set's
    own band or a neighbouring one."""
    return int(np.searchsorted(_least_sizes(num, den, 1 << n.bit_length()), n, side="right")) - 1


@functools.lru_cache(maxsize=None)
def layout(num: int, den: int, band: int) -> tuple[int, int, np.ndarray, np.uint64]:
    """(largest size, segments, a key for each segment, seed) of a band."""
    upto = 1
    while len(_least_sizes(num, den, upto)) < band + 2:
        upto *= 2
    hi = int(_least_sizes(num, den, upto)[band + 1]) - 1
    m = (den - num) * (hi + hi * den // num) // (den + num) + 1
    return hi, m, tk.mix(np.arange(m, dtype=_U) + _U(band << 32)), tk.mix_int(band + 1)


def allocate(counts: np.ndarray, need: int, pool: int) -> np.ndarray:
    """Cost-based values of the segments: 0, 1 or 2, their sum at least ``need``.

    The expected number of unrelated sets with a given subset falls by SHARED
    with each shingle in it, so the smallest subsets cost most.  Segments
    beyond ``need`` are dropped, dearest first; then a dear segment is traded
    for the one-deletion neighbourhood of a pool segment while that is cheaper.
    """
    m = len(counts)
    value = np.ones(m, dtype=np.int8)
    order = np.argsort(counts.astype(np.uint16) if counts.max() < 65536 else counts,
                       kind="stable")
    value[order[:m - need]] = 0
    rest = order[m - need:]
    taken = 0
    for i in range(min(pool, m)):
        c = int(counts[i])
        if taken >= len(rest) or value[i] != 1 or c < 2:
            continue
        dear = int(rest[taken])
        if dear == i or value[dear] != 1:
            break
        if SHARED ** int(counts[dear]) <= c * SHARED ** (c - 1):
            break
        value[dear], value[i] = 0, 2
        taken += 1
    return value


def signatures(u: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """(signature hashes, roles) of a set of shingle hashes."""
    n = len(u)
    own = band_of(n, num, den)
    sigs, roles = [], []
    with np.errstate(over="ignore"):
        content = tk.mix(u + _U(0x51ED270B0C6D8B1F))
        for band in (own, own - 1):
            if band < 0:
                continue
            hi, m, key, seed = layout(num, den, band)
            if band < own and -(-num * n // den) > hi:
                continue
            seg = ((tk.mix(u ^ seed) >> _U(32)) * _U(m) >> _U(32)).astype(
                np.uint16 if m < 65536 else np.int64)      # 16 bits: radix sort
            order = np.argsort(seg, kind="stable")
            counts = np.bincount(seg, minlength=m)
            total = np.concatenate([[_U(0)], np.cumsum(content[order], dtype=_U)])
            ends = np.cumsum(counts)
            sums = total[ends] - total[ends - counts]
            need = (den - num) * (n + min(n, hi)) // (den + num) + 1
            value = allocate(counts, min(need, m), POOL)
            sub = tk.mix(key ^ tk.mix(sums + counts.astype(_U)))
            role = np.where(value == 2, PROBE_TWO, np.where(value == 1, PROBE, 0))
            if band == own:
                role = role | SUBSET
            keep = role > 0
            sigs.append(sub[keep])
            roles.append(role[keep])
            for i in range(min(POOL, m)):
                r = (DELETED if band == own else 0) | (PROBE_DELETED if value[i] == 2 else 0)
                if r and counts[i]:
                    own_items = content[order[ends[i] - counts[i]:ends[i]]]
                    less = tk.mix(key[i] ^ tk.mix(sums[i] - own_items + _U(counts[i] - 1)))
                    sigs.append(less)
                    roles.append(np.full(len(less), r))
    return np.concatenate(sigs), np.concatenate(roles)


def set_node(u: np.ndarray) -> int:
    """64-bit name of a whole set: equal sets, equal names."""
    with np.errstate(over="ignore"):
        s = np.sum(tk.mix(u ^ _U(0xA0761D6478BD642F)), dtype=_U)
        return int(tk.mix(np.array([s + _U(len(u))], dtype=_U)).view(np.int64)[0])


def _sets(batch: pa.RecordBatch, n: int):
    for texts in tk.texts_of(batch.column("text")):
        yield from tk.shingle_sets(texts, n, tk.LOWER_VALUES)


def _entries(docs: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """Index entries (sig, node, role, 0), each set once a task however many
    copies the task reads, and one member row (doc_id, node, 0, size, bitmap)
    for each document (node 0 if the set is empty)."""
    def run(batches):
        seen: set[int] = set()
        for batch in batches:
            ids = batch.column("doc_id").to_numpy()
            sigs, nodes, roles, sizes, bits = [], [], [], [], []
            held = 0
            for row, u in _sets(batch, n):
                node = set_node(u) if len(u) else 0
                s, r = np.array([ids[row]]).view(_U), np.zeros(1, dtype=np.int64)
                if len(u) and node not in seen:
                    seen.add(node)
                    more = signatures(u, num, den)
                    s, r = np.concatenate([s, more[0]]), np.concatenate([r, more[1]])
                size = np.zeros(len(s), dtype=np.int32)
                size[0] = len(u)
                sigs.append(s)
                roles.append(r)
                sizes.append(size)
                bits.append(bitmap(u).tobytes())
                nodes.append(np.full(len(s), node, dtype=np.int64))
                held += len(s)
                if held > 200_000:
                    yield _entry_batch(sigs, nodes, roles, sizes, bits)
                    sigs, nodes, roles, sizes, bits = [], [], [], [], []
                    held = 0
            if held:
                yield _entry_batch(sigs, nodes, roles, sizes, bits)
    return map_arrow(docs, run, "sig long, node long, role byte, size int, bits binary")


def _entry_batch(sigs, nodes, roles, sizes, bits) -> pa.RecordBatch:
    role = np.concatenate(roles).astype(np.int8)
    member = role == 0
    at = pa.array(np.cumsum(member) - 1, mask=~member)      # the bitmap of a member row
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate(sigs).view(np.int64)), pa.array(np.concatenate(nodes)),
         pa.array(role), pa.array(np.concatenate(sizes)), pa.array(bits, pa.binary()).take(at)],
        ["sig", "node", "role", "size", "bits"])


def _may_match(ra: np.ndarray, rb: np.ndarray) -> np.ndarray:
    """Whether entries of a bucket with these roles are candidates."""
    def found(p, i):
        return ((p & PROBE > 0) & (i & SUBSET > 0)
                | (p & PROBE_TWO > 0) & (i & (SUBSET | DELETED) > 0)
                | (p & PROBE_DELETED > 0) & (i & SUBSET > 0))
    return found(ra, rb) | found(rb, ra)


def _candidates(entries: DataFrame) -> DataFrame:
    """One pass over entries sorted by (sig, role descending, node), so that
    entries that probe come first: rows (kind, a, b, sig, role).  kind 0:
    candidate pair a < b.  kind 1: entry (b, role) of a large bucket whose hub
    is a.  kind 2: document a with set b of sig shingles and its bitmap."""
    def run(batches):
        carry = None          # rows of the last, unfinished bucket (at most SMALL)
        large = None          # (sig, hub, hub's role) of an unfinished large bucket
        for batch in batches:
            sig, node, role, size = (batch.column(i).to_numpy() for i in range(4))
            member = role == 0
            if member.any():
                yield _rows(2, sig[member], node[member], size[member].astype(np.int64),
                            role[member], batch.column(4).filter(pa.array(member)))
                sig, node, role = sig[~member], node[~member], role[~member]
            if large is not None and len(sig):
                k = len(sig) if sig[-1] == large[0] else int(np.argmax(sig != large[0]))
                if k:
                    yield _rows_large(large, node[:k], role[:k])
                sig, node, role = sig[k:], node[k:], role[k:]
                if len(sig):
                    large = None
            if not len(sig):
                continue
            if carry is not None:
                sig, node, role = (np.concatenate(x) for x in zip(carry, (sig, node, role)))
                carry = None
            new = np.concatenate([[True], (sig[1:] != sig[:-1]) | (node[1:] != node[:-1])])
            sig, node, role = sig[new], node[new], role[new]
            starts = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
            sizes = np.diff(np.concatenate([starts, [len(sig)]]))
            tail = int(starts[-1])
            yield from _rows_done(sig[:tail], node[:tail], role[:tail], starts[:-1], sizes[:-1])
            if sizes[-1] <= SMALL:
                carry = (sig[tail:], node[tail:], role[tail:])
            else:
                large = (sig[tail], node[tail], role[tail])
                yield _rows_large(large, node[tail:], role[tail:])
        if carry is not None:
            yield from _rows_done(*carry, np.array([0]), np.array([len(carry[0])]))
    rows = entries.repartition(partitions(entries.sparkSession), "sig").sortWithinPartitions(
        "sig", F.desc("role"), "node")
    return map_arrow(rows, run, "kind byte, a long, b long, sig long, role byte, bits binary")


def _rows(kind, a, b, sig, role, bits=None) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(a), kind, dtype=np.int8)), pa.array(a), pa.array(b), pa.array(sig),
         pa.array(role), pa.nulls(len(a), pa.binary()) if bits is None else bits],
        ["kind", "a", "b", "sig", "role", "bits"])


def _rows_large(large, node, role) -> pa.RecordBatch:
    sig, hub, first = large
    if first < PROBE:                            # nobody probes this bucket
        node, role = node[:0], role[:0]
    k = len(node)
    return _rows(1, np.full(k, hub), node, np.full(k, sig), role)


def _rows_done(sig, node, role, starts, sizes):
    """Pairs of complete small buckets; hub rows of complete large ones."""
    if not len(starts):
        return
    live = (role[starts] >= PROBE) & (sizes > 1)
    size = np.repeat(np.where(live, sizes, 0), sizes)
    at = np.repeat(starts, sizes)
    pairs = []
    for d in range(1, SMALL):
        i = np.flatnonzero((size[:-d] <= SMALL) & (size[:-d] > d) & (at[:-d] == at[d:])) \
            if len(sig) > d else np.empty(0, dtype=np.int64)
        if len(i):
            i = i[_may_match(role[i], role[i + d]) & (node[i] != node[i + d])]
            pairs.append(np.stack([np.minimum(node[i], node[i + d]),
                                   np.maximum(node[i], node[i + d])], axis=1))
    if pairs:
        p = np.unique(np.concatenate(pairs), axis=0)
        if len(p):
            yield _rows(0, p[:, 0].copy(), p[:, 1].copy(), np.zeros(len(p), dtype=np.int64),
                        np.zeros(len(p), dtype=np.int8))
    i = np.flatnonzero(size > SMALL)
    if len(i):
        yield _rows(1, node[at[i]], node[i], sig[i], role[i])


def _sets_of(docs: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """(doc_id, items) of the wanted documents: a fixed-size filter first, so
    that no other document's set leaves its task, then an exact semi-join."""
    bits = id_filter(wanted, "doc_id")

    def run(batches):
        for batch in batches:
            batch = batch.filter(pa.array(maybe(bits, batch.column("slot").to_numpy())))
            if batch.num_rows:
                for texts in tk.texts_of(batch.column("text")):
                    sets = list(tk.shingle_sets(texts, n, tk.LOWER_VALUES))
                    flat = np.concatenate([u for _, u in sets]).view(np.int64)
                    offs = np.cumsum([0] + [len(u) for _, u in sets]).astype(np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("doc_id").slice(texts.first, len(sets)),
                         pa.ListArray.from_arrays(pa.array(offs), pa.array(flat))],
                        ["doc_id", "items"])
    return map_arrow(docs.select("doc_id", "text", slot_of("doc_id")), run,
                     "doc_id long, items array<long>").join(wanted, "doc_id", "left_semi")


def _near(pairs: DataFrame, sketches: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs that sizes and parity bitmaps do not rule out."""
    both = (pairs.select("a", "b")
            .join(sketches.select(F.col("rep").alias("b"), F.col("size").alias("nb"),
                                  F.col("bits").alias("y")), "b")
            .where("nb > 0")
            .join(sketches.select(F.col("rep").alias("a"), F.col("size").alias("na"),
                                  F.col("bits").alias("x")), "a")
            .where(F.expr(f"{num}L * greatest(na, nb) <= {den}L * least(na, nb)"))
            .select("a", "b", "x", "y", ((den - num) * (F.col("na") + F.col("nb"))).alias("total")))

    def run(batches):
        for batch in batches:
            limit = batch.column("total").to_numpy() // (den + num)
            differ = np.empty(batch.num_rows, dtype=np.int64)
            for i, (x, y) in enumerate(zip(batch.column("x").to_pylist(),
                                           batch.column("y").to_pylist())):
                words = min(len(x), len(y)) // 8
                differ[i] = np.bitwise_count(_folded(x, words) ^ _folded(y, words)).sum()
            yield batch.select(["a", "b"]).filter(pa.array(differ <= limit))
    return map_arrow(both, run, "a long, b long")


def _verified(pairs: DataFrame, sketches: DataFrame, docs: DataFrame, n: int, num: int,
              den: int) -> DataFrame:
    """Pairs (a, b) of document ids whose whole sets reach the similarity; the
    bitmaps come first, so that sets move for likely pairs only."""
    pairs = cut(_near(pairs, sketches, num, den))
    wanted = cut(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct())
    sets = _sets_of(docs, wanted, n)
    common = F.size(F.array_intersect("x", "y"))
    return (pairs.select("a", "b")
            .join(sets.select(F.col("doc_id").alias("b"), F.col("items").alias("y")), "b")
            .join(sets.select(F.col("doc_id").alias("a"), F.col("items").alias("x")), "a")
            .select("a", "b", common.alias("common"), (F.size("x") + F.size("y")).alias("total"))
            .where(F.expr(f"{den}L * common >= {num}L * (total - common)")).select("a", "b"))


def bitmap(u: np.ndarray) -> np.ndarray:
    """Parity bitmap of a set: the shingle's bit is flipped; at least two bits
    for each shingle, a power of two of 64-bit words."""
    words = 1 << max(0, (len(u) // 32).bit_length())
    with np.errstate(over="ignore"):
        bit = tk.mix(u + _U(0x2545F4914F6CDD1D)) & _U(words * 64 - 1)
    odd = (np.bincount(bit.astype(np.int64), minlength=words * 64) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view(_U)


def _folded(data: bytes, words: int) -> np.ndarray:
    b = np.frombuffer(data, dtype=_U)
    while len(b) > words:                        # bit index modulo a smaller power of two
        b = b[:len(b) // 2] ^ b[len(b) // 2:]
    return b


def _labelled(large: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Entries of large buckets with their component, and the buckets that hold
    several (least and greatest entry by component)."""
    rows = large.join(labels, large["rep"] == labels["v"], "left").select(
        "sig", "rep", "role", F.coalesce("component", "rep").alias("c"))
    ends = rows.groupBy("sig").agg(F.min(F.struct("c", "rep")).alias("lo"),
                                   F.max(F.struct("c", "rep")).alias("hi"),
                                   F.count("*").alias("n")).where("lo.c <> hi.c")
    return rows, ends


def _hub_pairs(large: DataFrame, labels: DataFrame, tried: DataFrame) -> DataFrame:
    """Each entry of a large bucket with the bucket's least (or greatest)
    document of another component."""
    rows, ends = _labelled(large, labels)
    j = rows.join(ends, "sig").select(
        "rep", F.when(F.col("c") == F.col("lo.c"), F.col("hi.rep"))
        .otherwise(F.col("lo.rep")).alias("hub"))
    new = j.select(F.least("rep", "hub").alias("a"), F.greatest("rep", "hub").alias("b"))
    return new.distinct().join(tried, ["a", "b"], "left_anti")


def _left_pairs(large: DataFrame, labels: DataFrame, tried: DataFrame, sketches: DataFrame,
                num: int, den: int) -> DataFrame:
    """All other pairs of large buckets in different components that the sizes
    and parity bitmaps do not rule out."""
    rows, ends = _labelled(large, labels)
    rows = cut(rows.join(ends.select("sig", F.ceil(F.col("n") / BLOCK).cast("int")
                                     .alias("blocks")), "sig"))
    members = (rows.withColumn("block", F.expr("cast(pmod(xxhash64(rep), blocks) as int)"))
               .withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
               .join(sketches, "rep")
               .select("sig", F.least("block", "other").alias("bi"),
                       F.greatest("block", "other").alias("bj"), "block", "rep", "role", "c",
                       "size", "bits"))

    def compare(held):
        block, bi, bj, rep, role, c, size = (np.concatenate([h[k] for h in held])
                                             for k in (2, 0, 1, 3, 4, 5, 6))
        raw = [b for h in held for b in h[7]]
        words = min(map(len, raw)) // 8
        bits = np.stack([_folded(b, words) for b in raw])
        for lo in range(0, len(rep), 64):
            rows = slice(lo, lo + 64)
            i, j = np.nonzero(
                (c[rows, None] != c) & (rep[rows, None] < rep)
                & (num * np.maximum(size[rows, None], size)
                   <= den * np.minimum(size[rows, None], size)))
            i += lo
            ok = _may_match(role[i], role[j])
            if bi[0] != bj[0]:
                ok &= block[i] != block[j]
            i, j = i[ok], j[ok]
            if len(i):
                differ = np.bitwise_count(bits[i] ^ bits[j]).sum(axis=1, dtype=np.int64)
                near = differ <= (den - num) * (size[i] + size[j]) // (den + num)
                if near.any():
                    yield rep[i[near]], rep[j[near]]

    def run(batches):
        held, key = [], None
        for batch in batches:
            keys = [batch.column(i).to_numpy() for i in range(3)]
            edge = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1 \
                if batch.num_rows else []
            cuts = [0, *list(edge), batch.num_rows]
            for lo, hi in zip(cuts, cuts[1:]):
                if lo == hi:
                    continue
                now = tuple(int(k[lo]) for k in keys)
                if now != key:
                    yield from flush(held)
                    held, key = [], now
                part = batch.slice(lo, hi - lo)
                held.append([part.column(i).to_numpy() for i in range(1, 8)]
                            + [part.column(8).to_pylist()])
        yield from flush(held)

    def flush(held):
        found = list(compare(held)) if held else []
        if found:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(x)) for x in zip(*found)], ["a", "b"])
    members = members.repartition(partitions(large.sparkSession), "sig", "bi", "bj") \
        .sortWithinPartitions("sig", "bi", "bj")
    return (map_arrow(members, run, "a long, b long").distinct()
            .join(tried, ["a", "b"], "left_anti"))


def ngram_join(docs: DataFrame, n: int = 4, num: int = 85, den: int = 100) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_copies) for every document.

    ``docs`` needs ``doc_id`` (long, unique) and ``text``; other columns, of
    whatever name, are not read.  Words are runs other than space and
    0x09-0x0D of the text with A-Z lower-cased; a set holds the distinct
    shingles of ``n`` words, or the whole sequence if shorter.  Documents link
    when den * |intersection| >= num * |union|.  Null and empty texts and texts
    without words have an empty set, no links, and are their own component.
    Documents with one set (copies, ties) are linked; ``n_copies`` counts them.
    Repeated rows each give a row.  An empty table gives no rows.  A row with a
    null id is its own class: it links with nothing, its component is null.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))
    nameless = docs.where("doc_id is null")
    docs = docs.where("doc_id is not null")
    found = cut(_candidates(_entries(docs, n, num, den)))
    members = found.where("kind = 2").select(
        F.col("a").alias("doc_id"), F.col("sig").alias("n_shingles"),
        F.when(F.col("sig") > 0, F.col("b")).alias("node"), "bits")
    nodes = cut(members.where("node is not null").groupBy("node")
                .agg(F.min("doc_id").alias("rep"), F.count("*").alias("n_copies")))

    rep = nodes.select("node", "rep")
    sketches = members.join(nodes.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi") \
        .select(F.col("doc_id").alias("rep"), F.col("n_shingles").cast("int").alias("size"),
                "bits").dropDuplicates(["rep"])
    pairs = cut(found.where("kind < 2 and a <> b")
                .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
                .join(rep.withColumnsRenamed({"node": "a", "rep": "ra"}), "a")
                .join(rep.withColumnsRenamed({"node": "b", "rep": "rb"}), "b")
                .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")))
    links = cut(_verified(pairs, sketches, docs, n, num, den))
    labels = cut(components(links))
    large = cut(found.where("kind = 1").select("sig", F.col("b").alias("node"), "role").distinct()
                .join(rep, "node").select("sig", "rep", "role"))
    if not large.isEmpty():
        tried = pairs
        for step in range(3):
            pairs = cut(_hub_pairs(large, labels, tried) if step < 2 else
                        _left_pairs(large, labels, tried, sketches, num, den))
            if pairs.isEmpty():
                continue
            more = cut(_verified(pairs, sketches, docs, n, num, den))
            tried = tried.unionAll(pairs)
            if not more.isEmpty():
                known = labels.select(F.col("v").alias("a"), F.col("component").alias("b"))
                labels = cut(components(known.unionAll(more)))
    top = nodes.join(labels, nodes["rep"] == labels["v"], "left").select(
        "node", "n_copies", F.coalesce("component", "rep").alias("component"))
    done = members.join(top, "node", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"),
        F.coalesce("n_copies", F.lit(1)).alias("n_copies"))
    null = F.lit(None).cast("long")
    return done.unionAll(_sizes(nameless, n).select(
        null.alias("doc_id"), "n_shingles", null.alias("component_id"),
        F.lit(1).cast("long").alias("n_copies")))


def _sizes(docs: DataFrame, n: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([len(u) for _, u in _sets(batch, n)], pa.int64())], ["n_shingles"])
    return map_arrow(docs, run, "n_shingles long")
