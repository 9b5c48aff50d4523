"""Operators 1, 2 and 5 against brute force."""

import itertools
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from dimflow.llm import common
from dimflow.llm import op1_ngram_join as op1
from dimflow.llm import op2_passages as op2
from dimflow.llm import op5_vectors as op5
from dimflow.llm.common import components
from llm_fixtures import documents, edge, edge_rows, empty, labels  # noqa: F401

WORD = re.compile("[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def shingles(text, n):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else (
        {tuple(w)} if w else set())


def smallest(ids, links):
    label = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return label


def brute(rows, n, num, den):
    sets = {i: shingles(t, n) for i, t in rows}
    links = [(a, b) for a, b in itertools.combinations(sets, 2)
             if sets[a] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b])]
    label = smallest(sets, links)
    return {i: (len(sets[i]), label[i]) for i in sets}


def joined(df, **k):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in op1.ngram_join(df, **k).collect()}


def test_ngram_join_documents(documents):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    assert joined(documents, n=4, num=85, den=100) == brute(rows, 4, 85, 100)


def test_ngram_join_large_groups(spark, monkeypatch):
    """Families around the threshold: large buckets, hubs and what is left."""
    monkeypatch.setattr(op1, "SMALL", 3)
    monkeypatch.setattr(op1, "BLOCK", 16)
    rng = random.Random(1)
    rows, k = [], 0
    for family in range(4):
        base = [f"f{family}w{rng.randrange(10_000)}" for _ in range(80)]
        for _ in range(45):
            w = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 3])):
                w[rng.randrange(80)] = f"e{rng.randrange(10_000)}"
            rows.append((k, " ".join(w)))
            k += 1
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert joined(df, n=4, num=85, den=100) == brute(rows, 4, 85, 100)


def test_ngram_join_edges(edge, empty):
    out = op1.ngram_join(edge).collect()
    assert len(out) == edge.count()
    got = {r.doc_id: r for r in out}
    assert got[1].n_shingles == got[2].n_shingles == got[3].n_shingles == 0
    assert [got[i].component_id for i in (1, 2, 3, 4, 5, 7, 9)] == [1, 2, 3, 4, 4, 6, 8]
    assert got[None].component_id is None and got[None].n_shingles == 1
    assert op1.ngram_join(empty).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 400), st.integers(0, 40), st.integers(0, 40), st.integers(0, 10 ** 6))
def test_signatures_never_miss_a_link(n, drop, add, seed):
    """Every pair that reaches the similarity meets in a bucket it may match in."""
    rng = np.random.default_rng(seed)
    r = np.unique(rng.integers(0, 2 ** 63, n).astype(np.uint64))
    s = np.unique(np.concatenate([r[min(drop, len(r) - 1):],
                                  rng.integers(0, 2 ** 63, add).astype(np.uint64)]))
    both = len(np.intersect1d(r, s))
    if 100 * both < 85 * (len(r) + len(s) - both) or len(r) == len(s) == both:
        return
    a, b = (dict(zip(x.tolist(), y.tolist())) for x, y in
            (op1.signatures(r, 85, 100), op1.signatures(s, 85, 100)))
    met = [k for k in a if k in b]
    assert met and any(op1._may_match(np.array([a[k]]), np.array([b[k]]))[0] for k in met)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 9), min_size=1, max_size=60), st.integers(0, 60))
def test_allocation_keeps_its_sum(counts, need):
    need = min(max(1, need), len(counts))
    value = op1.allocate(np.array(counts), need, 2)
    assert value.sum() >= need and set(value) <= {0, 1, 2}


@settings(max_examples=50, deadline=None)
@given(st.integers(1, 3000), st.integers(1, 300), st.integers(0, 10 ** 6))
def test_bitmaps_never_exceed_the_difference(n, d, seed):
    rng = np.random.default_rng(seed)
    x = np.unique(rng.integers(0, 2 ** 63, n + d).astype(np.uint64))
    a, b = x[:n], x[min(d, len(x) - 1):]
    p, q = op1.bitmap(a), op1.bitmap(b)
    words = min(len(p), len(q))
    p, q = op1._folded(p.tobytes(), words), op1._folded(q.tobytes(), words)
    assert np.bitwise_count(p ^ q).sum() <= len(np.setxor1d(a, b))


@pytest.mark.parametrize("task_links", [200_000, 40])
def test_components_of_a_long_path(spark, monkeypatch, task_links):
    monkeypatch.setattr(common, "TASK_LINKS", task_links)
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 999), (5, 5)],
                                  "a long, b long").repartition(7)
    got = {r.v: r.component for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(301)}, 999: 999, 1000: 999}


def test_passages(spark):
    rng = random.Random(2)

    def noise(n):
        return [f"n{rng.randrange(10 ** 6)}" for _ in range(n)]
    exact, fuzzy = noise(60), noise(120)
    rows = []
    for i in range(40):
        rows.append((i, " ".join(noise(rng.randrange(200)) + exact + noise(rng.randrange(200)))))
        w = list(fuzzy)
        for j in rng.sample(range(120), 6):
            w[j] = f"z{rng.randrange(10 ** 6)}"
        rows.append((100 + i, " ".join(noise(rng.randrange(200)) + w + noise(20))))
        rows.append((200 + i, " ".join(noise(300))))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    text = dict(rows)
    out = op2.repeated_passages(df).collect()
    seen = {i for r in out for i in (r.doc_id, r.other_id)}
    assert seen == set(range(40)) | set(range(100, 140))
    for r in out:
        a = text[r.doc_id].split()[r.start:r.end]
        b = text[r.other_id].split()[r.other_start:r.other_end]
        assert r.other_id < r.doc_id and r.matched >= 40 and r.identity >= 0.8
        if r.doc_id < 100:
            assert a == b == exact
        assert r.matched <= op2._common(np.array([hash(x) for x in a]),
                                        np.array([hash(x) for x in b]))


def test_chains_follow_the_best_order():
    p, q = np.arange(0, 50, 5), np.arange(100, 150, 5)
    assert [list(c) for c in op2.chains(p, q)] == [list(range(10))]
    # a stray match out of order is its own chain
    p2, q2 = np.insert(p, 5, 22), np.insert(q, 5, 3)
    got = [list(c) for c in op2.chains(p2, q2)]
    assert got[0] == [0, 1, 2, 3, 4, 6, 7, 8, 9, 10] and got[1:] == [[5]]


def _random_words(rng, n):
    return [f"n{rng.randrange(10 ** 6)}" for _ in range(n)]


@pytest.mark.parametrize("copies", [1, 40])
def test_passages_whose_fragments_stand_elsewhere(spark, copies):
    """Every seed of P stands in other documents too, but only two have P."""
    rng = random.Random(5)
    p = _random_words(rng, 51)
    parts = {100: p, 200: p}
    for i in range(copies):
        parts |= {i: p[:25], 50 + i: p[25:50], 101 + i: p[:25], 150 + i: p[25:50]}
    rows = [(i, " ".join(_random_words(rng, 30) + w + _random_words(rng, 30)))
            for i, w in parts.items()]
    got = []
    for parts in (1, 6):
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        got.append(sorted(tuple(r) for r in op2.repeated_passages(df).collect()))
    assert got[0] == got[1] == [(200, 100, 30, 81, 30, 81, 51, 1.0)]


def test_passages_do_not_depend_on_batches(spark):
    rng = random.Random(6)
    p, rows = _random_words(rng, 60), []
    for i in range(120):
        k = rng.randrange(30)
        w = p if i % 10 == 0 else p[k:k + 20]
        rows.append((i, " ".join(_random_words(rng, 20) + w + _random_words(rng, 20))))
    got = []
    for parts, size in ((1, 10_000), (1, 7), (5, 10_000)):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        try:
            df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
            df = df.repartition(parts)
            got.append(sorted(tuple(r) for r in op2.repeated_passages(df).collect()))
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got[0] == got[1] == got[2]
    assert {r[0] for r in got[0]} == set(range(10, 120, 10))


@pytest.mark.parametrize("step", [5, 7, 10])
def test_passages_with_every_nth_word_changed(spark, step):
    rng = random.Random(step)
    rows = []
    for i in range(60):
        w = _random_words(rng, 60)
        x = [f"z{rng.randrange(10 ** 6)}" if j % step == step - 1 else v for j, v in enumerate(w)]
        for k, v in ((i, w), (100 + i, x)):
            rows.append((k, " ".join(_random_words(rng, 50) + v + _random_words(rng, 50))))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.other_id) for r in op2.repeated_passages(df).collect()}
    assert got <= {(100 + i, i) for i in range(60)}
    assert len(got) >= {5: 30, 7: 54, 10: 57}[step]


def test_chains_keep_a_second_passage():
    """A far chain of a high score does not hide the matches near by."""
    p = np.concatenate([np.arange(0, 300, 5), np.arange(400, 460, 5)])
    q = p.copy()
    p, q = np.append(p, 470), np.append(q, 5)            # out of order
    got = sorted(list(c) for c in op2.chains(p, q))
    assert got == [list(range(60)), list(range(60, 72)), [72]]


@settings(max_examples=80, deadline=None)
@given(st.sets(st.tuples(st.integers(0, 90), st.integers(0, 90)), min_size=1, max_size=40))
def test_chains_against_all_predecessors(points):
    p, q = (np.array(c) for c in zip(*sorted(points)))
    score = []
    for j in range(len(p)):
        score.append(op2.SEED + max([0.0] + [
            score[i] - op2.GAP * (p[j] - p[i] + q[j] - q[i]) for i in range(j)
            if 0 < p[j] - p[i] <= op2.MAX_GAP and 0 < q[j] - q[i] <= op2.MAX_GAP]))
    best = next(op2.chains(p, q))
    gaps = op2.GAP * (np.diff(p[best]) + np.diff(q[best]))
    assert abs(op2.SEED * len(best) - gaps.sum() - max(score)) < 1e-9
    assert (np.diff(p[best]) <= op2.MAX_GAP).all() and (np.diff(q[best]) <= op2.MAX_GAP).all()


@settings(max_examples=80, deadline=None)
@given(st.sets(st.tuples(st.integers(0, 2), st.integers(0, 300), st.integers(0, 300)),
               max_size=60))
def test_groups_keep_every_chain(points):
    row, p, q = (np.array(c, dtype=np.int64) for c in zip(*sorted(points))) if points else (
        np.empty(0, dtype=np.int64),) * 3
    want, got = set(), set()
    for r in range(3):
        x, y = p[row == r], q[row == r]
        if len(x):
            want |= {(r, tuple(x[c]), tuple(y[c])) for c in op2.chains(x, y, op2.MIN_SEEDS)}
    for r, x, y in op2._groups(row, p, q):
        got |= {(r, tuple(x[c]), tuple(y[c])) for c in op2.chains(x, y, op2.MIN_SEEDS)}
    assert got == want


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 11), st.integers(0, 50)), max_size=60), st.data())
def test_fenwick_tree_against_a_list(steps, data):
    tree, live = op2._Fenwick(12), {}
    for match, (place, value) in enumerate(steps):
        if live and value % 3 == 0:
            gone = data.draw(st.sampled_from(sorted(live)))
            tree.leave(live.pop(gone)[0], gone)
        tree.enter(place, float(value), match)
        live[match] = (place, float(value))
        lo, hi = sorted(data.draw(st.tuples(st.integers(0, 12), st.integers(0, 12))))
        want = max((v for q, v in live.values() if lo <= q < hi), default=-np.inf)
        got, at = tree.best(lo, hi)
        assert got == want and (at == -1 if want == -np.inf else live[at][1] == want)


@pytest.mark.parametrize("copies", [2, 3, 16, 32, 33, 40])
def test_copies_of_a_passage_give_one_form(spark, copies):
    """However many copies: a row for each but the first, against the first."""
    rng = random.Random(copies)
    p, q = _random_words(rng, 60), _random_words(rng, 50)
    rows = [(i, " ".join(_random_words(rng, 30) + p + _random_words(rng, 30)))
            for i in range(copies)]
    rows += [(100, " ".join(q)), (101, " ".join(q)), (102, None), (103, " ".join(q[:30]))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = op2.repeated_passages(df)
    got = sorted(tuple(r) for r in found.collect())
    assert got == [(i, 0, 30, 90, 30, 90, 60, 1.0) for i in range(1, copies)] + [
        (101, 100, 0, 50, 0, 50, 50, 1.0)]
    classes = sorted(tuple(r) for r in op2.passage_classes(found).collect())
    assert classes == [(i, 30, 90, 0, copies - 1 if i == 0 else 1, 1.0)
                       for i in range(copies)] + [(i, 0, 50, 100, 1, 1.0) for i in (100, 101)]


def test_classes_lose_no_link_between_different_texts(spark):
    """Changed passages are held against one of each class of equal ones, as a
    comparison of all pairs of different passages has it."""
    rng = random.Random(8)
    p, texts = _random_words(rng, 60), {}
    for variant in range(6):
        w = list(p)
        for j in rng.sample(range(60), 3):
            w[j] = f"z{variant}_{j}"
        for copy in range(4):
            texts[copy * 10 + variant] = (variant, w)
    rows = [(i, " ".join(_random_words(rng, 20) + w + _random_words(rng, 20)))
            for i, (_, w) in texts.items()]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = op2.repeated_passages(df)
    got = {(r.doc_id, r.other_id) for r in found.collect()}
    between = {frozenset((texts[a][0], texts[b][0])) for a, b in got} - {
        frozenset((v,)) for v in range(6)}
    assert len(between) == 15                            # all pairs of the six variants
    assert {(i, i % 10) for i in texts if i >= 10} <= got
    assert len(got) < 276 / 2                            # copies are not all paired
    classes = op2.passage_classes(found).collect()
    assert {r.doc_id for r in classes} == set(texts) and {r.class_id for r in classes} == {0}


def test_changed_passage_of_common_seeds_only(spark):
    """Two documents share a changed passage; more than RARE others, before and
    between them, have each of its equal stretches."""
    rng = random.Random(21)
    parts = [_random_words(rng, 11) for _ in range(6)]

    def passage(gap):
        return [w for part in parts for w in part + _random_words(rng, gap)]
    texts = {1000: passage(1), 2000: passage(2)}
    for i, part in enumerate(parts):
        texts |= {k + i: part for k in (*range(0, 200, 10), *range(1100, 1300, 10))}
    rows = [(i, " ".join(_random_words(rng, 30) + w + _random_words(rng, 30)))
            for i, w in texts.items()]
    found = op2.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string"))
    got = found.collect()
    assert {(r.doc_id, r.other_id) for r in got} == {(2000, 1000)}
    assert max(r.matched for r in got) >= 60
    assert {(r.doc_id, r.class_id) for r in op2.passage_classes(found).collect()} == {
        (1000, 1000), (2000, 1000)}


def test_all_pairs_of_different_labels(spark, monkeypatch):
    monkeypatch.setattr(op2, "BLOCK", 4)
    rng = random.Random(22)
    rows = [(key, doc, rng.randrange(3) if key else 1, 5, 9) for key, n in enumerate((9, 3, 40, 1))
            for doc in rng.sample(range(100), n)]
    df = spark.createDataFrame(rows, "key long, doc long, label long, lo int, hi int")
    got = sorted((r.doc, r.other) for r in op2._across(df).collect())
    want = sorted((x[1], y[1]) for x in rows for y in rows
                  if x[0] == y[0] and x[1] > y[1] and x[2] != y[2])
    assert got == want


def test_passages_edges(edge, empty):
    got = {(r.doc_id, r.other_id): (r.start, r.end, r.matched)
           for r in op2.repeated_passages(edge).collect()}
    assert got[7, 6] == (0, 30_000, 30_000) and got[9, 8] == (0, 397, 397)
    assert {k for k in got if 10 not in k} == {(7, 6), (9, 8)}
    assert op2.repeated_passages(empty).count() == 0
    assert op2.passage_classes(op2.repeated_passages(empty)).count() == 0


def vectors(n=300, dim=24, seed=3):
    rng = np.random.default_rng(seed)
    rows, k = [], 0
    for _ in range(n // 6):
        c = rng.normal(size=dim)
        for _ in range(6):
            x = c + rng.normal(size=dim) * 0.12
            rows.append((k, [float(v) for v in x]))
            k += 1
    rows += [(1000 + i, rows[i][1]) for i in range(0, 40, 2)]           # equal
    rows += [(2000 + i, [2.5 * v for v in rows[i][1]]) for i in range(0, 20, 3)]   # parallel
    return rows


@pytest.mark.parametrize("block", [512, 4])
def test_near_vectors(spark, monkeypatch, block):
    monkeypatch.setattr(op5, "BLOCK", block)
    rows = vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    got = {r.vec_id: r for r in op5.near_vectors(df).collect()}
    x = np.array([v for _, v in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    ids = [i for i, _ in rows]
    links = [(ids[i], ids[j]) for i, j in zip(*np.nonzero(np.triu(x @ x.T >= 0.95, 1)))]
    n = {i: 0 for i in ids}
    for a, b in links:
        n[a] += 1
        n[b] += 1
    found = sum(got[i].n_links for i in ids)
    assert all(got[i].n_links <= n[i] for i in ids)
    assert found >= 0.97 * sum(n.values())
    if found == sum(n.values()):
        label = smallest(ids, links)
        assert {i: got[i].component_id for i in ids} == label
    assert all(got[i].kept == (got[i].component_id == i) for i in ids)


def test_near_vectors_edges(spark):
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [1.0, float("nan")]),
            (6, [1.0, float("inf")]), (7, [1.0, 0.0]), (8, [3.0, 0.0]), (9, [1.0, 0.0, 0.0]),
            (7, [1.0, 0.0]), (10, [-1.0, 0.0]), (11, [1e-300, 0.0])]
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in rows],
                               "vec_id long, embedding array<double>, rep int, codes int, n int")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in op5.near_vectors(df).collect()}
    alone = {i: (0, i, True) for i in (1, 2, 3, 4, 5, 6, 9, 10)}
    assert got == {**alone, 7: (3, 7, True), 8: (3, 7, False), 11: (3, 7, False)}
    assert op5.near_vectors(df.where("false")).count() == 0


def test_pairs_of_common_seeds_are_compared_by_all_tasks(spark):
    """Few small pairs may take long: they are not joined into one task."""
    text = " ".join(f"word{i}" for i in range(60))
    docs = spark.createDataFrame([(i, f"{i} {text}") for i in range(12)],
                                 "doc_id long, text string")
    pairs = spark.createDataFrame([(i, i - 1, 1, 61, 1, 61) for i in range(1, 12)],
                                  "doc long, other long, lo int, hi int, olo int, ohi int")
    out = op2._compared(docs, pairs, op2.MIN_WORDS, op2.MIN_IDENTITY, spread=True)
    assert out.rdd.getNumPartitions() == op2.partitions(spark) > 1
    plain = op2._compared(docs, pairs, op2.MIN_WORDS, op2.MIN_IDENTITY)
    assert sorted(out.collect()) == sorted(plain.collect()) and out.count() == 11


def test_texts_without_enough_words_in_common_are_not_chained(spark, monkeypatch):
    """Runs of one word that two texts share, but too few words of it in all."""
    rng = random.Random(23)
    docs = spark.createDataFrame(
        [(i, " ".join(["the"] * 30 + _random_words(rng, 30) + ["the"] * 25 * (i > 2)))
         for i in range(1, 5)], "doc_id long, text string")
    pairs = spark.createDataFrame([(2, 1, 0, 30, 0, 30), (4, 3, 0, 85, 0, 85)],
                                  "doc long, other long, lo int, hi int, olo int, ohi int")
    calls, found, mapped, plain = [], [], op2.map_arrow, op2.chains

    def here(df, run, schema):
        if "matched" not in schema:
            return mapped(df, run, schema)
        found.extend(r for b in run(iter(df.toArrow().to_batches())) for r in b.to_pylist())
        return df

    def chains(p, q, least=1):
        calls.append(len(p))
        return plain(p, q, least)
    monkeypatch.setattr(op2, "map_arrow", here)
    monkeypatch.setattr(op2, "chains", chains)
    op2._compared(docs, pairs.where("doc = 2"), op2.MIN_WORDS, op2.MIN_IDENTITY)
    assert not calls and not found
    op2._compared(docs, pairs, op2.MIN_WORDS, op2.MIN_IDENTITY)
    assert len(calls) == 1 and {r["doc_id"] for r in found} <= {4}


def _plain_align(a, b, ps, qs):
    left = op2._reach(a[:ps[0]][::-1][:op2.REACH], b[:qs[0]][::-1][:op2.REACH])
    right = op2._reach(a[ps[-1] + 4:][:op2.REACH], b[qs[-1] + 4:][:op2.REACH])
    matched = left[1] + right[1] + 4
    for i in range(1, len(ps)):
        step = min(ps[i] - ps[i - 1], qs[i] - qs[i - 1])
        matched += step if step <= 4 else 4 + op2._common(a[ps[i - 1] + 4:ps[i]],
                                                          b[qs[i - 1] + 4:qs[i]])
    return (ps[0] - left[0], ps[-1] + 4 + right[0], qs[0] - left[0], qs[-1] + 4 + right[0],
            matched)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.tuples(st.integers(0, 5), st.integers(1, 30)), max_size=8),
                min_size=4, max_size=4), st.integers(10, 40))
def test_what_is_left_out_has_no_passage(texts, least):
    """As when all groups are chained and all chains aligned, word by word."""
    rng = random.Random(24)
    hashes = [rng.randrange(-1 << 31, 1 << 31) for _ in range(9)]
    words = [np.array([hashes[w if w < 4 else rng.randrange(9)] for w, n in t for _ in range(n)],
                      dtype=np.int32) for t in texts]
    a, b = np.concatenate(words[:2]), np.concatenate(words[2:])
    ca, cb = (np.cumsum([0, *map(len, w)]) for w in (words[:2], words[2:]))
    want = []
    for r, x, y in op2._groups(*op2._shared(a, ca, b, cb)):
        for path in op2.chains(x, y, op2.MIN_SEEDS):
            s, e, t, u, matched = _plain_align(a[ca[r]:ca[r + 1]], b[cb[r]:cb[r + 1]],
                                               x[path], y[path])
            identity = matched / max(e - s, u - t)
            if matched >= least and identity >= 0.8:
                want.append((r, s, e, t, u, matched, identity))
    assert op2._passages(a, ca, b, cb, least, 0.8) == want


@settings(max_examples=80, deadline=None)
@given(st.sets(st.tuples(st.integers(0, 200), st.integers(0, 60)), min_size=1, max_size=120))
def test_chains_against_a_scan_of_the_window(points):
    """All chains, ties included: of one place the earliest, of places the latest."""
    p, q = (np.array(c) for c in zip(*sorted(points)))
    n, back = len(p), []
    score, value = np.zeros(n), np.zeros(n)
    for j in range(n):
        tops = {}
        for i in range(j):
            if 0 < p[j] - p[i] <= op2.MAX_GAP and 0 < q[j] - q[i] <= op2.MAX_GAP:
                if q[i] not in tops or value[i] > value[tops[q[i]]]:
                    tops[q[i]] = i
        best = max(tops.values(), key=lambda i: (value[i], i), default=-1)
        gain = value[best] - op2.GAP * (p[j] + q[j]) if best >= 0 else 0
        score[j] = op2.SEED + max(gain, 0)
        back.append(best if gain > 0 else -1)
        value[j] = score[j] + op2.GAP * (p[j] + q[j])
    if (np.diff(p) > 0).all() and (np.diff(q) > 0).all():
        return                                           # in order: costs added up otherwise
    want, used = [], set()
    for j in np.argsort(-score, kind="stable").tolist():
        path = []
        while j >= 0 and j not in used:
            used.add(j)
            path.append(j)
            j = back[j]
        if path:
            want.append(path[::-1])
    assert [list(c) for c in op2.chains(p, q)] == want


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=80), st.lists(st.integers(0, 4), max_size=80))
def test_common_words_against_the_table(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        diagonal = 0
        for j, y in enumerate(b, 1):
            diagonal, row[j] = row[j], (diagonal + 1 if x == y else max(row[j], row[j - 1]))
    assert op2._common(np.array(a), np.array(b)) == row[-1]


def test_texts_without_a_dense_stretch_are_not_matched(spark, monkeypatch):
    """Many pairs of enough words in common, but nowhere enough of them together."""
    rng = random.Random(25)

    def words(dense):
        other = _random_words(rng, 60)
        some = [f"word{i}" for i in range(60)]
        return " ".join(some + other if dense else [w for two in zip(some, other) for w in two])
    docs = spark.createDataFrame([(i, words(i < 3)) for i in range(1, 25)],
                                 "doc_id long, text string")
    pairs = spark.createDataFrame([(i, i - 1, 0, 120, 0, 120) for i in range(2, 25)],
                                  "doc long, other long, lo int, hi int, olo int, ohi int")
    matched, found, mapped, plain = [], [], op2.map_arrow, op2._shared

    def here(df, run, schema):
        if "matched" not in schema:
            return mapped(df, run, schema)
        found.extend(r for b in run(iter(df.coalesce(1).toArrow().to_batches()))
                     for r in b.to_pylist())
        return df

    def shared(a, ca, b, cb):
        matched.append(len(ca) - 1)
        return plain(a, ca, b, cb)
    monkeypatch.setattr(op2, "map_arrow", here)
    monkeypatch.setattr(op2, "_shared", shared)
    op2._compared(docs, pairs, op2.MIN_WORDS, op2.MIN_IDENTITY)
    assert matched == [1] and {(r["doc_id"], r["matched"]) for r in found} == {(2, 60)}


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 10 ** 6), st.integers(8, 40), st.integers(1, 3))
def test_chains_of_all_groups_at_once(seed, n, dense):
    """Also with matches in order, ties, many places of a word and long groups."""
    rng = np.random.default_rng(seed)
    groups = []
    for k in range(n):
        size = int(rng.integers(3, 30)) * (8 if k == 3 else 1)
        if k % 5 == 0:
            p = q = np.cumsum(rng.integers(1, 12 if k % 2 else 50, size))
        else:
            points = {(int(x), int(y)) for x, y in zip(
                rng.integers(0, 30 * dense, 4 * size) * (1 if k % 2 else 4),
                rng.integers(0, 12 if k % 3 else 60, 4 * size) * (1 if k % 2 else 4))}
            p, q = (np.array(c, dtype=np.int64) for c in zip(*sorted(points)))
        groups.append((p, q))
    hi = np.cumsum([len(p) for p, _ in groups])
    lo = hi - [len(p) for p, _ in groups]
    match, first = op2._paths(*(np.concatenate(c) for c in zip(*groups)), lo, hi)
    got = [c.tolist() for c in np.split(match, first[1:])] if len(first) else []
    assert got == [(a + c).tolist() for a, (p, q) in zip(lo, groups)
                   for c in op2.chains(p, q, op2.MIN_SEEDS)]


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 10 ** 6), st.integers(2, 9), st.integers(10, 40))
def test_what_many_pairs_leave_out_has_no_passage(seed, kinds, least):
    """Of 20 pairs at once, what each gives alone, aligned word by word."""
    rng = np.random.default_rng(seed)
    hashes = rng.integers(-1 << 31, 1 << 31, kinds).astype(np.int32)

    def text():
        size = rng.integers(1, 25, rng.integers(0, 9))
        return np.concatenate([np.empty(0, dtype=np.int32), *(
            hashes[rng.integers(0, kinds, m)] if rng.random() < .3 else
            np.full(m, hashes[rng.integers(0, 2)]) for m in size)])
    pairs = [(text(), text()) for _ in range(20)]
    ca, cb = (np.cumsum([0, *map(len, c)]) for c in zip(*pairs))
    want = []
    for i, (a, b) in enumerate(pairs):
        for _, x, y in op2._groups(*op2._shared(a, np.array([0, len(a)]), b,
                                                np.array([0, len(b)]))):
            for path in op2.chains(x, y, op2.MIN_SEEDS):
                s, e, t, u, matched = _plain_align(a, b, x[path], y[path])
                if matched >= least and matched / max(e - s, u - t) >= 0.8:
                    want.append((i, s, e, t, u, matched, matched / max(e - s, u - t)))
    a, b = (np.concatenate(c) for c in zip(*pairs))
    assert op2._passages(a, ca, b, cb, least, 0.8) == want


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 3), max_size=36),
                          st.lists(st.integers(0, 3), max_size=36)), min_size=1, max_size=9))
def test_common_words_of_many_gaps(gaps):
    (a, ca), (b, cb) = ((np.array([w for g in side for w in g], dtype=np.int32),
                         np.cumsum([0, *map(len, side)])) for side in zip(*gaps))
    got = op2._all_common(np.append(a, 0), ca[:-1], np.diff(ca),
                          np.append(b, 0), cb[:-1], np.diff(cb))
    assert got.tolist() == [op2._common(np.array(x), np.array(y)) for x, y in gaps]
