"""Packing (12) and whitening (13) against plain versions."""

import itertools
import random
import zlib

import numpy as np
import pytest

from dimflow.llm import op12_packing as pk
from dimflow.llm import op13_whitening as wh
from dimflow.llm.queries import QUERIES
from llm_fixtures import CLASHING, SF, documents, edge, edge_rows, empty  # noqa: F401


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(pk.default_vocabulary())


def check_pieces(rows, texts, library, window):
    """``rows`` cover each text's ids once; sequences are gapless and hold at
    most ``window`` ids."""
    wanted = {i: [*library.encode(t or "", add_special_tokens=False).ids, 2]
              for i, t in texts.items()}
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(wanted)
    for i, parts in by_doc.items():
        at = 0
        for r in sorted(parts, key=lambda r: r.start):
            assert r.start == at and r.length > 0 and r.doc_tokens == len(wanted[i])
            ids = np.array(wanted[i][at:at + r.length], dtype="<u4")
            assert r.ids_crc32 == zlib.crc32(ids.tobytes())
            at += r.length
        assert at == len(wanted[i])
    for parts in by_seq.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= window
    return len(by_seq), sum(map(len, wanted.values()))


def test_packing_of_all_documents(spark, documents, library):
    rows = QUERIES["op12_window_packing"](spark, SF).collect()
    texts = {r.doc_id: r.text for r in documents.collect()}
    sequences, tokens = check_pieces(rows, texts, library, 4096)
    assert tokens / (sequences * 4096) > 0.97


def test_packing_edges(spark, edge, edge_rows, empty):
    out = pk.pack_documents(edge, window=64, keep_ids=True).collect()
    assert all(len(r.ids) == r.length for r in out)
    assert sorted(r.doc_tokens for r in out if r.doc_id in (1, 2, 3)) == [1, 1, 1]
    assert any(r.doc_id is None for r in out)
    total = {}
    for r in out:
        total[r.sequence_id] = total.get(r.sequence_id, 0) + r.length
    assert max(total.values()) <= 64
    # repeated rows (doc 8 twice) are packed each for itself
    assert sum(r.length for r in out if r.doc_id == 8) == 2 * next(
        r.doc_tokens for r in out if r.doc_id == 8)
    assert pk.pack_documents(empty).collect() == []
    with pytest.raises(ValueError):
        pk.pack_documents(edge, window=1)


def test_units_equal_the_library(library):
    rng = random.Random(12)
    letters = "abAB'é É́ß ẞ.,<|>0 1٣ſK\t\n\x0b\x1f‍İiΣς&"
    texts = ["".join(rng.choices(letters, k=50)) for _ in range(1500)]
    texts += ["<|endoftext|> a<|startoftext|>b", "don't 'select !!'s it'S", "x" * 5000, "", " "]
    texts.append(" ".join(texts) * 3)
    got = dict(pk.encode_texts(pk.Units(pk.default_vocabulary()), texts))
    for i, e in enumerate(library.encode_batch(texts, add_special_tokens=False)):
        assert got[i].tolist() == e.ids, texts[i][:60]


def test_new_plain_units_are_encoded_together(library):
    """Unseen words of plain letters go to the library many in one text, and no
    word of another kind takes part of theirs."""
    letters = "abcdefghijklmnopqrstuvwxyzßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ"
    rng = random.Random(7)
    words = list({"".join(rng.choices(letters, k=rng.randint(1, 20))) for _ in range(5000)})
    units = pk.Units(pk.default_vocabulary())
    given = {"alone": 0, "together": 0}

    class Counted:
        def __init__(self, name, tokenizer):
            self.name, self.tokenizer = name, tokenizer

        def encode_batch_fast(self, texts, **options):
            given[self.name] += len(texts)
            return self.tokenizer.encode_batch_fast(texts, **options)
    units.tokenizer = Counted("alone", units.tokenizer)
    if units.plain:
        units.plain = (Counted("together", units.plain[0]), *units.plain[1:])
    texts = [" ".join(words), "It's " + " ".join(words[:50]).upper() + " a\0b \0 x\0",
             "".join(f"{w}+{i}<" for i, w in enumerate(words[:99])), "12345678 123456789 ----------"]
    got = dict(pk.encode_texts(units, texts))
    for i, e in enumerate(library.encode_batch(texts, add_special_tokens=False)):
        assert got[i].tolist() == e.ids
    assert given["alone"] < 50 and 0 < given["together"] < 100
    # the same where the vocabulary does not tell where a unit ends
    units = pk.Units(pk.default_vocabulary())
    units.plain = None
    again = dict(pk.encode_texts(units, texts))
    assert all(got[i].tolist() == again[i].tolist() for i in range(len(texts)))


def test_long_texts_are_cut_at_white_space(library):
    text = " ".join(f"word{i % 97}, it's" for i in range(30_000))
    parts = list(pk.blocks_of(text, 1000))
    assert len(parts) > 300 and max(map(len, parts)) < 1100
    got = dict(pk.encode_texts(pk.Units(pk.default_vocabulary()), [text]))[0]
    assert got.tolist() == library.encode(text, add_special_tokens=False).ids
    assert list(pk.blocks_of("y" * 5000, 1000)) == ["y" * 5000]


def plain_differencing(sizes, k):
    """Karmarkar-Karp over explicit k-tuples of windows."""
    parts = [[0] * (k - 1) + [s] for s in sizes]
    while len(parts) > 1:
        parts.sort(key=lambda p: p[0] - p[-1])
        a, b = parts.pop(0), parts.pop(0)
        merged = sorted(x + y for x, y in zip(sorted(a), sorted(b, reverse=True)))
        parts.append([x - merged[0] for x in merged])
    return max(parts[0]) - min(parts[0])


def test_differencing_equals_the_plain_one():
    rng = random.Random(3)
    for n, k in itertools.product((1, 2, 7, 40), (1, 2, 3, 9)):
        sizes = rng.sample(range(1, 10_000), n)          # distinct: no ties to break
        got = pk._Differencing(np.array(sizes), k).windows()
        sums = np.bincount(got, weights=sizes, minlength=k)
        assert len(got) == n and sums.sum() == sum(sizes)
        assert abs((sums.max() - sums.min()) - plain_differencing(sizes, k)) <= 1e-9


def test_windows_rise_until_all_fit():
    rng = np.random.default_rng(5)
    for sizes in ([60] * 50, [100] * 7, [1], rng.integers(1, 100, 300), [100, 99, 1, 51, 50]):
        sizes = np.array(sizes)
        number = pk.pack(sizes, 100)
        sums = np.bincount(number, weights=sizes)
        assert sums.max() <= 100 and (sums > 0).sum() <= len(sizes)
    small = rng.integers(1, 25, 3000)
    assert small.sum() / (100 * (pk.pack(small, 100).max() + 1)) > 0.98


# -- whitening --------------------------------------------------------------

def plain_whitening(vectors, components=16):
    x = np.floor(np.array(vectors, dtype=np.float64) * 64) + 1_000_000
    fit = np.unique(x, axis=0)
    v = np.cov(fit.T, bias=True).reshape(x.shape[1], -1)
    e, u = np.linalg.eigh(v)
    e, u = e[::-1], u[:, ::-1]
    m = int((e[:components] > 1e-12 * e.sum()).sum())
    white = (x - fit.mean(axis=0)) @ u[:, :m] / np.sqrt(e[:m])
    n, s = len(fit), fit.sum(axis=0)
    return n, white, e[:m] / e.sum(), [int(d) for d in (
        (n * x.astype(object) - s.astype(object)) ** 2).sum(axis=1)]


def test_whitening_equals_a_dense_one(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    n, white, explained, deviation = plain_whitening([r.embedding for r in table])
    out = QUERIES["op13_whitening"](spark, SF).collect()
    assert len(out) == 16 * len(table)
    got = {(r.vec_id, r.component): r for r in out}
    signs = [np.sign(got[table[0].vec_id, c + 1].whitened * white[0, c]) for c in range(16)]
    for i, r in enumerate(table):
        for c in range(16):
            g = got[r.vec_id, c + 1]
            assert abs(g.whitened * signs[c] - white[i, c]) < 1e-7
            assert g.n == n and g.deviation == deviation[i]
            assert abs(g.explained / explained[c] - 1) < 1e-9 and g.identity_error < 1e-9


def test_whitening_edges(spark):
    rng = np.random.default_rng(1)
    good = [[float(a) for a in v] for v in rng.standard_normal((40, 5))]
    nan, inf = float("nan"), float("inf")
    rows = [(i, v) for i, v in enumerate(good)] + [
        (0, good[0]), (None, good[1]), (90, None), (91, []), (92, [1.0, None, 1.0, 1.0, 1.0]),
        (93, [nan] * 5), (94, [inf, 0.0, 0.0, 0.0, 0.0]), (95, [1.0, 2.0]), (96, [0.0] * 5),
        (97, [1e30] * 5)]
    extra = ", ".join(f"`{c}` int" for c in [*CLASHING, "x", "block", "i", "c0"])
    df = spark.createDataFrame([(*r, *[1] * (len(CLASHING) + 4)) for r in rows],
                               f"vec_id long, embedding array<double>, {extra}")
    out = wh.whiten(df).collect()
    kept = [v for i, v in rows if v is not None and (i is None or i < 90 or i == 96)]
    n, white, explained, deviation = plain_whitening(kept)
    assert len(out) == 5 * len(kept) and {r.n for r in out} == {n} and n == 41
    assert sorted(r.deviation for r in out) == sorted(d for d in deviation for _ in range(5))
    assert np.allclose(sorted(abs(r.whitened) for r in out), np.sort(np.abs(white).ravel()),
                       atol=1e-8)
    assert wh.whiten(df.where("false")).collect() == []
    assert wh.whiten(df.where("vec_id = 96")).collect() == []          # no spread, no component
    two = wh.whiten(df.where("vec_id in (1, 2)")).collect()            # rank one
    assert len(two) == 2 and all(abs(abs(r.whitened) - 1) < 1e-9 for r in two)


def test_large_deviations_are_exact(spark):
    rows = [(1, [2.0 ** 30, 1.0]), (2, [0.0, 3.0]), (3, [5.0, -2.0])]
    out = wh.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    _, _, _, deviation = plain_whitening([v for _, v in rows])
    want = {i + 1: d if d < 1 << 63 else None for i, d in enumerate(deviation)}
    assert {r.vec_id: r.deviation for r in out} == want


@pytest.mark.parametrize("values", [
    np.linspace(100, 1, 300), np.ones(40), np.r_[3.0, 2.0, np.zeros(30)],
    1 / np.arange(1, 501), np.r_[np.full(20, 7.0), np.linspace(1, 0, 200)]])
def test_jacobi_davidson_equals_a_dense_solver(values):
    rng = np.random.default_rng(2)
    q = np.linalg.qr(rng.standard_normal((len(values), len(values))))[0]
    a = (q * values) @ q.T
    e, u = wh.leading_pairs(lambda b: a @ b, len(values), 16, float(values.sum()))
    want = np.sort(values)[::-1][:16]
    assert np.abs(e - want).max() < 1e-12 * want[0]
    assert np.linalg.norm(a @ u - u * e, axis=0).max() < 1e-12 * want[0]
    assert np.abs(u.T @ u - np.eye(16)).max() < 1e-12
