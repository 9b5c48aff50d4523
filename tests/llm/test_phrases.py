"""Phrase mining (11) against a plain count and DuckDB."""

import random
import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from dimflow.llm import op11_phrases as ph
from dimflow.llm.queries import ORACLES, QUERIES
from llm_fixtures import CLASHING, SF, edge, edge_rows, empty  # noqa: F401


def plain(rows, min_count, top, inside=80, scale=2_000_000):
    """All phrases counted one by one."""
    f, total = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for m in (1, 2, 3, 4):
                for i in range(len(words) - m + 1):
                    f.setdefault(lang, Counter())[tuple(words[i:i + m])] += 1
    out = []
    for lang, count in f.items():
        known = {p: a for p, a in count.items() if a >= min_count and len(p) > 1}
        scored = []
        for p, a in known.items():
            if any(len(q) > len(p) and 100 * b >= inside * a
                   and any(q[i:i + len(p)] == p for i in range(len(q)))
                   for q, b in known.items()):
                continue
            cuts = [(scale * a // (count[p[:k]] + count[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            scored.append((-score, -a, " ".join(p).encode(), count[p[:k]], count[p[k:]]))
        for rank, (score, a, p, l, r) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, total[lang], -score))
    return sorted(out)


def rows_of(df):
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score)
                  for r in df.collect())


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    found = con.sql(ORACLES["op11_phrase_mining"]).fetchall()
    assert rows_of(QUERIES["op11_phrase_mining"](spark, SF)) == sorted(found)


@pytest.mark.parametrize("top", [3, 2000])
def test_equals_a_plain_count(spark, top):
    rng = random.Random(11)
    vocabulary = ["new", "York", "a", "É", "ß", "the", "x-y", "中文", "İ", "\x00q", "of", "\x85w"]
    rows = []
    for _ in range(150):
        words = []
        for _ in range(rng.randrange(0, 60)):
            words.append(rng.choice(vocabulary) if rng.random() < .7 else "new york  the\tof")
            words.append(rng.choice([" ", " ", " ", "\t ", ". ", ",", "\n", "\x0b", "!?", "\x1c"]))
        rows.append((rng.choice([None, "und", "en", "fr"]), "".join(words)))
    df = spark.createDataFrame(rows * 2, "lang string, text string").repartition(5)
    assert rows_of(ph.collocations(df, min_count=4, top=top)) == plain(rows * 2, 4, top)


def test_edges(spark, edge, edge_rows, empty):
    extra = edge.withColumn("phrase", edge.doc_id).withColumn("n", edge.doc_id).withColumn(
        "prefix", edge.doc_id).withColumn("words", edge.doc_id)
    want = plain([(r[2], r[1]) for r in edge_rows if r[0] not in (6, 7)], 3, 2000)
    got = rows_of(ph.collocations(extra.where("doc_id is null or doc_id not in (6, 7)"), 3))
    assert got == want and want
    documents = pa.table({"lang": [r[2] for r in edge_rows], "text": [r[1] for r in edge_rows]})  # noqa: F841
    con = duckdb.connect()
    con.register("documents", documents)
    assert rows_of(ph.collocations(extra, 2)) == sorted(con.sql(
        ORACLES["op11_phrase_mining"].replace("f >= 30", "f >= 2")).fetchall())
    assert rows_of(ph.collocations(empty)) == []
    assert rows_of(ph.collocations(edge.where("text is null"))) == []


def test_a_hot_pair_in_every_text(spark):
    rows = [("en", f"hot pair w{i % 40} w{i % 7} tail") for i in range(3000)]
    df = spark.createDataFrame(rows, "lang string, text string").repartition(16)
    assert rows_of(ph.collocations(df)) == plain(rows, 30, 2000)


def test_chunks_end_between_pieces(monkeypatch):
    monkeypatch.setattr(ph, "CHUNK", 64)
    texts = ["a b c. " * 30, "", "no break here " * 40, "X;Y"]
    parts = [p.tobytes() for p in ph._chunks(pa.array(texts))]
    assert b"".join(parts) == "".join(t.lower() + "\n" for t in texts).encode()
    assert len(parts) > 4 and all(p[:1] in b".;\n" for p in parts[1:])
    assert list(ph._chunks(pa.array([], pa.string()))) == []


@pytest.mark.parametrize("words", [2, 4])
def test_bursts_and_spills_lose_nothing(monkeypatch, words):
    monkeypatch.setattr(ph, "BURST", 8)
    rng = random.Random(words)
    state = ph._Lang("en", words, frozenset({("en", "c")}))
    every = np.full(1 << (ph.FILTER_BITS - 3), 255, dtype=np.uint8)
    want, rows, burst = Counter(), [], False
    for _ in range(60):
        w = [rng.choice("abcdefghij") for _ in range(80)]
        for m in ((2,) if words == 2 else (3, 4)):
            want.update(" ".join(w[i:i + m]) for i in range(len(w) - m + 1))
        ph._count(state, np.frombuffer(" ".join(w).encode(), np.uint8), words, every, every)
        burst |= any(isinstance(c, ph._Node) for c in state.trie.root.values())
        if state.trie.entries > 300:
            rows += state.runs(150)
            assert state.trie.entries <= 150
    rows += state.runs(0)
    assert burst == (words == 4) and not state.trie.root and state.trie.entries == 0
    assert all(r[3].split("\n") == sorted(r[3].split("\n")) for r in rows)
    assert {r[2] > 0 for r in rows if r[1] != "c"} == {False}
    rows.sort(key=lambda r: r[:3])
    monkeypatch.setattr(ph, "MERGE", 2000)               # many partial merges
    got = Counter()
    for batch in ph._merge(ph._run_batches(rows), 2):
        for p, n, m in zip(*(batch.column(c).to_pylist() for c in ("phrase", "n", "words"))):
            assert p not in got and m == len(p.split())
            got[p] = n
    assert got == {p: n for p, n in want.items() if n >= 2}


def test_runs_with_large_counts():
    state = ph._Lang("", 2)
    rows = [state._run("a", 0, [("b", 1 << 40), ("c", 1)]), state._run("a", 0, [("c", 200)])]
    out = [b.to_pydict() for b in ph._merge(ph._run_batches(rows), 1)]
    assert dict(zip(out[0]["phrase"], out[0]["n"])) == {"a b": 1 << 40, "a c": 201}


def test_subtrees_leave_as_sorted_runs(monkeypatch):
    monkeypatch.setattr(ph, "BURST", 4)
    trie = ph.HatTrie(4)
    for first in (5, 2, 9):
        trie.add(first, [a | b << 21 | c << 42 for a in range(1, 5) for b in range(1, 4)
                         for c in range(0, 2)], [1] * 24)
    trie.add(2, [1 | 1 << 21], [4])
    assert isinstance(trie.root[2], ph._Node) and trie.entries == 72
    runs = list(trie.spill(40))
    assert len(runs) == 2 and trie.entries == 24
    assert dict(dict(runs)[2] if 2 in dict(runs) else list(trie.spill(0))[0][1])[(2, 1, 1)] == 5
