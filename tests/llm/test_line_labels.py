"""Line labels (10) on planted boilerplate, and block cuts of BPE (9)."""

import random

import numpy as np
import pyarrow as pa

from dimflow.llm import op10_quality as op10
from dimflow.llm import op9_bpe as op9
from dimflow.llm import textkit as tk


def line(rng, content):
    if content:
        return " ".join("".join(rng.choices("abcdeilnorst", k=rng.randrange(2, 9)))
                        for _ in range(rng.randrange(8, 16))).capitalize() + "."
    return " ".join(rng.choice(["SHARE", "###", "CLICK!!", "$$ 99", "LOGIN", "| |", "MENU"])
                    for _ in range(rng.randrange(3, 9)))


def planted(rng, good):
    """Lines with their states: good texts hold blocks of boilerplate, bad ones
    now and then a line of prose."""
    states = []
    for _ in range(rng.randrange(3, 7)):
        states += [1 if good else 0] * rng.randrange(2, 8)
        if rng.random() < .6:
            states += [0 if good else 1] * rng.randrange(1, 4 if good else 2)
    return [line(rng, s) for s in states], states


def test_planted_boilerplate_is_found_by_line(spark):
    rng = random.Random(10)
    docs = [(i, *planted(rng, i % 3 > 0), int(i % 3 > 0)) for i in range(400)]
    frame = spark.createDataFrame([(i, "\n".join(t)) for i, t, _, _ in docs], "doc_id long, text string")
    labels = spark.createDataFrame([(i, q) for i, _, _, q in docs if i < 300], "doc_id long, quality int")
    weights, trans = op10.train(frame, labels)
    right, total, kept = [0, 0], [0, 0], 0
    for i, text, states, quality in docs[300:]:                          # held out
        lines = op10._Lines(next(tk.texts_of(pa.array(["\n".join(text)]))))
        path = op10.viterbi(lines.features @ weights, trans)
        assert len(path) == len(states)
        for got, want in zip(path, states):
            total[want] += 1
            right[want] += got == want
    assert min(right[0] / total[0], right[1] / total[1]) >= 0.9, (right, total)
    out = {r.doc_id: r for r in op10.quality_rules(frame, (weights, trans), min_words=5).collect()}
    held = [(out[i].kept, bool(q)) for i, _, _, q in docs[300:] if not out[i].base_failed]
    assert sum(a == b for a, b in held) >= 0.9 * len(held)
    mixed = [o for o in out.values() if 0 < o.n_content_lines < o.n_lines]
    assert len(mixed) > 100


def test_training_lines_come_from_the_whole_text():
    assert op10._blocks(5, 5, 200) == [] and op10._blocks(0, 200, 200) == [(0, 200)]
    got = op10._blocks(10, 5010, 200)
    assert len(got) == 4 and got[0] == (10, 60) and got[-1] == (4960, 5010)


def test_first_states_follow_features_and_label():
    x = np.zeros((2, op10.N_FEATURES), dtype=np.uint8)
    x[:, 0] = 1
    good, bad = x.copy(), x.copy()
    good[:, 3], bad[:, 4] = 1, 1
    mixed = np.concatenate([good, bad])
    states = op10.first_states([(good, 1)] * 20 + [(bad, 0)] * 20 + [(mixed, 1), (mixed, 0)])
    assert states[-2].tolist() == [1, 1, 0, 0] and states[-1].tolist() == [1, 1, 0, 0]


def test_block_cuts_do_not_change_ids(monkeypatch):
    from tokenizers import Tokenizer
    rng = random.Random(9)
    letters = "ab'é \n\t.  1s中<|"
    texts = ["".join(rng.choices(letters, k=400)) for _ in range(150)] + ["x" * 999, "a b " * 300]
    library = Tokenizer.from_file(op9.default_vocabulary())
    monkeypatch.setattr(op9._blocks, "__defaults__", (40,))
    assert "".join(op9._blocks(texts[-1])) == texts[-1] and len(list(op9._blocks(texts[-1]))) > 20
    for text, got in zip(texts, op9.Bpe(op9.default_vocabulary()).encode_batch(texts)):
        assert got.tolist() == library.encode(text, add_special_tokens=False).ids
