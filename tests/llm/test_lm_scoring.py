"""Scores against plain counting, sums of probabilities, and held-out likelihood."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from larder.llm import lm_scoring as op


def corpus():
    rng = random.Random(8)
    # two languages whose words follow each other in a pattern
    out = []
    for i in range(400):
        names = "abcdefgh" if i % 2 else "qrstuvwx"
        words = [names[rng.randrange(2)]]
        while rng.random() < 0.97:
            words.append(names[(names.index(words[-1]) + rng.choice([1, 1, 1, 2])) % 8])
            if rng.random() < 0.05:
                words.append("".join(rng.choices(names, k=6)).upper())
                words.append(names[0])
        out.append(" ".join(words))
    return [*out, None, "", "never seen before", out[0], out[0]]


def plain(texts):
    words = [(t or "").lower().split() for t in texts]
    held = [zlib.crc32(str(i).encode()) % 10 == 0 for i in range(len(texts))]
    counts = Counter(w for ws, h in zip(words, held) if not h for w in [*ws, None])
    total = sum(counts.values())
    base = [sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (len(counts) + 1))) for w in [*ws, None]) for ws in words]
    known = [sum(counts[w] > 0 for w in [*ws, None]) for ws in words]
    return held, total, base, known, [len(ws) + 1 for ws in words]


@pytest.mark.parametrize("frequent", [5, 200_000])
def test_scores(spark, documents, write, monkeypatch, frequent):
    monkeypatch.setattr(op, "FREQUENT", frequent)
    texts = corpus()
    docs = documents(*texts)
    model, counts = op.fit(docs.where(~op.held_out()), frequent)
    rows = sorted(op.score(docs, model, counts).collect(), key=lambda r: r.doc_id)
    held, total, base, known, tokens = plain(texts)
    assert model.tokens == total
    assert [r.n_tokens for r in rows] == tokens and [r.n_known for r in rows] == known
    assert [r.base_score for r in rows] == pytest.approx(base, abs=1e-6)
    # the model tells what follows what, so it is well above the counts on held-out texts
    gain = sum(r.score - r.base_score for r, h in zip(rows, held) if h)
    assert gain > (0.3 if frequent > 5 else 0.0) * sum(n for n, h in zip(tokens, held) if h)
    if frequent == 5:
        return
    query = {r.doc_id: r for r in op.op4_lm_scoring(spark, write(documents=docs)).collect()}
    assert [query[i].held_out for i in range(len(texts))] == held
    assert {r.train_tokens for r in query.values()} == {total}
    assert [query[i].score for i in range(len(texts))] == pytest.approx([r.score for r in rows], abs=1e-6)


def test_probabilities_sum_to_one(documents):
    docs = documents(*corpus())
    model, counts = op.fit(docs)
    assert np.allclose((10**model.table).sum(axis=1), 1)
    inside = np.zeros(op.CLASSES)
    for r in counts.collect():
        if r.word.encode() not in model.words[:op.WORDS]:
            inside[op.word_class(r.word.encode())] += r.n + 0.1
    for c, mass in enumerate(inside):
        assert mass + 0.1 == pytest.approx(model.class_tokens[c] + 0.1 * (model.class_words[c] + 1))


def test_training_learns_pairs():
    pairs = np.zeros((op.SYMBOLS, op.SYMBOLS))
    pairs[1, 2], pairs[1, 3], pairs[2, 1], pairs[3, 1] = 800, 200, 800, 200
    table = 10 ** op.train(pairs)
    assert table[1, 2] == pytest.approx(0.8, abs=0.08) and table[2, 1] > 0.9


def test_no_training_documents(documents):
    docs = documents("a b", None, "").selectExpr("cast(null as long) as doc_id", "text", "1 as n", "2 as row")
    model, counts = op.fit(docs.where(~op.held_out()))
    rows = sorted((r.n_tokens, r.n_known, r.base_score) for r in op.score(docs, model, counts).collect())
    assert rows == [(1, 0, pytest.approx(0)), (1, 0, pytest.approx(0)), (3, 0, pytest.approx(0))]
    assert op.score(docs.where("false"), model, counts).collect() == []
