"""Removed words against all windows in a dictionary, and trees against sorted suffixes."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from larder.llm import substring_dedup as op


def brute(texts, window):
    words = [(t or "").encode().split() for t in texts]
    seen = Counter(tuple(w[i:i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i:i + window])] > 1:
                gone.update(range(i, i + window))
        out.append((len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def fixture(window):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(400)]
    free = lambda n: rng.choices(vocabulary, k=n)
    passage, edge, line = free(window + 25), free(window), free(window - 1)
    texts = [free(rng.randint(0, 120)) for _ in range(40)]
    texts += [free(rng.randint(0, 30)) + passage + free(rng.randint(0, 30)) for _ in range(30)]
    texts += [free(5) + edge, edge + free(5), free(9) + edge + free(9), free(9) + line + free(9), free(7) + line + free(3)]
    texts += [["the"] * (window + 9), ["the"] * window, ["a", "b"] * window, free(200) * 3, texts[41], texts[41], texts[0], edge[:-1]]
    joined = [" ".join(t) for t in texts]
    return [None, "", " \n", *joined, "  ".join(texts[45]) + "\n", "é\x1f中 " + joined[50], " ".join(free(3000) * 2)]


@pytest.mark.parametrize("window, pieces, words", [(35, 20_000, 400_000), (35, 3, 100), (12, 20_000, 300)])
def test_against_all_windows(spark, documents, window, pieces, words):
    texts = fixture(window)
    rows = op.without_repeats(documents(*texts), window, pieces, words).collect()
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept.encode()) for r in rows}
    assert got == dict(enumerate(brute(texts, window)))


def test_long_texts_come_in_parts(monkeypatch):
    rng = random.Random(6)
    texts = [[b"%d" % rng.randrange(50) for _ in range(n)] for n in (0, 34, 35, 36, 400, 1000)]
    whole = [(t, a + i, k) for t, first, n, keys in op.runs(texts) for a, m, k in zip(first.tolist(), n.tolist(), keys.tolist()) for i in range(m)]
    monkeypatch.setattr(op, "_PART", 64)
    parts = [(t, a + i, k) for t, first, n, keys in op.runs(texts) for a, m, k in zip(first.tolist(), n.tolist(), keys.tolist()) for i in range(m)]
    assert sorted(whole) == sorted(parts)
    assert [(t, i) for t, i, _ in sorted(whole)] == [(t, i) for t, w in enumerate(texts) for i in range(len(w) - 34)]


@pytest.mark.parametrize("seed", range(6))
def test_tree_nodes(seed):
    rng = random.Random(seed)
    pieces = [[rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randint(3, 25))] for _ in range(12)]
    groups = np.sort(np.array([rng.randrange(3) for _ in pieces]))
    tree = op.SuffixTree(pieces, groups, 3)
    suffixes = {int(tree.begins[p]) + i: (groups[p], tuple(w[i:])) for p, w in enumerate(pieces) for i in range(len(w) - 2)}
    at = {}
    for place, (group, words) in suffixes.items():
        at.setdefault((group, words[:3]), []).append(place)
    want = sorted(tuple(sorted(v)) for v in at.values() if len(v) > 1)
    assert sorted(tuple(sorted(places.tolist())) for _, places in tree.nodes(3)) == want
    assert tree.repeated(3).tolist() == sorted(x for v in want for x in v)
    for common, places in tree.nodes(3):
        assert len({suffixes[p][1][:common] for p in places.tolist()}) == 1


def test_query(spark, documents, write):
    texts = fixture(op.WINDOW)
    rows = op.op1_substring_dedup(spark, write(documents=documents(*texts))).collect()
    want = {i: (n, k, hashlib.sha256(kept).hexdigest()) for i, (n, k, kept) in enumerate(brute(texts, op.WINDOW))}
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in rows} == want


def test_repeated_rows_and_empty_table(spark, documents):
    docs = documents(" ".join(map(str, range(40))), "short", None).selectExpr("*", "1 as keys", "2 as t")
    twice = docs.unionByName(docs).selectExpr("if(text is null, null, doc_id) as doc_id", "text")
    rows = sorted((r.n_words, r.n_removed, r.kept) for r in op.without_repeats(twice).collect())
    assert rows == [(0, 0, ""), (0, 0, ""), (1, 0, "short"), (1, 0, "short"), (40, 40, ""), (40, 40, "")]
    assert op.without_repeats(docs.where("false")).collect() == []
