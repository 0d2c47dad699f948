"""Fingerprints against plain hashing, components against all pairs."""

import random

import numpy as np
import pytest
import xxhash

from larder.llm import simhash_dedup as op
from larder.llm.components import components


def fingerprint(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()]
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(prints):
    n = len(prints)
    name = list(range(n))

    def find(x):
        while name[x] != x:
            x = name[x]
        return x

    for i in range(n):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                a, b = find(i), find(j)
                name[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def texts():
    rng = random.Random(7)
    words = [f"Wört{i}" for i in range(300)]
    out = [" ".join(rng.choices(words, k=rng.choice([1, 3, 4, 5, 60, 200]))) for _ in range(60)]
    for t in out[:20]:
        w = t.split()
        for _ in range(3):
            w[rng.randrange(len(w))] = "changed"
            out.append(" ".join(w))
    return [None, "", " \t", *out, out[0], out[0].upper(), "  ".join(out[1].split(" ")), "a b c\x1fd\x0be　f g", "x " * 3000]


def test_query(spark, documents, write):
    given = texts()
    rows = sorted(op.op7_simhash(spark, write(documents=documents(*given))).collect(), key=lambda r: r.doc_id)
    prints = [fingerprint(t) for t in given]
    assert [r.fingerprint for r in rows] == [f"{p:016x}" for p in prints]
    assert [r.component_id for r in rows] == classes(prints)


@pytest.mark.parametrize("tile", [4096, 8])
def test_links_lose_no_pair(spark, tile):
    rng = random.Random(tile)
    prints = {rng.getrandbits(64) for _ in range(150)}
    for p in list(prints)[:100]:
        for _ in range(rng.randint(1, 4)):
            p ^= 1 << rng.randrange(64)
            prints.add(p)
    # a crowd around one print, and a chain
    prints |= {0xF0F0 ^ 1 << i ^ 1 << j for i in range(64) for j in range(0, i, 13)}
    prints |= {(1 << 3 * k) - 1 for k in range(21)}
    prints = sorted(prints)
    signed = np.array(prints, dtype=np.uint64).view(np.int64).tolist()
    frame = spark.createDataFrame([(x,) for x in signed], "fp long")
    named = {r.node: r.name for r in components(op.link(frame, tile)).collect()}
    want = classes(prints)
    groups, got = {}, {}
    for i, x in enumerate(signed):
        groups.setdefault(want[i], set()).add(x)
        got.setdefault(named.get(x, x), set()).add(x)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, got.values()))


@pytest.mark.parametrize("n", [1, 10**7, 10**9, 10**12])
def test_every_choice_of_radius_bits_leaves_a_table(n):
    rng = random.Random(n)
    for _ in range(300):
        bits = sum(1 << b for b in rng.sample(range(64), 4))
        assert any(not m & bits for m in op.masks(n))


def test_long_paths(spark):
    path = list(range(1000))
    random.Random(1).shuffle(path)
    edges = [(a, b) for a, b in zip(path, path[1:])] + [(5000, 5001), (7, 7), (6000, 5001)]
    named = {r.node: r.name for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert named == {**{i: 0 for i in range(1000)}, 5000: 5000, 5001: 5000, 6000: 5000}


def test_one_stays(spark, documents):
    text = " ".join(map(str, range(50)))
    docs = documents(text, text.upper(), "other words here", None, "", text).selectExpr("*", "1 as fp", "2 as first", "3 as row")
    kept = op.keep_first(docs.unionByName(docs))
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [0, 2, 3]
    assert op.keep_first(docs.where("false")).collect() == []


def test_one_stays_of_each_group_whatever_the_ids(spark, documents):
    rng = random.Random(3)
    a, b, c, d, e, f = (" ".join(f"{name}{rng.randrange(1000)}" for _ in range(60)) for name in "abcdef")
    # unlinked texts without id, a copy of one, and copies of one with an id; id 7 has two unlike texts;
    # id 5 is the least of one group and stands in another whose least is 1
    rows = [(None, a), (None, b), (None, b.upper()), (None, c), (9, c), (7, d), (7, e), (8, e.upper()), (5, a[::-1]), (5, f), (1, f.upper()), (6, a[::-1].upper())]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], documents("x").schema)
    want = [(None, a), (None, b), (9, c), (7, d), (7, e), (5, a[::-1]), (1, f.upper())]
    groups = classes([fingerprint(t) for _, t in rows])
    assert len(set(groups)) == len(want)
    got = [(r.doc_id, r.text) for r in op.keep_first(docs.unionByName(docs)).collect()]
    key = lambda x: (x[0] is None, x[0] or 0, x[1].lower())
    assert sorted(((i, t.lower()) for i, t in got), key=key) == sorted(((i, t.lower()) for i, t in want), key=key)
