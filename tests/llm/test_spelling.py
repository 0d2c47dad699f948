"""Links against all pairs, bounds against all edits, words against zlib."""

import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from larder.llm import oracle
from larder.llm import spelling as op


def one_apart(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(counts):
    near = {w: [v for v in counts if one_apart(w, v)] for w in counts}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 10 * counts[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return {(w, form[w], root(w), counts[w], len(near[w]), counts.get(form[w])) for w in counts}


def words_of(rng, n, letters="abc", sizes=(7, 8, 9, 10)):
    out = set()
    while len(out) < n:
        out.add("".join(rng.choice(letters) for _ in range(rng.choice(sizes))))
    return sorted(out)


def frame(spark, counts):
    return spark.createDataFrame(list(counts.items()), "word string, n long")


@pytest.mark.parametrize("letters, sizes, frequent, tile", [
    ("abc", (7, 8, 9), 5, 4096), ("abc", (7, 8, 9), 20, 16), ("abé漢🙂", (1, 2, 3, 4, 5), 3, 64), ("ab", (6, 7, 8, 20), 2, 8)])
def test_links_and_forms(spark, letters, sizes, frequent, tile):
    rng = random.Random(11)
    counts = {w: rng.choice([2, 3, 20, 25, 250, 2500, 40_000]) for w in words_of(rng, 400, letters, sizes)} if sizes[0] > 1 else {
        w: rng.choice([2, 30, 500]) for w in words_of(rng, 300, letters, sizes)}
    got = op.variants(frame(spark, counts).repartition(5), frequent, tile).collect()
    assert {tuple(r) for r in got} == brute(counts) and len(got) == len(counts)


def test_links_cross_partitions_and_batches(spark):
    rng = random.Random(12)
    counts = dict.fromkeys(words_of(rng, 1500, "abcd", (7, 8)), 2)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 64)
    try:
        got = {(r[0], r[1]) for r in op.near_words(frame(spark, counts), 10, 32).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == {(a, b) for a in counts for b in counts if one_apart(a, b)}


def grams(word, dictionary):
    """Kept grams with their places, and the bound."""
    (_, codes), = op._codes([word])
    kept, hashes, _, ends = op.decompose(codes, dictionary)
    return [(int(hashes[0, i]), i) for i in np.flatnonzero(kept[0])], int(op.bounds(kept, ends)[0])


def test_bound_holds_for_every_edit():
    rng = random.Random(13)
    words = words_of(rng, 60, "abc", (1, 2, 5, 7, 12))
    found = np.concatenate([op._grams(c, q).ravel() for _, c in op._codes(words) for q in (3, 4)])
    known, n = np.unique(found[found != 0], return_counts=True)
    dictionary = known[n > 4], n[n > 4]
    for word in words:
        own, bound = grams(word, dictionary)
        for i in range(len(word) + 1):
            for put in ["", "a", "c", "x"]:
                for rest in (word[i:], word[i + 1:]):
                    other, _ = grams(word[:i] + put + rest, dictionary)
                    left, there = 0, set(other)
                    for gram, place in own:
                        left += any((gram, place + d) in there for d in (-1, 0, 1))
                    assert left >= len(own) - bound


def test_dictionary_is_bounded(spark, monkeypatch):
    counts = dict.fromkeys(words_of(random.Random(14), 500), 2)
    assert len(op.gram_dictionary(frame(spark, counts), 1)[0]) > 50
    monkeypatch.setattr(op, "DICTIONARY", 20)
    known, n = op.gram_dictionary(frame(spark, counts), 1)
    assert len(known) <= 20 and (np.diff(known.astype(object)) > 0).all()


def expected_words(docs):
    counts = Counter()
    for doc, text in docs:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for run in re.findall("[a-zÀ-ÿ]+", low):
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 7:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 2}


def test_words_and_query(spark, write, documents):
    rng = random.Random(15)
    stems = ["ÀBCDEFG", "straßeÿ", "colourful", "colorful", "neighbour", "Éclairée", "x×y÷zabcd", "abcdefg", "abcdefgh"]
    texts = [None, "", "short abcdef", "ABCDEFG" * 3000, "abc🙂defghij"] + [
        " ".join(rng.choice([1, 1, 3]) * (rng.choice(stems) + rng.choice([" ", ", ", "-"])) for _ in range(40)) for _ in range(60)]
    docs = list(enumerate(texts))
    got = op.op12_spelling_variants(spark, write(documents=documents(*texts))).collect()
    assert {tuple(r) for r in got} == brute(expected_words(docs)) and any(r["form"] for r in got)


def test_null_ids_other_columns_and_no_rows(spark):
    rows = [(None, "Colourful colourful", "x"), (None, None, "y"), (1, "colourful", "z")]
    words = op.vocabulary(spark.createDataFrame(rows, "doc_id long, text string, word string"))
    assert {tuple(r) for r in words.collect()} == set(expected_words([r[:2] for r in rows]).items())
    none = spark.createDataFrame([], "doc_id long, text string")
    assert op.variants(op.vocabulary(none)).collect() == []


def test_query_equals_sql(spark, write, documents):
    rng = random.Random(16)
    stems = words_of(rng, 150, "abcÀé", (7, 8)) + ["colourful", "Colorful", "neighbour"]
    texts = [None, "", *[" ".join(rng.choice(stems[:rng.choice([3, 20, 150])]) for _ in range(60)) for _ in range(60)]]
    where = write(documents=documents(*texts))
    duck = duckdb.connect()
    duck.execute(f"create view documents as select * from '{where}/documents.parquet/*.parquet'")
    cursor = duck.execute(oracle.OP12)
    got = op.op12_spelling_variants(spark, where).select(*[c[0] for c in cursor.description]).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, cursor.fetchall())) and any(r["form"] for r in got)
