"""Targets, seats and takes against plain arithmetic."""

import random
import time

import pytest
from pyspark.sql import functions as F

from larder.llm import mixing as op
from larder.llm.common import n_words


def test_excess_is_shared_again():
    assert op.fill([100, 100, 100], (5, 2, 1), 450) == pytest.approx([200, 500 / 3, 250 / 3])
    assert op.fill([10, 0, 1000], (5, 2, 1), 1515) == pytest.approx([20, 0, 1495])
    assert op.fill([], (), 0) == [] and op.fill([0, 0], (5, 2), 0) == [0, 0]


@pytest.mark.parametrize("seed", range(10))
def test_seats_go_by_highest_quotients(seed):
    rng = random.Random(seed)
    targets = [rng.uniform(0, 100) for _ in range(rng.randint(1, 8))]
    seats = rng.randint(0, 400)
    won = [0] * len(targets)
    for _ in range(seats):
        won[max(range(len(targets)), key=lambda i: (targets[i] / (2 * won[i] + 1), -i))] += 1
    assert op.apportion(targets, seats, [10**6] * len(targets)) == won


def sources(rng):
    rows = []
    for i in range(500):
        source = rng.choice(["src0"] * 6 + ["src1", "src10", "src2", "é", None])
        rows.append((" ".join(f"w{i}.{k}" for k in range(rng.choice([0, 1, 7, 40, 200]))), "en", source))
    return [*rows, (None, "en", "src1"), ("", None, None), ("only blank \n here", "en", "zero"), (" ", "en", "empty")]


def test_query(spark, documents, write):
    rows = sources(random.Random(1))
    folder = write(documents=documents(*rows))
    got = op.op9_mixing(spark, folder).collect()
    assert len(got) == len(rows)
    sizes, taken, targets = {}, {}, {}
    for r in got:
        text, _, source = rows[r.doc_id]
        assert r.size == len((text or "").split()) and 0 <= r.taken <= 2 * r.size
        sizes[source] = sizes.get(source, 0) + r.size
        taken[source] = taken.get(source, 0) + r.taken
        targets[source] = r.target
    assert all(r.source_size == sizes[rows[r.doc_id][2]] for r in got)
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = op.fill([sizes[s] for s in order], [(5, 2, 1)[i % 3] for i in range(len(order))], 1.5 * sum(sizes.values()))
    assert [targets[s] for s in order] == pytest.approx(want)
    assert all(abs(taken[s] - targets[s]) <= 16 for s in order)
    again = op.op9_mixing(spark, folder).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_rows_of_the_mix(spark, documents):
    rows = sources(random.Random(2))
    docs = documents(*rows).selectExpr("*", "1 as mix", "2 as size", "3 as row", "4 as `lot`")
    size = n_words(F.col("text"))
    out = op.mix(docs)
    assert out.columns == docs.columns
    words = {}
    for r in out.collect():
        whole = rows[r.doc_id][0]
        found = r.text.split()
        assert found and set(found) <= set(whole.split()) and r.n_chars == len(r.text)
        words.setdefault(r.doc_id, []).extend(found)
    query = {}
    for r in op.place(documents(*rows), op.fit(docs, size), size).collect():
        query[r.doc_id] = sum((x.high - x.low) * x.times for x in r.mix.runs)
    assert {i: n for i, n in query.items() if n} == {i: len(w) for i, w in words.items()}
    assert op.mix(docs.where("false")).collect() == []


def test_repeated_rows(spark, documents):
    docs = documents(*[("a b c", "en", "s")] * 40)
    docs = docs.withColumn("doc_id", F.lit(None).cast("long"))
    assert sum(len(r.text.split()) for r in op.mix(docs).collect()) == pytest.approx(180, abs=4)


def test_small_sources_beside_a_large_one(spark):
    # the small ones are under half a block, a block and a part, or end in a part of one
    sizes = {"big": [20_000] * 4000, "a": [100] * 3, "b": [450], "c": [1000] * 2, "d": [1500] * 2, "e": [1]}
    rows = [(s, n) for s, ns in sizes.items() for n in ns]
    docs = spark.createDataFrame([(i, s, n) for i, (s, n) in enumerate(rows)], "doc_id long, source string, n long")
    taken, targets, seen = {}, {}, {}
    for r in op.place(docs, op.fit(docs, F.col("n")), F.col("n")).collect():
        assert [x.low for x in r.mix.runs] == [0, *[x.high for x in r.mix.runs][:-1]] and r.mix.runs[-1].high == r.n
        assert all(0 <= x.times <= 2 for x in r.mix.runs)
        taken[r.source] = taken.get(r.source, 0) + sum((x.high - x.low) * x.times for x in r.mix.runs)
        targets[r.source] = r.mix.target
        seen[r.source] = seen.get(r.source, 0) + r.n
    assert seen == {s: sum(ns) for s, ns in sizes.items()}
    assert {s: targets[s] for s in "abcde"} == {"a": 600, "b": 900, "c": 4000, "d": 6000, "e": 2}
    assert all(abs(taken[s] - targets[s]) <= 1 for s in sizes)


@pytest.mark.parametrize("shards,blocks", [(1, 3), (2, 5), (16, 4096)])
def test_takes_are_whole_in_words(spark, monkeypatch, shards, blocks):
    real = op.plan
    monkeypatch.setattr(op, "plan", lambda totals: real(totals, shards, blocks))
    rng = random.Random(shards)
    rows = [(rng.choice("aaaab"), rng.choice([0, 1, 13, 90])) for _ in range(300)] + [("c", 1), ("d", 7)]
    docs = spark.createDataFrame([(i, s, n) for i, (s, n) in enumerate(rows)], "doc_id long, source string, n long")
    taken, targets = {}, {}
    for r in op.place(docs, op.fit(docs, F.col("n")), F.col("n")).collect():
        taken[r.source] = taken.get(r.source, 0) + sum((x.high - x.low) * x.times for x in r.mix.runs)
        targets[r.source] = r.mix.target
    assert all(abs(taken[s] - targets[s]) <= 1 for s in targets)
    assert sum(taken.values()) == round(sum(targets.values()))


def test_many_sources_are_planned_in_seconds():
    rng = random.Random(22)
    totals = [(f"host{i}", rng.choice([1, 5, 40, 3000])) for i in range(100_000)]
    start = time.monotonic()
    rows = op.plan(totals)
    assert time.monotonic() - start < 60 and len(rows) == len(totals)
    assert all(abs(r["times"] * max(1, r["source_size"]) + r["rest"] - r["target"]) <= 16 for r in rows)
    assert all(r["target"] <= 2 * r["source_size"] for r in rows)


def test_fill_equals_rounds():
    rng = random.Random(23)
    for _ in range(200):
        sizes = [rng.choice([0, 1, 7, 100, 10_000]) for _ in range(rng.randint(1, 12))]
        weights = [op.WEIGHTS[i % 3] for i in range(len(sizes))]
        budget = 1.5 * sum(sizes)
        want, open_ = [0.0] * len(sizes), set(range(len(sizes)))
        left = budget
        while open_:
            share = {i: left * weights[i] / sum(weights[j] for j in open_) for i in open_}
            above = [i for i in open_ if share[i] > 2 * sizes[i]]
            for i in above or open_:
                want[i] = 2.0 * sizes[i] if above else share[i]
            open_ -= set(above or open_)
            left = budget - sum(want[i] for i in range(len(sizes)) if i not in open_)
        assert op.fill(sizes, weights, budget) == pytest.approx(want)
