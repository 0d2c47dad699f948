"""Measures against plain counting, cutoffs against exact binomial tails."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from larder.llm import quality_rules as op

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    places = {}
    for i in range(len(words) - 7):
        places.setdefault(tuple(words[i:i + 8]), []).append(i)
    repeated = {j for v in places.values() if len(v) > 1 for i in v for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated),
            len(words) < 20 or 100 * len(repeated) > 30 * len(words))


def texts():
    rng = random.Random(2)
    bits = ["a", "b", "the", "Éa😀", "#*", "x|y", " ", "\n", "\t", "\x0b", "\x1f", "　", "a b a b a b a b", "line one\n", "<>"]
    out = [" ".join(rng.choice(bits) for _ in range(rng.choice([0, 3, 8, 9, 25, 80]))) for _ in range(120)]
    return [None, "", " \n", *out, out[5], "w " * 50_000, " ".join(map(str, range(30_000))), "same line\n" * 40]


def test_measures(spark, documents, write):
    given = texts()
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = op.op3_quality_rules(spark, write(documents=documents(*given), labels=labels)).collect()
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in rows}
    assert got == {i: plain(t) for i, t in enumerate(given)}
    # without labels nothing can be shown to be safe
    assert all(r.kept == (not r.base_failed) for r in rows)


@pytest.mark.parametrize("k, n, p", [(0, 1, 0.5), (0, 500, 0.005), (3, 500, 0.005), (40, 20_000, 0.005), (499, 500, 0.9)])
def test_binomial_tail(spark, k, n, p):
    got = spark.range(1).select(op.binomial_cdf(F.lit(k).cast("long"), F.lit(n).cast("long"), p)).first()[0]
    logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log(1 - p) for i in range(k + 1)]
    assert got == pytest.approx(sum(map(math.exp, logs)), rel=1e-9)


def tail(k, n, p):
    return sum(math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log(1 - p)) for i in range(k + 1))


def test_cutoffs_are_the_strictest_safe_ones(spark):
    rng = random.Random(5)
    rows = []
    for i in range(6000):
        stratum = "en" if i % 3 else "de"
        shares = [rng.betavariate(1, 60), 0.0, rng.choice([0.0, 0.0, 0.0, 0.3]), rng.betavariate(1, 20)]
        rows.append((i, (stratum, shares), int(rng.random() < 0.9)))
    rows.append((6000, ("tiny", [0.0] * 4), 1))
    frame = spark.createDataFrame(rows, "doc_id long, q struct<stratum:string, shares:array<double>>, quality int")
    labels = frame.select("doc_id", "quality").unionByName(frame.select("doc_id", F.lit(None).cast("int").alias("quality")))
    got = {r.stratum: r.limits for r in op.fit_cutoffs(frame.select("doc_id", "q"), labels).collect()}
    want = {}
    for stratum in ("en", "de", "tiny"):
        good = [q[1] for _, q, y in rows if q[0] == stratum and y]
        want[stratum] = []
        for rule in range(4):
            best = None
            for cutoff in op.CUTOFFS:
                k = sum(s[rule] > cutoff for s in good)
                if tail(k, len(good), op.RISK / 4) > op.DELTA / 12:
                    break
                best = cutoff
            want[stratum].append(best)
    assert got == want and want["tiny"] == [None] * 4 and any(want["en"])


def test_filter_keeps_columns(spark, documents):
    words = " ".join(map(str, range(30)))
    docs = documents(words, "short", None, words).selectExpr("*", "5 as q", "6 as stratum", "7 as doc")
    labels = spark.createDataFrame([(0, 1, None)], "doc_id long, quality int, toxic int")
    kept = op.keep_good(docs, labels)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [0, 3]
    assert op.keep_good(docs.where("false"), labels).collect() == []
