"""The stages, each on what the one before kept, against plain steps."""

import random
import re
from collections import Counter
from pathlib import Path

import corpus_pipeline
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from larder.llm import mixing, quality_rules, secret_scan
from larder.llm.common import passing_tables, shared_folder, stage

from .test_secret_scan import plain as secret_spans
from .test_simhash_dedup import classes, fingerprint


def fixture():
    rng = random.Random(11)
    words = [f"word{i}" for i in range(500)]
    rows = []
    for i in range(60):
        text = " ".join(rng.choices(words, k=rng.choice([5, 30, 90])))
        if i % 7 == 0:
            text += f" password=hunter2{i}hunter2 and AKIAABCDEFGHIJKL{i:04d} end"
        rows.append((text, "en", rng.choice(["a", "b", "c", None])))
    rows += [rows[3], (rows[4][0].upper(), "en", "b"), ("same eight words again and again here now " * 9, "en", "a"), (None, None, None), ("", "en", "a")]
    return rows


def test_stages(spark, documents, write):
    rows = fixture()
    labels = spark.createDataFrame([(0, 1, 0)], "doc_id long, quality int, toxic int")
    folder = write(documents=documents(*rows), labels=labels)
    docs = spark.read.parquet(f"{folder}/documents.parquet").selectExpr("*", "'x' as row")
    out = []
    for i, (_, step) in enumerate(corpus_pipeline.STAGES):
        docs = step(spark, docs, folder)
        if i < 4:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "row"]
            docs = spark.createDataFrame(docs.collect(), docs.schema)
        out.append(docs.collect())
    good = [i for i, (t, _, _) in enumerate(rows) if t and len(t.split()) >= 20 and "same eight" not in t]
    assert sorted(r.doc_id for r in out[0]) == good
    names = classes([fingerprint(rows[i][0]) for i in good])
    firsts = sorted({good[n] for n in names})
    assert sorted(r.doc_id for r in out[1]) == firsts
    for r in out[2]:
        text = rows[r.doc_id][0]
        for a, _, b, _ in sorted(secret_spans(text), reverse=True):
            text = text[:a] + "[SECRET]" + text[b:]
        assert r.text == text and r.n_chars == len(text)
    masked = {r.doc_id: r.text for r in out[2]}
    sizes = Counter()
    for r in out[2]:
        sizes[r.source] += len(r.text.split())
    plan = {p["source"]: p for p in mixing.plan(list(sizes.items()))}
    taken = Counter()
    for r in out[3]:
        taken[r.source] += len(r.text.split())
        assert set(r.text.split()) <= set(masked[r.doc_id].split()) and r.n_chars == len(r.text)
    assert all(abs(taken[s] - p["target"]) <= 16 for s, p in plan.items())
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = sorted((r.doc_id, library.encode(r.text, add_special_tokens=False).ids) for r in out[3])
    assert sorted((r.doc_id, r.ids) for r in out[4]) == want and all(r.exact and r.n_tokens == len(r.ids) for r in out[4])


def tables(spark):
    """The tables that stages have left in the shared folder."""
    root = Path(shared_folder(spark).removeprefix("file:")).parent
    return set(root.iterdir()) if root.exists() else set()


def test_tables_go_on_failure(spark):
    before = tables(spark)
    with pytest.raises(ZeroDivisionError), passing_tables(spark):
        kept = stage(spark.range(3), shared_folder(spark))
        stage(spark.range(3))
        raise ZeroDivisionError
    assert kept.count() == 3 and len(tables(spark) - before) == 1


def test_run_equals_stages_and_empty_table(spark, documents, write):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = fixture()[:12]
    folder = write(documents=documents(*rows), labels=labels)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, step in corpus_pipeline.STAGES:
        docs = step(spark, docs, folder)
    want = sorted((r.doc_id, r.ids) for r in docs.collect())
    before = tables(spark)
    result = corpus_pipeline.run(spark, folder)
    assert sorted((r.doc_id, r.ids) for r in result.collect()) == want
    # what the last stage reads: the mix and its frequent words
    assert len(tables(spark) - before) <= 3
    docs = documents("x").where("false")
    for _, step in corpus_pipeline.STAGES:
        docs = step(spark, docs, folder)
    assert docs.collect() == [] and re.fullmatch("doc_id.*", docs.columns[0])


def plan_of(df, kind="optimizedPlan"):
    return getattr(df._jdf.queryExecution(), kind)().toString()


def test_labels_move_no_text(spark, documents, monkeypatch):
    measured, measure = [], quality_rules.measure
    monkeypatch.setattr(quality_rules, "measure", lambda docs: measured.append(docs) or measure(docs))
    quality_rules.keep_good(documents(*fixture()), spark.createDataFrame([(0, 1)], "doc_id long, quality int"))
    assert measured and not [d for d in measured if "Join" in plan_of(d)]


def test_texts_without_candidates_meet_no_spans(spark, documents):
    docs = documents(*fixture())
    masked = secret_scan.mask(docs)
    joined = [line for line in plan_of(masked).split("\n") if "Filter" in line and "isnotnull(own_digest" in line]
    assert joined and "Union" in plan_of(masked)
    assert Counter(r.doc_id for r in masked.collect()) == Counter(range(docs.count()))


def test_mix_moves_rows_once(spark, documents):
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        plan = plan_of(mixing.mix(documents(*fixture())), "executedPlan")
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    between = plan[plan.index("Window"):plan.index("SortMergeJoin")]
    assert "Exchange" not in between
