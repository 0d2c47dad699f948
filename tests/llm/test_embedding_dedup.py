"""Links, components and recall against all pairs."""

import random

import numpy as np
import pytest

from larder.llm import embedding_dedup as op

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows):
    able = [i for i, (_, v, _) in enumerate(rows)
            if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    unit = {i: np.array(rows[i][1], dtype=np.float64) for i in able}
    unit = {i: v / np.linalg.norm(v) for i, v in unit.items()}
    name, links = {i: i for i in range(len(rows))}, [0] * len(rows)

    def find(x):
        while name[x] != x:
            x = name[x]
        return x

    for a in able:
        for b in able:
            if a < b and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.95:
                links[a] += 1
                links[b] += 1
                x, y = find(a), find(b)
                name[max(x, y)] = min(x, y)
    return [(rows[i][0], links[i], rows[find(i)][0], find(i) == i) for i in range(len(rows))]


def vectors(seed=1, groups=120, copies=40):
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(groups):
        centre = rng.normal(size=16)
        out += [centre + rng.normal(size=16) * rng.choice([0.02, 0.1, 0.3]) for _ in range(rng.integers(1, 6))]
    crowd = rng.normal(size=16)
    out += [crowd + rng.normal(size=16) * 0.05 for _ in range(150)]
    out += [out[0]] * copies + [out[3] * 7.0, -out[3]]
    rows = [v.astype(np.float32).tolist() for v in out]
    rows += [None, [], [0.0] * 16, [None] + [1.0] * 15, [float("nan")] + [1.0] * 15, [float("inf")] + [1.0] * 15, [1.0, 2.0], [2.0, 4.0], rows[5]]
    order = list(range(len(rows)))
    random.Random(2).shuffle(order)
    return [(i, rows[k], 0) for i, k in enumerate(order)]


@pytest.mark.parametrize("cell, tile", [(256, 1024), (40, 16)])
def test_query(spark, write, monkeypatch, cell, tile):
    monkeypatch.setattr(op, "CELL", cell)
    monkeypatch.setattr(op.link, "__defaults__", (tile,))
    rows = vectors()
    got = op.op10_embedding_dedup(spark, write(embeddings=spark.createDataFrame(rows, SCHEMA))).collect()
    want = brute(rows)
    assert sorted(r.vec_id for r in got) == [w[0] for w in want]
    by = {r.vec_id: r for r in got}
    found, all_ = sum(r.n_links for r in got), sum(w[1] for w in want)
    # links are never made up, and nearly all are found
    assert all(by[i].n_links <= n for i, n, _, _ in want) and found >= 0.99 * all_ > 0
    if found == all_:
        assert [(w[0], by[w[0]].n_links, by[w[0]].component_id, by[w[0]].kept) for w in want] == want


def test_no_vectors_and_clashing_columns(spark, write):
    empty = spark.createDataFrame([], SCHEMA)
    assert op.op10_embedding_dedup(spark, write(embeddings=empty)).collect() == []
    rows = spark.createDataFrame([(None, [1.0, 0.0], 0), (4, [1.0, 0.0], 0), (4, [1.0, 0.0], 0), (2, None, 0)], SCHEMA)
    found = op.near_duplicates(rows.selectExpr("*", "1 as node", "2 as cells", "3 as first")).collect()
    assert [(r.n_links, r.component_id) for r in found] == [(2, 4)]


@pytest.mark.parametrize("kind", ["float", "double"])
def test_vectors_keep_their_precision(spark, write, kind):
    def at(cosine):
        return [cosine, (1 - cosine * cosine) ** 0.5]

    rows = [(0, [1.0, 0.0]), (1, at(0.95 + 1e-10)), (2, [0.0, 5.0, 0.0]), (3, [v for c in (0.95 - 1e-10,) for v in (0.0, c, (1 - c * c) ** 0.5)])]
    where = write(embeddings=spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>"))
    got = {r["vec_id"]: r["n_links"] for r in op.op10_embedding_dedup(spark, where).collect()}
    if kind == "double":
        assert got == {0: 1, 1: 1, 2: 0, 3: 0}
