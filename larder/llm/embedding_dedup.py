"""Near-duplicate vectors: spherical k-means cells, blocked cosine products within them.

Centroids are trained in numpy on a bounded sample; every vector is then put into the
cells of its ``PROBES`` nearest centroids, and all pairs of a cell are compared in
double precision. A pair that meets in several cells counts in the first of them. Cells
larger than a tile are cut, and their pairs of tiles are separate groups.
"""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import stage, table
from larder.llm.components import components
from larder.llm.grouped import Union, over_groups, tiled

COSINE = 0.95  # fixed by the contract
SAMPLE = 16_384  # vectors that the centroids are trained on, about nine tenths of these are picked
CELL = 256  # vectors of a cell, on average, until there are MOST cells
MOST = 2048
PROBES = 4
ROUNDS = 8
TILE = 1024
_BLOCK = 512


def unit(vectors) -> np.ndarray:
    rows = np.asarray([np.asarray(v, dtype=np.float64) for v in vectors])
    # scaled first, so that squares neither overflow nor vanish
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def train(vectors: np.ndarray, cells: int, rounds: int = ROUNDS, seed: int = 5) -> np.ndarray:
    """Unit centroids by spherical k-means; a cell that loses all its vectors keeps its place."""
    rng = np.random.default_rng(seed)
    centroids = vectors[rng.choice(len(vectors), size=min(cells, len(vectors)), replace=False)]
    for _ in range(rounds):
        nearest = np.concatenate([(vectors[i:i + 4096] @ centroids.T).argmax(axis=1) for i in range(0, len(vectors), 4096)])
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, vectors)
        size = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
        centroids = np.where(size > 1e-12, sums / np.maximum(size, 1e-12), centroids)
    return centroids


def distinct_vectors(vectors: DataFrame) -> DataFrame:
    """``node``, ``embedding``, ``copies``, ``first`` of the different vectors that can link.

    Left out are null, empty and zero vectors and those with null or non-finite parts.
    Copies are taken once, before anything is compared.
    """
    wide = F.transform("embedding", lambda x: x.cast("double"))
    bad = F.exists(wide, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    able = F.col("embedding").isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists("embedding", lambda x: x != 0)
    found = vectors.where(able).groupBy("embedding").agg(F.count("*").alias("copies"), F.min("vec_id").alias("first"))
    # a vector without any id gets a name below all ids
    return found.withColumn("node", F.coalesce("first", -F.shiftrightunsigned(F.xxhash64("embedding"), 2) - F.lit(1 << 61)))


def cells_of(nodes: DataFrame, dim: int, probes: int = PROBES) -> DataFrame:
    """Adds ``cells``, the nearest cells in falling order, to the vectors of one length."""
    n = nodes.count()
    cells = max(1, min(MOST, n // CELL))
    # by hash, so that no task or driver puts vectors in order
    share = min(1.0, 0.9 * SAMPLE / max(n, 1))
    picked = nodes.select("embedding").where(F.pmod(F.xxhash64("embedding"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1).collect()
    if not picked:
        picked = nodes.select("embedding").limit(1).collect()
    centroids = train(unit(sorted(r[0] for r in picked)), cells)
    shared = nodes.sparkSession.sparkContext.broadcast(centroids)

    def nearest(batches):
        for batch in batches:
            if batch.empty:
                continue
            sims = unit(batch["embedding"]) @ shared.value.T
            take = min(probes, sims.shape[1])
            top = np.argpartition(-sims, take - 1, axis=1)[:, :take] if take < sims.shape[1] else np.tile(np.arange(take), (len(batch), 1))
            yield batch.assign(cells=list(top.astype(np.int32)))

    kind = nodes.schema["embedding"].dataType.simpleString()
    return nodes.mapInPandas(nearest, f"node long, copies long, embedding {kind}, cells array<int>")


def _links(rows: pd.DataFrame) -> pd.DataFrame:
    """For each vector of a pair of tiles that has links: how many, copies counted, and a star."""
    cell, second = int(rows["cell"].iloc[0]), rows["second"].to_numpy()
    rows = rows.iloc[np.argsort(second, kind="stable")]
    cut = int((~second).sum())
    vectors, copies = unit(rows["embedding"]), rows["copies"].to_numpy()
    own = [np.asarray(c) for c in rows["cells"]]
    # cells before this one that a vector lies in, padded with numbers that match nothing
    width = max(len(c) for c in own)
    earlier = np.full((len(own), width), -1, dtype=np.int64)
    for i, c in enumerate(own):
        c = c[c < cell]
        earlier[i, :len(c)] = c
    sides = [(0, cut), (cut, len(own))] if cut < len(own) else [(0, cut), (0, cut)]
    same = sides[0] == sides[1]
    links = np.zeros(len(own), dtype=np.int64)
    sets = Union(len(own))
    for a in range(*sides[0], _BLOCK):
        a_end = min(a + _BLOCK, sides[0][1])
        for b in range(a if same else sides[1][0], sides[1][1], _BLOCK):
            b_end = min(b + _BLOCK, sides[1][1])
            i, j = np.nonzero(vectors[a:a_end] @ vectors[b:b_end].T >= COSINE)
            i, j = i + a, j + b
            if same:
                i, j = i[i < j], j[i < j]
            met = np.zeros(len(i), dtype=bool)
            for k in range(width):
                met |= ((earlier[i] == earlier[j, k][:, None]) & (earlier[j, k][:, None] >= 0)).any(axis=1)
            fresh_i, fresh_j = i[~met], j[~met]
            links += np.bincount(fresh_i, weights=copies[fresh_j], minlength=len(own)).astype(np.int64)
            links += np.bincount(fresh_j, weights=copies[fresh_i], minlength=len(own)).astype(np.int64)
            sets.add(i, j)
    node = rows["node"].to_numpy()
    linked = (links > 0) | (sets.name != np.arange(len(own)))
    return pd.DataFrame({"node": node[linked], "links": links[linked], "star": node[sets.name[linked]]})


def link(cells: DataFrame, tile: int = TILE) -> DataFrame:
    """``node``, ``links``, ``star``: the parts of each vector's number of links, and edges that reach all."""
    keyed = cells.select("node", "copies", "embedding", "cells", F.explode("cells").alias("cell"), F.lit(0).alias("band"))
    dealt = tiled(keyed, ["cell"], "band", 0, "node", tile)
    return over_groups(dealt, ["cell", "one", "two"], [], _links, "node long, links long, star long")


def near_duplicates(vectors: DataFrame) -> DataFrame:
    """``embedding``, ``n_links``, ``component_id`` of the different vectors that can link.

    Vectors of different lengths never link. Null ids link like others and name no
    component unless there is no other id.
    """
    nodes = stage(distinct_vectors(vectors))
    lengths = sorted(r[0] for r in nodes.select(F.size("embedding")).distinct().collect())
    parts = []
    for dim in lengths:
        of_dim = nodes.where(F.size("embedding") == dim).select("node", "copies", "embedding")
        parts.append(stage(link(stage(cells_of(of_dim, dim)))))
    schema = "node long, links long, star long"
    links = parts[0] if parts else vectors.sparkSession.createDataFrame([], schema)
    for part in parts[1:]:
        links = links.unionByName(part)
    named = components(links.select(F.col("node").alias("a"), F.col("star").alias("b"))).withColumnRenamed("node", "n")
    sums = links.groupBy(F.col("node").alias("l")).agg(F.sum("links").alias("links"))
    found = stage(nodes.join(named, F.col("node") == F.col("n"), "left").join(sums, F.col("node") == F.col("l"), "left").select(
        "embedding", "first", F.coalesce("name", "node").alias("name"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    least = found.groupBy(F.col("name").alias("m")).agg(F.min("first").alias("component_id"))
    return found.join(least, F.col("name") == F.col("m")).select("embedding", "n_links", "component_id")


def op10_embedding_dedup(spark, sf_dir: str) -> DataFrame:
    """Links, component and verdict of every vector; one that links with nothing is its own component."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    found = stage(near_duplicates(vectors)).withColumnRenamed("embedding", "e")
    component = F.coalesce("component_id", "vec_id")
    return vectors.join(found, F.col("embedding") == F.col("e"), "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), component.alias("component_id"),
        (F.col("vec_id") == component).alias("kept"))
