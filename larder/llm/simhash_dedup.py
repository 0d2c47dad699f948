"""SimHash near-duplicates by tiled exact comparison.

Different fingerprints meet in tiles: exclusive-or and bit counts of all pairs of a
tile, block by block, skipping blocks and pairs of tiles whose own bit counts differ by
more than the radius. So that the work stays near the number of fingerprints, tiles are
cut from tables that lose no pair: with the 64 bits in ``p`` pieces and at most
``RADIUS`` bits apart, some ``p - RADIUS`` pieces are equal, so each choice of as many pieces
is a table whose rows meet where these are equal. ``p`` grows with the number of
fingerprints, for buckets of about a tile.
"""

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from larder.llm.common import stage, table
from larder.llm.components import components
from larder.llm.grouped import Union, over_groups, tiled

# Fixed by the contract.
SHINGLE = 4
SEED = 42
RADIUS = 4
TILE = 4096
_BLOCK = 1024
_RUN = 1 << 16


def fingerprint(text: str | None, width: int = SHINGLE) -> int:
    """Majority bits of the hashes of a text's shingles; 0 for a text without words."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return 0
    joined = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), dtype=np.int64, count=len(found)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(found) - width + 1)
    starts, ends = starts[:n].tolist(), ends[len(found) - n:].tolist()
    digest = xxhash.xxh64_intdigest
    bits = np.zeros(64, dtype=np.int64)
    for at in range(0, n, _RUN):
        hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts[at:at + _RUN], ends[at:at + _RUN])], dtype="<u8")
        bits += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * bits > n, bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``fp`` (the fingerprint as a signed long) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t) for t in batch.column("text").to_pylist()], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(prints)], names=["doc_id", "fp"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, fp long")


def masks(n: int, radius: int = RADIUS, tile: int = TILE) -> list[int]:
    """The bits that each table compares, for n fingerprints; the last and finest choice is radius + 4 pieces."""
    for pieces in range(radius + 1, radius + 5):
        edges = [round(64 * i / pieces) for i in range(pieces + 1)]
        bits = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
        chosen = [sum(c) for c in combinations(bits, pieces - radius)]
        if n >> min(m.bit_count() for m in chosen) <= tile // 8:
            break
    return chosen


def _links(rows: pd.DataFrame) -> pd.DataFrame:
    """Stars over the fingerprints of one pair of tiles that are linked to each other."""
    prints = rows["fp"].to_numpy().view(np.uint64)
    second = rows["second"].to_numpy()
    counts = np.bitwise_count(prints).astype(np.int16)
    order = np.lexsort((counts, second))
    prints, counts, cut = prints[order], counts[order], int((~second).sum())
    sides = [(0, cut), (cut, len(prints))] if cut < len(prints) else [(0, cut), (0, cut)]
    sets = Union(len(prints))
    for a in range(*sides[0], _BLOCK):
        a_end = min(a + _BLOCK, sides[0][1])
        for b in range(a if sides[0] == sides[1] else sides[1][0], sides[1][1], _BLOCK):
            b_end = min(b + _BLOCK, sides[1][1])
            if counts[b] - counts[a_end - 1] > RADIUS or counts[a] - counts[b_end - 1] > RADIUS:
                continue
            near = np.bitwise_count(prints[a:a_end, None] ^ prints[None, b:b_end]) <= RADIUS
            i, j = np.nonzero(near)
            sets.add(i + a, j + b)
    linked = np.flatnonzero(sets.name != np.arange(len(prints)))
    signed = prints.view(np.int64)
    return pd.DataFrame({"a": signed[linked], "b": signed[sets.name[linked]]})


def link(prints: DataFrame, tile: int = TILE) -> DataFrame:
    """Edges ``a``, ``b`` that reach between all of the different fingerprints ``fp`` that are linked."""
    chosen = [m - (1 << 64) if m >> 63 else m for m in masks(prints.count(), tile=tile)]
    keyed = prints.select("fp", F.bit_count("fp").cast("int").alias("bits"),
                          F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in chosen])).alias("table", "piece"))
    dealt = tiled(keyed, ["table", "piece"], "bits", RADIUS, "fp", tile)
    return over_groups(dealt, ["table", "piece", "one", "two"], [], _links, "a long, b long")


def _named(prints: DataFrame) -> DataFrame:
    """``fp``, ``first`` (its least id) and ``name`` of its component, from rows of ``doc_id``, ``fp``."""
    firsts = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("first")))
    named = components(link(firsts.select("fp"))).withColumnRenamed("node", "fp")
    return stage(firsts.join(named, "fp", "left").withColumn("name", F.coalesce("name", "fp")))


def classes(prints: DataFrame) -> DataFrame:
    """``fp`` and ``component_id`` from rows of ``doc_id``, ``fp``: the least id reachable.

    Null ids link like others but name no component unless there is no other.
    """
    named = _named(prints)
    least = named.groupBy(F.col("name").alias("n")).agg(F.min("first").alias("component_id"))
    return named.join(least, F.col("name") == F.col("n")).select("fp", "component_id")


def op7_simhash(spark, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document.

    Copies share a fingerprint and are taken once before anything is compared.
    """
    prints = stage(with_fingerprint(table(spark, sf_dir, "documents")))
    found = stage(classes(prints)).withColumnRenamed("fp", "p")
    return prints.join(found, F.col("fp") == F.col("p")).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@F.pandas_udf(LongType())
def _print(text: pd.Series) -> pd.Series:
    return pd.Series(np.array([fingerprint(t) for t in text], dtype=np.uint64).view(np.int64))


def keep_first(docs: DataFrame) -> DataFrame:
    """One row of each component of ``docs``, the one of least doc_id, columns as they came.

    Ids may be null or shared by unlike texts; null ones come last, and of equal ones the least
    fingerprint stays. Rows that share id and fingerprint are copies; one of them stays, by its
    other columns in order.
    """
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    # a struct equals another where both ids are null
    rows = stage(docs.select(own.alias("row"), F.struct(_print("text").alias("fp"), F.col("doc_id").alias("first")).alias("key")))
    named = _named(rows.select(F.col("key.fp").alias("fp"), F.col("key.first").alias("doc_id")))
    order = F.struct(F.col("first").isNull(), F.col("first"), F.col("fp"))
    firsts = stage(named.groupBy("name").agg(F.min_by(F.struct("fp", "first"), order).alias("key"))).select("key")
    # maps have no order
    by = F.struct(*[F.col(f"row.`{c}`") for c, kind in docs.dtypes if "map<" not in kind])
    # Copies shrink to one row before they move, so that no key is large, and rows move once: the join
    # finds them dealt out by its key.
    return rows.groupBy("key").agg(F.min_by("row", by).alias("row")).join(firsts, "key", "left_semi").select("row.*")
