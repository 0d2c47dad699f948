"""Byte-balanced shards of indivisible groups by Karmarkar-Karp differencing.

A group is all rows of one text and goes to one shard as a whole. Every group starts as
a partial partition (its bytes, 0, ..., 0); the two partial partitions of largest spread
are combined in opposite order, again and again, until one is left.

Spark spreads this over buckets of groups. Groups above ``1 / (shards * 64)`` of all
bytes, at most ``shards * 64`` of them, are settled first. Every bucket then starts
with its share of that result as one more partial partition, so that small groups make
up for what the large ones leave uneven. What remains is the spread of each bucket,
which is small against its smallest groups.
"""

import heapq
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from larder.llm.common import stage, table

SHARDS = 16
HEAVY = 64  # groups above 1 / (shards * HEAVY) of all bytes are settled first
BUCKET_GROUPS = 20_000  # groups of one bucket, on average
LOTS = 256  # a shard's rows are numbered in so many lots


def difference(items: list[list[int]]) -> list[list[int]]:
    """For each partial partition (sums per part), the final part that each part ends up in."""
    parts = len(items[0])
    # a node: its sums in falling order, and for each of them the part of either child
    trees: list[tuple] = []
    heap = []
    for i, sums in enumerate(items):
        order = sorted(range(parts), key=lambda j: (-sums[j], j))
        falling = [sums[j] for j in order]
        trees.append((order, None))
        heap.append((falling[-1] - falling[0], i, falling))
    heapq.heapify(heap)
    while len(heap) > 1:
        _, a, left = heapq.heappop(heap)
        _, b, right = heap[0]
        sums = [x + y for x, y in zip(left, reversed(right))]
        order = sorted(range(parts), key=lambda j: -sums[j])
        falling = [sums[j] for j in order]
        trees.append((order, (a, b)))
        heapq.heapreplace(heap, (falling[-1] - falling[0], len(trees) - 1, falling))
    places: list[list[int]] = [[] for _ in trees]
    places[heap[0][1]] = list(range(parts))  # for each sum of the node in falling order, its final part
    for node in range(len(trees) - 1, -1, -1):
        order, children = trees[node]
        if children:
            own = [0] * parts
            for place, j in enumerate(order):
                own[j] = places[node][place]
            places[children[0]] = own
            places[children[1]] = own[::-1]
            places[node] = []
        else:
            own = [0] * parts
            for place, j in enumerate(order):
                own[j] = places[node][place]
            places[node] = own
    return places[: len(items)]


def assign(keys: list, sizes: list[int], seed: list[int]) -> dict:
    """A shard for each key, balancing the sums of ``seed``, which stand at shard 0, 1, ...."""
    rest = len(seed) - 1
    items = [list(seed), *([size] + [0] * rest for size in sizes)]
    places = difference(items)
    shard = {part: j for j, part in enumerate(places[0])}
    return {key: shard[place[0]] for key, place in zip(keys, places[1:])}


def groups(docs: DataFrame) -> DataFrame:
    """One row per document with ``size``, ``text_crc32`` and ``group``: doc_id and its text's digest.

    Null texts form one group of size 1 each and have the checksum of the empty text.
    """
    text = F.col("text")
    return docs.select(
        "doc_id", (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
        F.coalesce(F.sha2(text, 256), F.lit("")).alias("group"))


def shard_groups(rows: DataFrame, shards: int = SHARDS, bucket_groups: int = BUCKET_GROUPS) -> DataFrame:
    """A row per group: ``group``, ``shard``."""
    spark = rows.sparkSession
    sums = stage(rows.groupBy("group").agg(F.sum("size").alias("bytes")))
    total, n = sums.agg(F.coalesce(F.sum("bytes"), F.lit(0)), F.count("*")).first()
    least = total // (shards * HEAVY)
    heavy = sums.where(F.col("bytes") > least).orderBy(F.desc("bytes"), "group").collect()
    settled = assign([r["group"] for r in heavy], [r["bytes"] for r in heavy], [0] * shards)
    loads = np.zeros(shards, dtype=np.int64)
    for r in heavy:
        loads[settled[r["group"]]] += r["bytes"]
    buckets = max(1, math.ceil(n / bucket_groups))
    share = [int(x) // buckets for x in loads]

    def settle_bucket(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["bytes", "group"], ascending=[False, True])
        # shards in another order in each bucket, as equal loads are told apart by order
        turn = np.random.default_rng(int(pdf["bucket"].iloc[0])).permutation(shards)
        found = assign(pdf["group"].tolist(), pdf["bytes"].tolist(), [share[j] for j in turn])
        return pd.DataFrame({"group": pdf["group"], "shard": [int(turn[found[g]]) for g in pdf["group"]]}).astype({"shard": "int32"})

    light = sums.where(F.col("bytes") <= least).withColumn("bucket", F.pmod(F.xxhash64("group"), F.lit(buckets)))
    spread = light.groupBy("bucket").applyInPandas(settle_bucket, "group string, shard int")
    fixed = spark.createDataFrame([(g, s) for g, s in settled.items()], "group string, shard int")
    return spread.unionByName(fixed)


def number(assigned: DataFrame, lots: int = LOTS) -> DataFrame:
    """Adds ``slot``, gapless from 0 in each shard: numbered in lots, after the rows of the lots before."""
    lot = F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(lots))
    rows = assigned.withColumn("lot", lot)
    before = Window.partitionBy("shard").orderBy("lot").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("shard", "lot").agg(F.count("*").alias("n")).select(
        "shard", "lot", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy("shard", "lot").orderBy("doc_id", "text_crc32", "size")
    return rows.withColumn("place", F.row_number().over(within)).join(starts, ["shard", "lot"]).withColumn(
        "slot", (F.col("start") + F.col("place") - 1).cast("long")).drop("lot", "place", "start")


def op6_sharding(spark, sf_dir: str) -> DataFrame:
    """Shard and slot of every document under the law of near-equal bytes."""
    rows = stage(groups(table(spark, sf_dir, "documents").select("doc_id", "text")))
    assigned = stage(rows.join(shard_groups(rows), "group").drop("group"))
    return number(assigned).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
