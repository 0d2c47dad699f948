"""Mixing sources to target weights by Sainte-Laguë apportionment.

The budget is dealt to shards; the sources of a shard get words by highest quotients
(target over 1, 3, 5, ...). The words of a source stand in a seeded order, cut into blocks;
its quota takes every block equally often, but for a seeded choice of blocks that it
takes once more, the last of them in part. So sources smaller than a block get their due.
"""

import heapq
import math
import re
import zlib
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType
from pyspark.sql.window import Window

from larder.llm.common import WORD, Aside, n_words, stage, table
from larder.operators.settle import settle

# Fixed by the contract: weights in turn, the budget's share of all words, the most repeats.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
REPEATS = 2
SHARDS = 16
BLOCKS_PER_SHARD = 4096
LOTS = 1024  # each source's documents are ordered and summed up in so many lots
SEED = 17


def fill(sizes: Sequence[int], weights: Sequence[float], budget: float, most: float = REPEATS) -> list[float]:
    """Shares of the budget by weight, each at most ``most`` times its size.

    What stands above its bound stays at it, and the excess goes to the others by
    weight, again until none is above.
    """
    targets = [0.0] * len(sizes)
    # whoever fills up first has least size for its weight, so one pass in that order finds all that do
    order = sorted(range(len(sizes)), key=lambda i: (sizes[i] / weights[i], i))
    left, total = float(budget), sum(weights)
    for at, i in enumerate(order):
        if left * weights[i] / total <= most * sizes[i]:
            for j in order[at:]:
                targets[j] = left * weights[j] / total
            break
        targets[i] = float(most * sizes[i])
        left, total = left - targets[i], total - weights[i]
    return targets


def apportion(targets: Sequence[float], seats: int, most: Sequence[int]) -> list[int]:
    """Seats by highest quotients, ties to the earlier one, none above its bound.

    Starts from the rounded shares, which are off by half a seat for each source at
    most, so few quotients are compared whatever the number of seats.
    """
    total = sum(targets)
    if not total:
        return [0] * len(targets)
    got = [min(m, math.ceil(t * seats / total - 0.5)) for t, m in zip(targets, most)]
    lack = seats - sum(got)
    able = [(-targets[i] / (2 * got[i] + 1), i) for i, m in enumerate(most) if got[i] < m and targets[i] > 0] if lack > 0 else []
    heapq.heapify(able)
    while lack > 0 and able:
        i = able[0][1]
        got[i], lack = got[i] + 1, lack - 1
        if got[i] < most[i]:
            heapq.heapreplace(able, (-targets[i] / (2 * got[i] + 1), i))
        else:
            heapq.heappop(able)
    held = [(targets[i] / (2 * g - 1), -i) for i, g in enumerate(got) if g > 0] if lack < 0 else []
    heapq.heapify(held)
    while lack < 0 and held:
        i = -held[0][1]
        got[i], lack = got[i] - 1, lack + 1
        if got[i] > 0:
            heapq.heapreplace(held, (targets[i] / (2 * got[i] - 1), -i))
        else:
            heapq.heappop(held)
    return got


def plan(totals: Sequence[tuple], shards: int = SHARDS, blocks: int = BLOCKS_PER_SHARD, seed: int = SEED) -> list[dict]:
    """A row per source from (source, size): its target, quotas per shard and seeded choice.

    Quotas are in words; together they take the source ``times`` times and ``rest`` words.
    ``step`` and ``shift`` place block i at (step * i + shift) modulo the number of
    blocks, a permutation; the first ``rest`` words of that order are taken once more.
    ``last`` is the place of the last block, which lacks ``short`` words.
    """
    totals = sorted(totals, key=lambda x: (x[0] is None, x[0] or ""))
    sizes = [size for _, size in totals]
    weights = [WEIGHTS[i % len(WEIGHTS)] for i in range(len(totals))]
    budget = SHARE * sum(sizes)
    targets = fill(sizes, weights, budget)
    length = max(1, int(sum(targets) // (shards * blocks)))
    of = [math.ceil(size / length) for size in sizes]
    seats = round(sum(targets))
    sums = [apportion(targets, round(seats * (s + 1) / shards), [REPEATS * size for size in sizes]) for s in range(shards)]
    rows = []
    for i, (source, size) in enumerate(totals):
        quotas = [b - a for a, b in zip([0, *[x[i] for x in sums]], [x[i] for x in sums])]
        step, n = zlib.crc32(f"{seed}:{source}:step".encode()) % max(1, of[i]), max(1, of[i])
        while math.gcd(step, n) != 1:
            step += 1
        shift = zlib.crc32(f"{seed}:{source}:shift".encode()) % n
        times, rest = divmod(sum(quotas), max(1, size))
        rows.append({"source": source, "source_size": size, "target": targets[i], "length": length, "blocks": of[i],
                     "quotas": quotas, "step": step, "shift": shift, "times": times, "rest": rest,
                     "last": (step * (n - 1) + shift) % n, "short": of[i] * length - size})
    return rows


_PLAN = ("source string, source_size long, target double, length long, blocks long, quotas array<long>, step long, shift long, "
         "times long, rest long, last long, short long")


def fit(docs: DataFrame, size: Column) -> DataFrame:
    """The plan as a table. Only one row per source reaches the driver."""
    totals = docs.groupBy("source").agg(F.sum(size).alias("size")).collect()
    rows = plan([(r["source"], r["size"]) for r in totals])
    return docs.sparkSession.createDataFrame([tuple(r.values()) for r in rows], _PLAN)


def place(docs: DataFrame, sources: DataFrame, size: Column, seed: int = SEED, lots: int = LOTS) -> DataFrame:
    """Adds ``mix``: size, place of the first word in the source, target, and runs of words with their takes.

    Places are running sums of sizes in seeded order within lots, after the sums of the
    lots before; a hot source is spread over all lots. Rows without words take no
    place. Equal rows may stand in either order, with the same rows out.
    """
    order = F.xxhash64(F.lit(seed), F.col("doc_id"))
    # a lot is taken from the bits that the order within it does not start with
    lot = F.pmod(F.xxhash64(F.lit(seed + 1), F.col("doc_id"), size), F.lit(lots))
    lot_sums = docs.select("source", lot.alias("lot"), size.alias("size")).groupBy("source", "lot").agg(F.sum("size").alias("sum"))
    before = Window.partitionBy("source").orderBy("lot").rowsBetween(Window.unboundedPreceding, -1)
    starts = lot_sums.withColumn("lot_start", F.coalesce(F.sum("sum").over(before), F.lit(0))).join(
        sources.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).select(
        F.struct("source", "lot").alias("lot_key"),
        F.struct("lot_start", "source_size", "target", "length", "blocks", "step", "shift", "times", "rest", "last", "short").alias("plan"))
    aside = Aside(docs.withColumn("_size", size), "source", "doc_id", "_size")
    rows = aside.rows.withColumnRenamed("_size", "size")
    own_lot = F.pmod(F.xxhash64(F.lit(seed + 1), F.col("doc_id"), F.col("size")), F.lit(lots))
    # a struct equals another where both sources are null; join and window share this key, so rows move once
    rows = rows.withColumn("order", order).withColumn("own_key", F.struct("source", own_lot.alias("lot")))
    rows = rows.join(starts, F.col("own_key") == F.col("lot_key"))
    within = Window.partitionBy("own_key").orderBy("order", "doc_id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    start = F.col("plan.lot_start") + F.sum("size").over(within) - F.col("size")
    rows = rows.withColumn("start", start)
    length, blocks = F.col("plan.length"), F.col("plan.blocks")
    first = F.floor(F.col("start") / length)
    last = F.floor((F.col("start") + F.col("size") - 1) / length)

    def run(i: Column) -> Column:
        place = F.pmod(F.col("plan.step") * i + F.col("plan.shift"), blocks)
        # words of the blocks in the places before
        before = place * length - F.when(place > F.col("plan.last"), F.col("plan.short")).otherwise(F.lit(0).cast("long"))
        low = F.greatest(F.col("start"), i * length) - F.col("start")
        high = F.least(F.col("start") + F.col("size"), (i + 1) * length) - F.col("start")
        # up to here in the document the block is taken once more
        cut = F.least(high, F.greatest(low, F.col("plan.rest") - before + i * length - F.col("start")))
        return F.array(F.struct(low.alias("low"), cut.alias("high"), (F.col("plan.times") + 1).alias("times")),
                       F.struct(cut.alias("low"), high.alias("high"), F.col("plan.times").alias("times")))

    runs = F.filter(F.flatten(F.transform(F.sequence(first, last), run)), lambda x: x["low"] < x["high"])
    runs = F.when(F.col("size") > 0, runs).otherwise(F.array().cast("array<struct<low:long,high:long,times:long>>"))
    mix = F.struct("size", "start", F.col("plan.source_size").alias("source_size"), F.col("plan.target").alias("target"), runs.alias("runs"))
    return aside.back(rows.withColumn("mix", mix), "mix").drop("_size")


def op9_mixing(spark, sf_dir: str) -> DataFrame:
    """What the mix takes of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    sized = stage(docs.select("doc_id", "source", n_words(F.col("text")).alias("size")))
    placed = place(sized, fit(sized, F.col("size")), F.col("size"))
    taken = F.aggregate("mix.runs", F.lit(0).cast("long"), lambda a, x: a + (x["high"] - x["low"]) * x["times"])
    return placed.select("doc_id", "mix.size", "mix.source_size", "mix.target", taken.alias("taken"))


@F.pandas_udf(StringType())
def _cut(text: pd.Series, runs: pd.Series) -> pd.Series:
    """The words of the runs (low, high), with the white space that stands between them."""
    def one(value, ranges):
        if value is None:
            return None
        found = list(re.finditer(WORD, value))
        joined: list[list[int]] = []
        for r in ranges:
            if joined and joined[-1][1] == r["low"]:
                joined[-1][1] = r["high"]
            else:
                joined.append([r["low"], r["high"]])
        return "\n".join(value[found[low].start():found[high - 1].end()] for low, high in joined)

    return pd.Series([one(t, r) for t, r in zip(text, runs)], dtype=object)


def mix(docs: DataFrame) -> DataFrame:
    """The rows the mix takes, columns as they came; a row that it takes twice comes twice.

    A document of which it takes a part comes with those words alone and ``n_chars``
    counted anew. Rows without words are not taken.
    """
    sources = fit(docs, n_words(F.col("text")))
    aside = Aside(docs, "doc_id", "source", "text")
    rows = aside.rows.withColumn("size", n_words(F.col("text"))).drop("text")
    passes = place(rows, sources, F.col("size")).select(*aside.names, "mix", F.explode(F.sequence(F.lit(1), F.lit(REPEATS))).alias("pass"))
    chosen = F.filter("mix.runs", lambda x: x["times"] >= F.col("pass"))
    passes = passes.where(F.size("mix.runs") > 0).withColumn("chosen", chosen).where(F.size("chosen") > 0)
    passes = settle(passes.withColumn("whole", F.size("chosen") == F.size("mix.runs")), ["chosen", "whole"])
    cut = _cut(F.when(~F.col("whole"), aside.own("text")), F.when(~F.col("whole"), F.col("chosen")))
    passes = passes.withColumn("cut", cut)
    n_chars = F.when(F.col("cut").isNull(), aside.own("n_chars")).otherwise(F.length("cut").cast("long"))
    return aside.back(passes, text=F.coalesce(F.col("cut"), aside.own("text")), n_chars=n_chars)
