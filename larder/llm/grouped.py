"""Running a function over groups of bounded size, and unions of what it links."""

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def over_groups(df: DataFrame, keys: Sequence[str], order: Sequence[str], fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """``fn`` of the rows of each key, many small groups to a task.

    Rows are dealt and sorted by key and read as a stream, so a task holds a batch and
    one group; the caller keeps groups bounded.
    """
    keys = list(keys)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for batch in batches:
            rows = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            if rows.empty:
                continue
            new = np.zeros(len(rows), dtype=bool)
            for key in keys:
                values = rows[key].to_numpy()
                new[1:] |= values[1:] != values[:-1]
            cuts = [0, *np.flatnonzero(new)]
            out = [fn(rows.iloc[a:b]) for a, b in zip(cuts, cuts[1:])]
            rest = rows.iloc[cuts[-1]:]
            if out:
                yield pd.concat(out, ignore_index=True)
        if rest is not None:
            yield fn(rest)

    return df.repartition(*keys).sortWithinPartitions(*keys, *order).mapInPandas(run, schema)


class Union:
    """Sets of the numbers below n, joined by arrays of pairs; a set's name is its least number."""

    def __init__(self, n: int):
        self.name = np.arange(n)

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            low, high = np.minimum(self.name[a], self.name[b]), np.maximum(self.name[a], self.name[b])
            apart = low != high
            if not apart.any():
                return
            a, b = a[apart], b[apart]
            np.minimum.at(self.name, high[apart], low[apart])
            while (self.name != (far := self.name[self.name])).any():
                self.name = far


def tiled(df: DataFrame, group: Sequence[str], band: str, reach: int, node: str, size: int) -> DataFrame:
    """Deals the rows of groups out to pairs of tiles of about ``size`` rows at most.

    Adds ``one`` and ``two``, the names of a pair of tiles, and ``second``, whether the
    row belongs to the second of them. A group of up to ``size`` rows is one tile, paired
    with itself. A larger one is cut by ``band`` (an int column) and a hash of ``node``;
    each row goes to the pairs of its tile with every tile whose band is at most
    ``reach`` away, and pairs further apart are skipped.
    """
    group = list(group)
    by_band = df.groupBy(*group, F.col(band).alias("b")).agg(F.count("*").alias("n"))
    tiles = by_band.groupBy(*group).agg(F.sum("n").alias("rows"), F.collect_list(F.struct("b", F.ceil(F.col("n") / size).cast("int").alias("cuts"))).alias("bands"))
    # only groups above the size need to know their tiles
    large = tiles.where(F.col("rows") > size).select(*[F.col(c).alias(f"t_{c}") for c in group], "bands")
    match = [F.col(c).eqNullSafe(F.col(f"t_{c}")) for c in group]
    rows = df.join(large, match, "left").drop(*[f"t_{c}" for c in group])
    cuts = F.filter("bands", lambda x: x["b"] == F.col(band))[0]["cuts"]
    rows = rows.withColumn("own", F.when(F.col("bands").isNull(), F.lit(0).cast("long")).otherwise(
        F.col(band) * F.lit(1 << 32) + F.pmod(F.xxhash64(node), cuts)))
    near = F.filter("bands", lambda x: F.abs(x["b"] - F.col(band)) <= reach)
    partners = F.flatten(F.transform(near, lambda x: F.transform(
        F.sequence(F.lit(0), x["cuts"] - 1), lambda i: x["b"] * F.lit(1 << 32) + i)))
    rows = rows.withColumn("partner", F.explode(F.coalesce(partners, F.array(F.lit(0).cast("long")))))
    return rows.select(*df.columns, F.least("own", "partner").alias("one"), F.greatest("own", "partner").alias("two"),
                       (F.col("own") > F.col("partner")).alias("second"))
