"""Exact quantiles of a big column, and the outlier bound built on them."""

import sys
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ACCURACY = 100_000
FEW = 10_000  # different values that are put in order on the driver, at most


def exact_quantiles(
    df: DataFrame, column: str, probabilities: Sequence[float], accuracy: int = ACCURACY, few: int = FEW
) -> list[float | None]:
    """The linearly interpolated quantiles; None for each if the column holds no number.

    A sketch brackets the wanted ranks, and counts below and inside the brackets
    prove that these hold them; where one does not, or is no narrower, the bracket before is
    halved by value instead. Brackets with many different values are bracketed again,
    those with few are put in order on the driver. All quantiles share the passes.
    """
    v = F.col("v")
    values = df.select(F.col(column).cast("double").alias("v")).filter(v.isNotNull() & ~F.isnan(v))
    seen = values.agg(F.count("v").alias("n"), F.min("v").alias("low"), F.max("v").alias("high")).first()
    n = seen["n"]
    if not n:
        return [None] * len(probabilities)
    places = [(n - 1) * p for p in probabilities]
    # low, high, rows below low, rows inside; at first all rows
    brackets = [(seen["low"], seen["high"], 0, n)] * len(places)
    found: list[float | None] = [None] * len(places)
    waiting = list(range(len(places)))
    margin = 3.0 / accuracy
    while waiting:
        marks = []
        for i in waiting:
            low, high, below, inside = brackets[i]
            share = (places[i] - below + 0.5) / inside
            cut = [max(0.0, share - margin), min(1.0, share + margin)]
            marks.append(F.percentile_approx(F.when(v.between(low, high), v), cut, accuracy).alias(f"m{i}"))
        sketched = values.agg(*marks).first()
        tried = {i: tuple(sketched[f"m{i}"]) for i in waiting}
        counts = values.agg(*[c for i, (low, high) in tried.items() for c in (
            F.count_if(v < low).alias(f"b{i}"), F.count_if(v.between(low, high)).alias(f"i{i}"))]).first()
        for i, (low, high) in tried.items():
            rank, below, inside = int(places[i]), counts[f"b{i}"], counts[f"i{i}"]
            holds = below <= rank and min(rank + 1, n - 1) < below + inside
            if holds and inside < brackets[i][3]:
                brackets[i] = (low, high, below, inside)
            else:
                brackets[i], found[i] = _halved(values, brackets[i], places[i], n)
            low, high, below, inside = brackets[i]
            held = values.filter(v.between(low, high)).groupBy("v").agg(F.count("*").alias("rows"))
            if found[i] is None and held.limit(few + 1).count() <= few:
                found[i] = _interpolated(sorted(held.collect()), places[i], below)
        waiting = [i for i in waiting if found[i] is None]
    return found


def _halved(values: DataFrame, bracket: tuple, place: float, n: int) -> tuple[tuple, float | None]:
    """The half, by value, of a bracket that holds the rank; the quantile itself if its ends lie in both."""
    v = F.col("v")
    low, high, below, inside = bracket
    most = sys.float_info.max
    middle = max(low, -most) / 2 + min(high, most) / 2
    half = values.filter(v.between(low, high)).agg(
        F.count_if(v <= middle).alias("left"), F.max(F.when(v <= middle, v)).alias("a"), F.min(F.when(v > middle, v)).alias("b")).first()
    rank, left = int(place), half["left"]
    if rank >= below + left:
        return (half["b"], high, below + left, inside - left), None
    if min(rank + 1, n - 1) < below + left:
        return (low, half["a"], below, left), None
    return bracket, half["a"] + (half["b"] - half["a"]) * (place - rank)


def _interpolated(held: list, place: float, below: int) -> float:
    rank, ends, at = int(place), [], below
    for value, rows in held:
        at += rows
        while len(ends) < 2 and at > rank + len(ends):
            ends.append(value)
    a, b = ends[0], ends[-1]
    return a + (b - a) * (place - rank)


def exact_quantile(df: DataFrame, column: str, probability: float, name: str, accuracy: int = ACCURACY) -> DataFrame:
    """One row: the quantile."""
    value = exact_quantiles(df, column, [probability], accuracy)
    return df.sparkSession.createDataFrame([tuple(value)], f"`{name}` double")


def outlier_bound(df: DataFrame, column: str, reach: float = 1.5) -> DataFrame:
    """Quartiles, their distance, and the upper bound of usual values."""
    quartiles = df.sparkSession.createDataFrame([tuple(exact_quantiles(df, column, [0.25, 0.75]))], "q1 double, q3 double")
    return quartiles.withColumn("iqr", F.col("q3") - F.col("q1")).withColumn(
        "upper_bound", F.col("q3") + reach * F.col("iqr")
    )
