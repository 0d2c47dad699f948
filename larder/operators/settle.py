"""Fences for the optimizer and for generated code."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def settle(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The same rows, with ``columns`` computed once at this point.

    Spark copies the expression behind a column into each filter it pushes down and
    traces join keys back through every step, so that a text parser that mentions
    its steps a few times each grows by their product. A generator of one row per
    row ends both: nothing is pushed or traced through its output.
    """
    rest = [c for c in df.columns if c not in columns]
    return df.select(*rest, F.inline(F.array(F.struct(*columns))))


def apart(col: Column) -> Column:
    """The same value; the projection that holds it is compiled by itself, in methods of bounded length.

    Spark fuses neighbouring projections into one method, and the JVM interprets methods of more than 8000
    bytes for good. It fuses none that holds a higher-order function. Take a cheap column, as Spark does not
    compile what is below the function, and one that is read later, as others are pruned.
    """
    return F.transform(F.array(col), lambda same: same)[0]
