"""Parsers as steps.

A step is a set of columns that only mention earlier columns, so that a costly text
is worked out once however often the next step mentions it. Parsers of different
columns run side by side: step n of all of them is one projection.
"""

from collections.abc import Sequence
from itertools import zip_longest

from pyspark.sql import Column, DataFrame

Steps = Sequence[dict[str, Column]]


def apply_steps(df: DataFrame, *parsers: Steps) -> DataFrame:
    """Add the columns of all parsers; what only their earlier steps add goes again."""
    results = {name for parser in parsers for name in parser[-1]}
    helpers = {name for parser in parsers for step in parser for name in step} - results
    for step in zip_longest(*parsers, fillvalue={}):
        df = df.withColumns({name: col for part in step for name, col in part.items()})
    return df.drop(*helpers)
