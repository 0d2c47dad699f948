"""Joins of facts with a dimension.

No hint and no switch: at run time Spark broadcasts a side that is small in bytes and
splits hot keys of one that is not. Callers that need groups alone count them first,
so that the join meets each key once.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def flag_missing(facts: DataFrame, key: str, known: DataFrame, flag: str) -> DataFrame:
    """Add ``flag``: the key of the row is not among the distinct keys ``known``."""
    marks = known.select(F.col(known.columns[0]).alias(key), F.lit(True).alias("_known"))
    joined = facts.join(marks, key, "left")
    return joined.select(*facts.columns, F.col("_known").isNull().alias(flag))
