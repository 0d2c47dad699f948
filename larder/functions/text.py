"""Cleaning of free text."""

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from larder import defaults

# Spark's plain trim() takes off spaces only; these are all characters that
# count as white space in Unicode.
WHITESPACE = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680"
    + "".join(chr(c) for c in range(0x2000, 0x200B))
    + "\u2028\u2029\u202f\u205f\u3000"
)


def strip_ws(col: Column) -> Column:
    return F.btrim(col, F.lit(WHITESPACE))


def null_if_token(col: Column, tokens: Sequence[str] = defaults.SALES_NULLS) -> Column:
    """Null where the text is exactly one of ``tokens`` (no trimming)."""
    return F.when(~col.isin(*tokens), col)


def is_error_flag(col: Column, prefixes: Sequence[str] = defaults.ERROR_PREFIXES) -> Column:
    """True where the trimmed text starts with an error word; false for null."""
    words = "|".join(re.escape(p) for p in prefixes)
    return F.coalesce(strip_ws(col).rlike(f"(?i)^({words})"), F.lit(False))
