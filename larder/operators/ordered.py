"""Order-sensitive operators that never put one key into one task."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.operators.settle import settle


def first_places(df: DataFrame, key: str, order: str = "_ord") -> DataFrame:
    """The first place of every key, null included. Combines before the shuffle."""
    return df.groupBy(F.col(key).alias("_key")).agg(F.min(order).alias("_first"))


def _same_place(df: DataFrame, places: DataFrame, key: str, order: str) -> Column:
    # The place is part of the join key: a key that holds a third of the table
    # still hashes to all partitions.
    return df[key].eqNullSafe(places["_key"]) & (df[order] == places["_first"])


def keep_first(
    df: DataFrame, key: str, order: str = "_ord", among: DataFrame | None = None
) -> DataFrame:
    """Rows that are the first of their key.

    ``among`` is the table to look for first rows in, where ``df`` is only a part
    of it. ``order`` must differ between rows of one key.
    """
    places = first_places(df if among is None else among, key, order)
    return df.join(places, _same_place(df, places, key, order), "left_semi")


def flag_repeats(
    df: DataFrame,
    key: str,
    order: str = "_ord",
    flag: str = "is_duplicate",
    among: DataFrame | None = None,
) -> DataFrame:
    """Add ``flag``: an earlier row has the same key (nulls are equal).

    ``among`` is the same table before costly columns were added to it.
    """
    places = first_places(df if among is None else among, key, order)
    joined = df.join(places, _same_place(df, places, key, order), "left")
    return joined.select(*[df[c] for c in df.columns], F.col("_first").isNull().alias(flag))


def order_chunk(df: DataFrame, order: str = "_ord", bits: int = 16) -> list[Column]:
    """Columns that cut ``order`` into runs of at most 2**bits rows each.

    They never decrease along ``order``.
    """
    if isinstance(df.schema[order].dataType, T.StructType):
        place = F.col(order)
        return [place["file"], place["block"], F.shiftright(place["row"], bits)]
    return [F.shiftright(F.col(order), bits)]


def lag_in_order(
    df: DataFrame,
    key: Sequence[str],
    order: Sequence[Column],
    chunks: Sequence[Sequence[Column]],
    value: str,
    name: str,
) -> DataFrame:
    """``value`` of the previous row of the same key, in one total order.

    ``chunks`` cut the order into runs, the finest first; none may decrease along
    ``order``, and each run lies within one of the next coarser cut. The rows move once, to
    their (key, run), where the lag is taken. Only the first row of a run still lacks its
    value, which is that of the last row of the run before it. So the last rows of runs, one
    narrow row each, take their own lag by the coarser cuts and at last the whole key, and come back to
    the runs. The widest group is a run of the finest cut, or the runs that one run of the next holds.
    """
    places = [f"_place_{i}" for i in range(len(order))]
    cuts = [[f"_cut_{i}_{j}" for j in range(len(chunk))] for i, chunk in enumerate(chunks)]
    own = {**dict(zip(places, order)), **{c: col for names, chunk in zip(cuts, chunks) for c, col in zip(names, chunk)}}
    if not chunks:
        return df.withColumn(name, F.lag(value).over(Window.partitionBy(*key).orderBy(*order)))
    # A struct equals another where both have a null, so that null keys find their runs by a plain join.
    run_id = f"_run_{len(chunks)}"
    rows = df.withColumns(own).withColumn(run_id, F.struct(*key, *cuts[0]))
    run = Window.partitionBy(run_id).orderBy(*places)
    rows = rows.withColumns(
        {
            "_before": F.lag(value).over(run),
            "_head": F.lag(F.lit(True)).over(run).isNull(),
            "_tail": F.lead(F.lit(True)).over(run).isNull(),
        }
    )
    # Fenced off, so that both readers of the runs need the same columns of one exchange.
    rows = settle(rows, [c for c in rows.columns if c != run_id])
    coarser = [c for names in cuts[1:] for c in names]
    tails = rows.filter("_tail").select(run_id, *key, *places, *coarser, F.col(value).alias("_value"))
    tails = lag_in_order(tails, key, [F.col(c) for c in places], [[F.col(c) for c in names] for names in cuts[1:]], "_value", "_earlier")
    joined = rows.join(tails.select(run_id, "_earlier"), run_id, "left")
    found = F.when(F.col("_head"), F.col("_earlier")).otherwise(F.col("_before"))
    return joined.select(*df.columns, found.alias(name))
