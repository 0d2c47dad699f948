"""What the operators share: words, reading tables, tables in the shared folder."""

import contextlib
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import larder

# Fixed by the contracts: words are runs of anything but space and U+0009 to U+000D.
SEPARATORS = " \t\n\x0b\x0c\r"
SEPARATOR_RUN = "[ \\x09-\\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once for each Spark context, for functions that run in their Python."""
    context = spark.sparkContext
    if getattr(context, "_larder_shipped", False):
        return
    package = Path(larder.__file__).parent
    path = Path(tempfile.mkdtemp(prefix="larder-")) / "larder.zip"
    with zipfile.ZipFile(path, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(path))
    context._larder_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """The words of a text in order; no words for null, empty or blank texts."""
    inner = F.btrim(F.coalesce(text, F.lit("")), F.lit(SEPARATORS))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, SEPARATOR_RUN))


def n_words(text: Column) -> Column:
    """How many words a text has, as a long."""
    return F.size(words(text)).cast("long")


def without(text: Column, chars: str) -> Column:
    for c in chars:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def most_frequent(counts: DataFrame, k: int) -> DataFrame:
    """Rows of largest ``n``, at most ``k``: all from a bound on that has no more above it.

    The bound comes from a histogram of n in steps of a 64th of a power of two, a few thousand
    rows at most whatever the table, so no task or driver puts rows in order.
    """
    step = F.floor(F.log2("n") * 64)
    sizes = counts.groupBy(step.alias("step")).agg(F.count("*").alias("rows")).collect()
    bound, total = float("inf"), 0
    for row in sorted(sizes, key=lambda r: -r["step"]):
        total += row["rows"]
        if total > k:
            break
        bound = row["step"]
    return counts.where(step >= bound) if sizes and bound != float("inf") else counts.where(F.lit(False))


class Aside:
    """The columns of a table under names of their own, out of the way of those that an operator adds.

    ``rows`` has them, and those asked for under their own names; ``back`` gives any table that
    still has them their names again, with ``extra`` columns behind and ``new`` ones in place.
    """

    def __init__(self, docs: DataFrame, *asked: str):
        self.columns = docs.columns
        self.names = [f"_{i}_" for i in range(len(docs.columns))]
        own = dict(zip(reversed(self.columns), reversed(self.names)))
        self.own = lambda c: F.col(own[c])
        self.rows = docs.toDF(*self.names).select(*self.names, *[self.own(c).alias(c) for c in asked])

    def back(self, df: DataFrame, *extra: str, **new: Column) -> DataFrame:
        kept = [new.get(c, F.col(n)).alias(c) for c, n in zip(self.columns, self.names)]
        return df.select(*kept, *extra)


def shared_folder(spark: SparkSession) -> str:
    """A new folder below the one the cluster names in spark.checkpoint.dir.

    Without that setting, as in tests, tables go below the session's warehouse.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/larder-llm/{uuid.uuid4().hex}"


def stage(df: DataFrame, folder: str | None = None) -> DataFrame:
    """Write a table once in the shared folder, or in one that the caller looks after, and go on from its files.

    Cuts the lineage: later readers and retries after a lost executor read files. Within
    ``passing_tables`` the table goes at its end; else whoever reads the result removes it.
    """
    path = folder or shared_folder(df.sparkSession)
    if _passing and folder is None:
        _passing[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_passing: list[list[str]] = []


@contextlib.contextmanager
def passing_tables(spark: SparkSession) -> Iterator[None]:
    """Tables that ``stage`` writes inside are removed at the end, on failure too.

    What is read later has to be written to a folder of the caller.
    """
    _passing.append([])
    try:
        yield
    finally:
        for folder in _passing.pop():
            remove(spark, folder)


def remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
