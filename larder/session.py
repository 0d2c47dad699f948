"""Session settings and the shared folder for tables that are read twice."""

import contextlib
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession

# What the plans here lean on: AQE turns joins with small sides into broadcast
# joins at run time and splits the partitions of hot join keys. The JVM does not
# compile methods of more than 8000 bytes, so longer generated ones are worse than
# none: text parsers make them easily.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(name: str = "larder", **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it; else the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/larder/{uuid.uuid4().hex}/{name}"


def stage(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` once and go on from the files.

    Cuts the lineage, so that several readers share one scan and parse and a lost
    executor costs only the tasks it held.
    """
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def scratch_folder(spark: SparkSession, root: str) -> Iterator[Callable[..., DataFrame]]:
    """Gives a function that stages a table under a name in a new folder below ``root``, removed at the end."""
    folder = f"{root.rstrip('/')}/larder-{uuid.uuid4().hex}"
    try:
        yield lambda df, name, partition_by=(): stage(df, f"{folder}/{name}", partition_by)
    finally:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
