"""Report and quarantine files."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder import defaults
from larder.operators.classify import sort_report


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Write ``df`` as a folder of ``fmt`` files, with a header where it can have one."""
    writer = df.write.format(fmt)
    if fmt == "csv":
        # Outer blanks stay, and an empty text is quoted where a null is bare.
        for key in ("header", "ignoreLeadingWhiteSpace", "ignoreTrailingWhiteSpace"):
            writer = writer.option(key, key == "header")
        writer = writer.option("escape", '"')
    writer.save(path)


def write_report(report: DataFrame, path: str, fmt: str = "csv") -> None:
    """The action report in its sort order, file after file."""
    write_table(sort_report(report), path, fmt)


def with_reason(quarantine: DataFrame, reason: str = "Quarantine_Reason") -> DataFrame:
    """Add a reason column if the log came without one."""
    if reason in quarantine.columns:
        return quarantine
    return quarantine.withColumn(reason, F.lit(defaults.UNKNOWN_REASON))


def write_quarantine(quarantine: DataFrame, path: str, fmt: str = "csv") -> None:
    write_table(with_reason(quarantine), path, fmt)


def count_reasons(quarantine: DataFrame, reason: str = "Quarantine_Reason") -> DataFrame:
    """Rows per reason, most frequent first."""
    counts = with_reason(quarantine).groupBy(reason).agg(F.count("*").alias("rows"))
    return counts.orderBy(F.desc("rows"), reason)
