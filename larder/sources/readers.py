"""Loaders with fixed schemas.

Every loader adds ``_ord``, the place of the row in its source. "First" and
"last" rules compare it, so it is the same whenever the scan is repeated: rows
are numbered inside a split and splits are named by file and offset.
"""

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder import defaults
from larder.functions.numbers import nan_to_null, parse_float, prepare
from larder.functions.text import null_if_token, strip_ws
from larder.sources.splitting import read_csv_records, read_json_elements

SALES_COLUMNS = (
    "Transaction_ID", "DateTime", "Employee_ID", "Menu_ID", "Item_Name",
    "Quantity", "Additional_Info",
)
INVENTORY_COLUMNS = (
    "Item_ID", "Item_Name", "Supplier_UoM", "Min_Stock_Threshold", "Category",
)

_LINE = "_line"  # holds lines whose number of fields is not that of the header

_entry = T.MapType(T.StringType(), T.StringType())


def _ddl(names: Sequence[str]) -> str:
    return ", ".join(f"`{n.replace('`', '``')}` string" for n in names)


def _text_schema(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


STOCK_RECORD = T.StructType(
    _text_schema(["record_id", "date", "recorded_by"]).fields
    + [T.StructField("stock_entries", T.ArrayType(_entry))]
)
MENU = T.StructType(
    _text_schema(["Menu_ID", "Menu_Name", "Selling_Price_IDR"]).fields
    + [T.StructField("ingredients", T.ArrayType(_entry))]
)
EMPLOYEE = _text_schema(["Employee_ID", "Full_Name", "Role", "Shift"])


def _place_in_file() -> Column:
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )


def normalise_nulls(
    df: DataFrame,
    tokens: Sequence[str] = defaults.SALES_NULLS,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Turn missing-value marks into nulls, in one projection."""
    picked = set(columns if columns is not None else df.columns)
    picked = {f.name for f in df.schema if f.name in picked and f.dataType == T.StringType()}
    return df.select(
        *[null_if_token(F.col(c), tokens).alias(c) if c in picked else F.col(c) for c in df.columns]
    )


def read_text_csv(
    spark: SparkSession, path: str, columns: Sequence[str], multi_line: bool = True, split: bool = False
) -> DataFrame:
    """A CSV with header, the named columns as text, plus ``_ord``.

    Columns are found by the names in the header, whatever their order, and others
    are left out; a missing one, or files of different headers, raise. A line with
    fewer fields than the header ends in nulls, one with more fails the job. Fields may hold
    line breaks inside quotes; with ``split`` many tasks share a file all the same, at the price of reading it
    two or three times. ``multi_line=False`` is for files without such breaks: Spark splits
    them, and the job fails on a line that ends early in an open quote; an open quote in
    the last field cannot be told from text.
    """
    options = {"header": True, "multiLine": multi_line, "escape": '"'}
    names = spark.read.options(**options).csv(path).columns
    missing = [c for c in columns if c not in names]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}; its header is {', '.join(names)}")
    if split and multi_line:
        return read_csv_records(spark, path, names, _ddl).select(*columns, "_ord")
    # Pruned columns are not parsed, and surplus fields would go unnoticed.
    rows = spark.read.options(
        **options, enforceSchema=False, columnPruning=False, columnNameOfCorruptRecord=_LINE
    ).schema(_text_schema([*names, _LINE])).csv(path)
    surplus = F.from_csv(F.col(_LINE), _ddl([*names, "_surplus"]), {"escape": '"', "multiLine": "true"})["_surplus"]
    quotes = F.length(_LINE) - F.length(F.replace(F.col(_LINE), F.lit('"'), F.lit("")))
    broken = surplus.isNotNull() | (quotes % 2 == 1)
    # Spark refuses to read the line alone, as a count would.
    broken = broken & (F.length(F.coalesce(F.col(f"`{names[0]}`"), F.lit(""))) >= 0)
    message = F.concat(F.lit(f"{path} has a broken line: "), F.coalesce(F.col(_LINE), F.lit("")))
    checked = rows.filter(F.when(F.coalesce(broken, F.lit(False)), F.raise_error(message).cast("boolean")).otherwise(True))
    return checked.select(*columns, _place_in_file().alias("_ord"))


def read_sales(spark: SparkSession, path: str, multi_line: bool = True, split: bool = True) -> DataFrame:
    return normalise_nulls(read_text_csv(spark, path, SALES_COLUMNS, multi_line, split), columns=SALES_COLUMNS)


def clean_inventory(raw: DataFrame) -> DataFrame:
    """Typed item list: items without id go, a bad threshold is 0."""
    rows = normalise_nulls(raw, defaults.DIMENSION_NULLS, INVENTORY_COLUMNS).dropna(subset=["Item_ID"])
    # Underscores belong to quantities, recipes and counts, not to thresholds.
    plain = F.when(~F.col("Min_Stock_Threshold").contains("_"), F.col("Min_Stock_Threshold"))
    staged = rows.withColumn("_text", prepare(plain))
    staged = staged.withColumn("_text", parse_float(F.col("_text")))
    return staged.withColumns(
        {
            "Item_ID": strip_ws(F.col("Item_ID")),
            "Item_Name": strip_ws(F.col("Item_Name")),
            "Min_Stock_Threshold": F.coalesce(nan_to_null(F.col("_text")), F.lit(0.0)),
        }
    ).drop("_text")


def read_inventory(spark: SparkSession, path: str) -> DataFrame:
    return clean_inventory(read_text_csv(spark, path, INVENTORY_COLUMNS))


def _read_documents(
    spark: SparkSession, path: str, field: str, element: T.StructType, mode: str, multi_line: bool
) -> DataFrame:
    """One row per element of the top-level array ``field`` of each document."""
    document = T.StructType([T.StructField(field, T.ArrayType(element))])
    return (
        spark.read.schema(document)
        .option("multiLine", multi_line)
        .option("mode", mode)
        .json(path)
        .select(_place_in_file().alias("_doc"), F.posexplode(field).alias("_pos", "_element"))
        .select(
            "_element.*",
            F.struct(
                F.col("_doc.file").alias("file"),
                F.col("_doc.row").alias("block"),
                F.col("_pos").cast("bigint").alias("row"),
            ).alias("_ord"),
        )
    )


def read_source(
    spark: SparkSession,
    path: str,
    field: str,
    element: T.StructType,
    required: bool = True,
    multi_line: bool = True,
    split: bool = False,
) -> DataFrame:
    """A JSON source; a missing or broken one stops the run only if ``required``.

    A broken document of a required source fails the job. A broken document of an
    optional one gives no rows, and a missing path gives an empty table. A file is one document;
    with ``split`` many tasks share it if it is required. With ``multi_line=False`` every line is a document.
    """
    if required and split and multi_line:
        return read_json_elements(spark, path, field, element)
    try:
        mode = "FAILFAST" if required else "PERMISSIVE"
        return _read_documents(spark, path, field, element, mode, multi_line)
    except AnalysisException:
        if required:
            raise
        place = T.StructType(
            [
                T.StructField("file", T.StringType()),
                T.StructField("block", T.LongType()),
                T.StructField("row", T.LongType()),
            ]
        )
        return spark.createDataFrame([], T.StructType([*element.fields, T.StructField("_ord", place)]))


def read_stock_records(spark: SparkSession, path: str, multi_line: bool = True, split: bool = True) -> DataFrame:
    return read_source(spark, path, "records", STOCK_RECORD, multi_line=multi_line, split=split)


def read_menus(spark: SparkSession, path: str, multi_line: bool = True, split: bool = True) -> DataFrame:
    return read_source(spark, path, "menu_items", MENU, multi_line=multi_line, split=split)


def read_employees(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    return read_source(spark, path, "employees", EMPLOYEE, False, multi_line)
