"""Profiles of the sources as they arrive, before any cleansing."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder import defaults
from larder.functions.dates import date_class
from larder.functions.numbers import parse_float, prepare
from larder.functions.text import strip_ws
from larder.operators.quality import REASON, value_shares
from larder.operators.settle import settle


def _text(name: str) -> Column:
    return F.coalesce(strip_ws(F.col(name)), F.lit(""))


def key_profile(sales: DataFrame, key: str = "Transaction_ID") -> DataFrame:
    """Empty, repeated and distinct trimmed ids; empty ids are no repeats here."""
    ids = sales.groupBy(_text(key).alias("id")).agg(F.count("*").alias("n"))
    named = F.col("id") != ""
    return ids.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.when(~named, F.col("n"))), F.lit(0)).alias("empty"),
        F.coalesce(F.sum(F.when(named, F.col("n") - 1)), F.lit(0)).alias("repeated"),
        F.count_if(named).alias("distinct_ids"),
    )


def emptiness_profile(sales: DataFrame) -> DataFrame:
    return sales.agg(
        *[F.count_if(_text(c) == "").alias(f"empty_{c.lower()}") for c in ("Employee_ID", "Menu_ID")]
    )


def quantity_profile(sales: DataFrame) -> DataFrame:
    """Counts by a plain cast alone: no number words and no number inside text."""
    text, number = F.col("_text"), F.col("_number")
    point = F.translate(F.coalesce(prepare(F.col("Quantity")), F.lit("")), ",", ".")
    read = sales.select(point.alias("_text")).withColumn("_number", parse_float(text))
    return read.agg(
        F.count_if(text == "").alias("empty"),
        F.count_if(number == 0).alias("zero"),
        F.count_if(number < 0).alias("negative"),
        F.count_if((text != "") & number.isNull()).alias("unparseable"),
    )


def with_date_class(sales: DataFrame) -> DataFrame:
    staged = sales.select("DateTime", _text("DateTime").alias("_text"))
    named = staged.select("DateTime", date_class(F.col("_text")).alias("format"))
    return settle(named, ["format"])


def date_formats(sales: DataFrame) -> DataFrame:
    return value_shares(with_date_class(sales), "format")


def unknown_dates(sales: DataFrame) -> DataFrame:
    return with_date_class(sales).filter(F.col("format") == "OTHER").select("DateTime")


def sales_audit(sales: DataFrame) -> DataFrame:
    """All profiles of the sales in one scan: ``profile``, ``part``, ``rows``.

    Counts are kept per id before the shuffle, as distinct ids are counted among them, so an id
    that fills the table moves as one row. Without sales all counts are 0.
    """
    point = F.translate(F.coalesce(prepare(F.col("Quantity")), F.lit("")), ",", ".")
    texts = sales.select(
        _text("Transaction_ID").alias("_id"), (_text("Employee_ID") == "").alias("_no_employee"),
        (_text("Menu_ID") == "").alias("_no_menu"), point.alias("_text"), _text("DateTime").alias("_date"))
    read = texts.withColumns({"_number": parse_float(F.col("_text")), "_format": date_class(F.col("_date"))})
    read = settle(read, ["_number", "_format"])
    text, number, named = F.col("_text"), F.col("_number"), F.col("_id") != ""
    counts = {
        ("ids", "rows"): F.count("*"),
        ("ids", "empty"): F.count_if(~named),
        ("ids", "distinct_ids"): F.count_distinct(F.when(named, F.col("_id"))),
        ("emptiness", "empty_employee_id"): F.count_if("_no_employee"),
        ("emptiness", "empty_menu_id"): F.count_if("_no_menu"),
        ("quantity", "empty"): F.count_if(text == ""),
        ("quantity", "zero"): F.count_if(number == 0),
        ("quantity", "negative"): F.count_if(number < 0),
        ("quantity", "unparseable"): F.count_if((text != "") & number.isNull()),
        **{("dates", c): F.count_if(F.col("_format") == c) for c in ("EMPTY", *defaults.DATE_CLASSES, "OTHER")},
    }
    names = list(counts)
    totals = read.agg(*[c.alias(f"_{i}") for i, c in enumerate(counts.values())])
    rows = [F.struct(F.lit(p).alias("profile"), F.lit(part).alias("part"), F.col(f"_{i}").alias("rows")) for i, (p, part) in enumerate(names)]
    repeated = F.col("_0") - F.col("_1") - F.col("_2")
    rows.append(F.struct(F.lit("ids").alias("profile"), F.lit("repeated").alias("part"), repeated.alias("rows")))
    return totals.select(F.inline(F.array(*rows)))


def stock_drift(records: DataFrame) -> DataFrame:
    """Records with any entry under the old and the new name of the count."""

    def uses(key: str) -> Column:
        return F.exists("stock_entries", lambda e: F.map_contains_key(e, key))

    return records.agg(
        F.count("*").alias("records"),
        F.count_if(uses("stock_remaining")).alias("old_key_records"),
        F.count_if(uses("sisa_stok_akhir")).alias("new_key_records"),
        F.countDistinct("date").alias("days"),
        F.min("date").alias("first_day"),
        F.max("date").alias("last_day"),
    )


def unit_distribution(inventory: DataFrame) -> DataFrame:
    """Items per supplier unit, with the cartons marked."""
    unit = strip_ws(F.col("Supplier_UoM")).alias("unit")
    counted = inventory.groupBy(unit).agg(F.count("*").alias("items"))
    return counted.withColumn("is_carton", F.col("unit").eqNullSafe(F.lit(defaults.CARTON)))


def menu_profile(menus: DataFrame) -> DataFrame:
    links = F.coalesce(F.size("ingredients"), F.lit(0))
    links = F.greatest(links, F.lit(0)).cast("bigint")
    return menus.agg(
        F.count("*").alias("menus"),
        F.coalesce(F.sum(links), F.lit(0)).alias("links"),
        F.avg(links).alias("links_per_menu"),
    )


def employee_list(employees: DataFrame) -> DataFrame:
    return employees.select("Employee_ID", "Full_Name", "Role")


def source_summary(
    sales: DataFrame,
    records: DataFrame,
    inventory: DataFrame,
    menus: DataFrame,
    employees: DataFrame,
) -> DataFrame:
    """One row per source: rows, and the two parts that matter where there are any."""
    none = F.lit(None).cast("bigint")

    def row(source: str, df: DataFrame, first: Column = none, second: Column = none) -> DataFrame:
        counted = df.agg(
            F.count("*").alias("rows"),
            (F.count_if(first) if first is not none else first).alias("part_1"),
            (F.count_if(second) if second is not none else second).alias("part_2"),
        )
        return counted.select(F.lit(source).alias("source"), "rows", "part_1", "part_2")

    def uses(key: str) -> Column:
        return F.exists("stock_entries", lambda e: F.map_contains_key(e, key))

    carton = strip_ws(F.col("Supplier_UoM")).eqNullSafe(F.lit(defaults.CARTON))
    return (
        row("sales", sales)
        .unionByName(row("stock", records, uses("stock_remaining"), uses("sisa_stok_akhir")))
        .unionByName(row("inventory", inventory, carton, ~carton))
        .unionByName(row("menus", menus))
        .unionByName(row("employees", employees))
    )


def compare_datasets(
    tagged: DataFrame,
    dataset: str,
    unknown_menus: DataFrame,
    stock_rows: Column,
) -> DataFrame:
    """Rows, rejected and clean rows, dirty share and report rows per dataset.

    ``unknown_menus`` holds one row per dataset, day and unknown menu, and
    ``stock_rows`` is the number of counts that end up in the report.
    """
    base = tagged.groupBy(dataset).agg(
        F.count("*").alias("rows"),
        F.count(REASON).alias("quarantined"),
        F.count_if(F.col(REASON).isNull()).alias("clean"),
    )
    extra = unknown_menus.groupBy(dataset).agg(F.count("*").alias("_invalid"))
    return base.join(extra, dataset, "left").select(
        dataset,
        "rows",
        "quarantined",
        "clean",
        (F.col("quarantined") / F.col("rows")).alias("dirty_rate"),
        (F.coalesce(F.col("_invalid"), F.lit(0)) + stock_rows).alias("report_rows"),
    )
