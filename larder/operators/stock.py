"""Daily counts: flattening, cleansing, and reconciliation with consumption."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions.dates import with_timestamp
from larder.functions.numbers import nan_to_null, parse_float, prepare
from larder.functions.text import strip_ws
from larder.operators.dims import entry_label, entry_value
from larder.operators.ordered import lag_in_order, order_chunk
from larder.operators.settle import settle


def stock_text(entry: Column, key: str = "stock_remaining", renamed: str = "sisa_stok_akhir") -> Column:
    """The count under its old or new key.

    The new key is used only where the old one is absent; an old key that holds a
    null stays a null.
    """
    return F.when(F.map_contains_key(entry, key), entry_value(entry, key)).otherwise(
        entry_value(entry, renamed)
    )


def explode_entries(records: DataFrame) -> DataFrame:
    """One row per record and entry, with the place of the entry in its record."""
    return records.select(
        "record_id", "date", "recorded_by", "_ord", F.posexplode("stock_entries").alias("_pos", "_entry")
    )


def with_record_date(records: DataFrame, target: str = "Date") -> DataFrame:
    """Add the day of a record; slashes read month first, as a lone value has no context."""
    dated = with_timestamp(records, "date", "_stamp", day_first=False)
    return settle(dated.withColumn(target, F.to_date("_stamp")).drop("_stamp"), [target])


def flatten_stock(records: DataFrame) -> DataFrame:
    """Typed (Date, Item_ID) counts; entries that cannot be read are dropped.

    A NaN count or delivery becomes null. The entry is kept, as it does exist.
    """
    entry = F.col("_entry")
    dated = with_record_date(records, "_day").filter(F.col("_day").isNotNull())
    texts = dated.select("_day", "_ord", F.posexplode("stock_entries").alias("_pos", "_entry")).select(
        F.col("_day").alias("Date"),
        strip_ws(entry_value(entry, "Item_ID")).alias("Item_ID"),
        prepare(stock_text(entry)).alias("_count"),
        prepare(F.coalesce(entry_value(entry, "delivery_in"), F.lit("0"))).alias("_delivery"),
        entry_label(entry, "UoM").alias("UoM"),
        "_ord",
        "_pos",
    )
    numbers = texts.select(
        "Date",
        "Item_ID",
        parse_float(F.col("_count")).alias("stock_remaining"),
        parse_float(F.col("_delivery")).alias("delivery_in"),
        "UoM",
        "_ord",
        "_pos",
    )
    typed = ["Item_ID", "stock_remaining", "delivery_in"]
    kept = settle(numbers, typed).dropna(subset=["Item_ID"])
    kept = kept.filter("stock_remaining is not null and delivery_in is not null")
    return kept.withColumns(
        {c: nan_to_null(F.col(c)) for c in ("stock_remaining", "delivery_in")}
    )


def clip_negative(flat: DataFrame, column: str = "stock_remaining") -> DataFrame:
    """Counts below zero become zero; a missing count stays missing."""
    value = F.col(column)
    return flat.withColumn(column, F.when(value < 0, F.lit(0.0)).otherwise(value))


def cleanse_stock(records: DataFrame) -> DataFrame:
    return clip_negative(flatten_stock(records))


def stock_profile(flat: DataFrame) -> DataFrame:
    """Counted per (day, item) first, so the distinct counts see small groups."""
    cells = flat.groupBy("Date", "Item_ID").agg(
        F.count("*").alias("_n"), F.count_if(F.col("stock_remaining") < 0).alias("_negative")
    )
    return cells.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"),
        F.countDistinct("Date").alias("days"),
        F.countDistinct("Item_ID").alias("items"),
        F.coalesce(F.sum("_negative"), F.lit(0)).alias("negative_rows"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("repeated_rows"),
    )


def previous_count(stock: DataFrame) -> DataFrame:
    """Add the count of the row before, by date and then by input order.

    Counts of a day come first, in runs of input order; then the edges of these
    runs in a month, and the edges of the months of an item.
    """
    order = [F.col("Date"), F.col("_ord"), F.col("_pos")]
    chunks = [[F.col("Date"), *order_chunk(stock)], [F.trunc("Date", "month")]]
    return lag_in_order(stock, ["Item_ID"], order, chunks, "stock_remaining", "Prev_Physical")


def attach_consumption(stock: DataFrame, consumption: DataFrame) -> DataFrame:
    """Add consumption by day and item; repeated counts of a day all get it."""
    return stock.join(consumption, ["Date", "Item_ID"], "left").withColumn(
        "POS_Consumed", F.coalesce(F.col("POS_Consumed"), F.lit(0.0))
    )


def add_expected(df: DataFrame) -> DataFrame:
    """What should be on the shelf; null for the first count of an item."""
    expected = F.col("Prev_Physical") + F.col("delivery_in") - F.col("POS_Consumed")
    return df.withColumn("Expected_Stock", expected)


def add_variance(df: DataFrame) -> DataFrame:
    return df.withColumn("Variance", F.col("stock_remaining") - F.col("Expected_Stock"))


def reconcile(stock: DataFrame, consumption: DataFrame) -> DataFrame:
    return add_variance(add_expected(attach_consumption(previous_count(stock), consumption)))


def reconcile_profile(reconciled: DataFrame) -> DataFrame:
    return reconciled.agg(
        F.count("*").alias("rows"),
        F.count("Variance").alias("analysable_rows"),
        F.count_if(F.col("Variance").isNull()).alias("skipped_rows"),
    )


def orphan_days(consumption: DataFrame, stock: DataFrame) -> DataFrame:
    """Consumption of days without any count, per day and in total (null day)."""
    days = consumption.groupBy("Date").agg(F.sum("POS_Consumed").alias("_consumed"))
    lost = days.join(stock.select("Date").distinct(), "Date", "left_anti")
    return lost.rollup("Date").agg(
        F.count("*").alias("days"), F.sum("_consumed").alias("POS_Consumed")
    )


def orphan_items(consumption: DataFrame, stock: DataFrame) -> DataFrame:
    """Consumption that meets no count of the same day and item."""
    return consumption.join(
        stock.select("Date", "Item_ID").distinct(), ["Date", "Item_ID"], "left_anti"
    )
