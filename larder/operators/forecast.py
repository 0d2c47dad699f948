"""Trailing mean of consumption and days to stock-out."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.functions.numbers import round_tenths
from larder.operators.settle import settle

MEAN = "Avg_7d_Consumption"


def _bounds(consumption: DataFrame) -> tuple[Column, Column]:
    """First and last day of consumption, as scalar subqueries."""
    days = consumption.agg(F.min("Date").alias("first"), F.max("Date").alias("last"))
    return days.select("first").scalar(), days.select("last").scalar()


def day_runs(consumption: DataFrame) -> DataFrame:
    """Every day between the first and the last, for every item, in runs.

    A row is a day of consumption and the number of days without any that follow it
    (``zero_days``); an item that starts late has a row of 0 on the first day. So the
    table grows with consumption, not with days times items.
    """
    first, last = _bounds(consumption)
    late = consumption.groupBy("Item_ID").agg(F.min("Date").alias("_start")).withColumn("Date", first)
    late = late.filter(F.col("_start") > F.col("Date")).select("Date", "Item_ID", F.lit(0.0).alias("POS_Consumed"))
    days = consumption.select("Date", "Item_ID", "POS_Consumed").unionByName(late).withColumn("_last", last)
    # An item has one row a day at most, so a calendar bounds the window.
    after = F.lead("Date").over(Window.partitionBy("Item_ID").orderBy("Date"))
    zeros = F.datediff(F.coalesce(after, F.date_add("_last", 1)), "Date") - 1
    return days.select("Date", "Item_ID", "POS_Consumed", zeros.alias("zero_days"))


def active_days(consumption: DataFrame, days: int = 7) -> DataFrame:
    """The (day, item) of the period whose last ``days`` days hold consumption; all other means are 0 or none."""
    last = _bounds(consumption)[1]
    return trailing_totals(consumption, days).withColumn("_last", last).filter(F.col("Date") <= F.col("_last")).select("Date", "Item_ID")


def trailing_totals(consumption: DataFrame, days: int) -> DataFrame:
    """Consumption of the last ``days`` days, for days that have any.

    Every day adds its value to itself and the days after it. The sums then spread
    over (day, item), where a window would walk through an item in one task.
    """
    steps = F.explode(F.sequence(F.lit(0), F.lit(days - 1)))
    spread = consumption.select("*", steps.alias("_ahead"))
    return (
        spread.select(F.date_add("Date", F.col("_ahead")).alias("Date"), "Item_ID", "POS_Consumed")
        .groupBy("Date", "Item_ID")
        .agg(F.sum("POS_Consumed").alias("_total"))
    )


def trailing_mean(
    consumption: DataFrame, at: DataFrame, days: int = 7, name: str = MEAN
) -> DataFrame:
    """Add the mean of the last ``days`` calendar days to the rows of ``at``.

    Days without consumption count as 0; near the start there are fewer days to
    divide by. Items never consumed and days outside the consumption period have
    no mean.
    """
    first, last = _bounds(consumption)
    items = consumption.select("Item_ID").distinct().withColumn("_used", F.lit(True))
    joined = at.join(trailing_totals(consumption, days), ["Date", "Item_ID"], "left")
    joined = joined.join(items, "Item_ID", "left").withColumns({"_first": first, "_last": last})
    span = F.least(F.lit(days), F.datediff("Date", "_first") + 1)
    mean = F.coalesce(F.col("_total"), F.lit(0.0)) / span
    inside = F.col("_used") & F.col("Date").between(F.col("_first"), F.col("_last"))
    return joined.withColumn(name, F.when(inside, mean)).select(*at.columns, name)


def to_wide(long: DataFrame, items: Sequence[str], value: str = "POS_Consumed") -> DataFrame:
    """One row per day and one column per named item, gaps as 0; any other item fails the job."""
    unnamed = F.raise_error(F.concat(F.lit("no column for item "), F.coalesce(F.col("Item_ID"), F.lit("null"))))
    named = F.when(F.coalesce(F.col("Item_ID").isin(*items), F.lit(False)), F.col("Item_ID")).otherwise(unnamed.cast("string"))
    checked = long.select("Date", named.alias("Item_ID"), value)
    return checked.groupBy("Date").pivot("Item_ID", list(items)).agg(F.sum(value)).fillna(0.0)


def to_long(wide: DataFrame, items: Sequence[str], value: str = MEAN) -> DataFrame:
    return wide.unpivot(["Date"], list(items), "Item_ID", value)


def days_to_stockout(gap: Column, mean: Column, days: Column) -> Column:
    """Days until the reorder level is reached, to one decimal; 0 if it already is."""
    left = F.when(gap <= 0, F.lit(0.0)).otherwise(round_tenths(days))
    return F.when(gap.isNotNull() & (mean > 0), left)


def urgency() -> Column:
    days = F.col("Days_to_Stockout")
    return (
        F.when(days.isNull(), "N/A")
        .when(days == 0, "CRITICAL")
        .when(days <= 3, "URGENT")
        .when(days <= 7, "PLAN_ORDER")
        .otherwise("SUFFICIENT")
    )


def add_stockout(report: DataFrame) -> DataFrame:
    """Days and urgency. Rows of unknown menus have no count and so no days."""
    gap, mean = F.col("_gap"), F.col(MEAN)
    stepped = (
        report.withColumn("_gap", F.col("Physical_Stock") - F.col("Min_Threshold"))
        .withColumn("_days", F.try_divide(gap, mean))
        .withColumn("Days_to_Stockout", days_to_stockout(gap, mean, F.col("_days")))
        .withColumn("Restock_Urgency", urgency())
        .drop("_gap", "_days")
    )
    return settle(stepped, ["Days_to_Stockout", "Restock_Urgency"])
