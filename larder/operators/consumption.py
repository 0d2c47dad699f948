"""Sales of menus into use of ingredients."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.functions.text import strip_ws


def drop_unknown_menus(flagged: DataFrame, flag: str = "is_ghost_menu") -> DataFrame:
    return flagged.filter(~F.col(flag)).drop(flag)


def sales_by_menu_day(clean: DataFrame) -> DataFrame:
    """Quantity and number of sales per day and menu.

    Use of ingredients is linear in quantity, so this is all that later stages need
    of the sales: days times menus instead of all of them.
    """
    return clean.groupBy("Date", strip_ws(F.col("Menu_ID")).alias("Menu_ID")).agg(
        F.sum("Quantity_Clean").alias("Quantity_Clean"),
        F.count("Transaction_ID").alias("Transaction_Count"),
    )


def expand_recipes(sales: DataFrame, bom: DataFrame) -> DataFrame:
    """One row per sale and ingredient of its menu."""
    return sales.join(bom.select("Menu_ID", "Item_ID", "qty_used"), "Menu_ID")


def add_consumed(expanded: DataFrame) -> DataFrame:
    return expanded.withColumn("Total_Consumed", F.col("Quantity_Clean") * F.col("qty_used"))


def daily_consumption(menu_days: DataFrame, bom: DataFrame) -> DataFrame:
    """Consumption per day and item from sales per day and menu.

    Joins without a hint: Spark knows both sizes and the menu side is small. A NaN
    amount makes the menu known and gives the day a row, but adds nothing.
    """
    expanded = menu_days.join(bom.select("Menu_ID", "Item_ID", "qty_used"), "Menu_ID")
    return (
        add_consumed(expanded)
        .groupBy("Date", "Item_ID")
        .agg(F.sum(F.nanvl("Total_Consumed", F.lit(0.0))).alias("POS_Consumed"))
    )


def consumption_profile(consumption: DataFrame) -> DataFrame:
    return consumption.agg(
        F.count("*").alias("rows"),
        F.countDistinct("Date").alias("days"),
        F.countDistinct("Item_ID").alias("items"),
    )
