"""Dimensions: items, recipes, employees and the fixed lookup tables."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder import defaults
from larder.functions.numbers import is_finite, parse_float, prepare
from larder.functions.text import strip_ws
from larder.operators.settle import settle


def entry_value(entry: Column, key: str) -> Column:
    return F.try_element_at(entry, F.lit(key))


def entry_label(entry: Column, key: str) -> Column:
    """Trimmed lower text of an optional key; a null written out reads 'none'."""
    text = F.coalesce(entry_value(entry, key), F.lit("none"))
    return F.lower(strip_ws(F.when(F.map_contains_key(entry, key), text).otherwise("")))


def carton_units(
    spark: SparkSession, units: Mapping[str, float] = defaults.CARTON_UNITS
) -> DataFrame:
    rows = [(item, float(n)) for item, n in units.items()]
    return spark.createDataFrame(rows, "Item_ID string, Carton_Units double")


def unit_costs(spark: SparkSession, costs: Mapping[str, float] = defaults.UNIT_COSTS) -> DataFrame:
    rows = [(item, float(n)) for item, n in costs.items()]
    return spark.createDataFrame(rows, "Item_ID string, Unit_Cost double")


def no_recipe_items(
    spark: SparkSession, items: Sequence[str] = defaults.NO_RECIPE_ITEMS
) -> DataFrame:
    return spark.createDataFrame([(item,) for item in items], "Item_ID string")


def items_without_recipe(inventory: DataFrame, bom: DataFrame) -> DataFrame:
    """Items on the list that no recipe uses, found from the data."""
    return inventory.select("Item_ID").distinct().join(bom, "Item_ID", "left_anti")


def convert_thresholds(
    inventory: DataFrame,
    cartons: DataFrame,
    fallback: float = defaults.FALLBACK_THRESHOLD,
) -> DataFrame:
    """Add ``Min_Threshold``, the reorder level in shelf units, and ``Fallback_Reason``.

    The reason is null where the level follows from the item's own one.
    """
    unit = strip_ws(F.col("Supplier_UoM"))
    known = unit.isin(defaults.CARTON, *defaults.UNIT_FACTORS)
    reason = F.when(unit.eqNullSafe(defaults.CARTON) & F.col("Carton_Units").isNull(), defaults.NO_CARTON_UNITS).when(
        ~F.coalesce(known, F.lit(False)), defaults.UNKNOWN_UNIT)
    level = F.when(unit == defaults.CARTON, F.col("Min_Stock_Threshold") * F.col("Carton_Units"))
    for name, factor in defaults.UNIT_FACTORS.items():
        level = level.when(unit == name, F.col("Min_Stock_Threshold") * factor)
    return inventory.join(cartons, "Item_ID", "left").withColumns(
        {"Min_Threshold": F.coalesce(level, F.lit(fallback)), "Fallback_Reason": reason}
    )


def last_per_key(df: DataFrame, key: str, value: str, order: str = "_ord") -> DataFrame:
    """The value of the last row of each key, by an aggregate that combines early."""
    return df.groupBy(key).agg(F.max_by(value, order).alias(value))


def thresholds(
    inventory: DataFrame, cartons: DataFrame, fallback: float = defaults.FALLBACK_THRESHOLD
) -> DataFrame:
    return last_per_key(convert_thresholds(inventory, cartons, fallback), "Item_ID", "Min_Threshold")


def flatten_menus(menus: DataFrame) -> DataFrame:
    """One row per menu and ingredient; unusable ingredients go, repeats and NaN amounts stay."""
    part, quantity = F.col("_part"), F.col("qty_used")
    links = (
        menus.filter(F.col("Menu_ID") != "")
        .select("Menu_ID", F.explode("ingredients").alias("_part"))
        .select(
            strip_ws(F.col("Menu_ID")).alias("Menu_ID"),
            strip_ws(entry_value(part, "Item_ID")).alias("Item_ID"),
            prepare(entry_value(part, "qty_used")).alias("_text"),
            entry_label(part, "UoM").alias("BOM_UoM"),
        )
        .withColumn("qty_used", parse_float(F.col("_text")))
        .select("Menu_ID", "Item_ID", F.when(is_finite(quantity) | F.isnan(quantity), quantity).alias("qty_used"), "BOM_UoM")
    )
    return settle(links, links.columns).filter("Item_ID is not null and qty_used is not null")


def known_menus(bom: DataFrame) -> DataFrame:
    """Menus with at least one usable ingredient."""
    return bom.select("Menu_ID").distinct()


def known_employees(employees: DataFrame) -> DataFrame:
    named = employees.filter(F.col("Employee_ID") != "")
    return named.select(strip_ws(F.col("Employee_ID")).alias("Employee_ID")).distinct()
