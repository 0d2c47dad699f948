"""Price of what went missing."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder import defaults
from larder.functions.numbers import round_whole

LOSS = "Estimated_Loss_IDR"


def add_loss(report: DataFrame, costs: DataFrame) -> DataFrame:
    """Whole rupiah lost on shrinkage rows of items with a price above 0."""
    priced = report.join(costs, "Item_ID", "left")
    lost = round_whole(F.abs(F.col("Variance")) * F.col("Unit_Cost"))
    applies = (F.col("Variance_Direction") == defaults.SHRINKAGE) & (F.col("Unit_Cost") > 0)
    return priced.withColumn(LOSS, F.when(applies, lost)).drop("Unit_Cost")


def loss_summary(report: DataFrame) -> DataFrame:
    return report.agg(
        F.coalesce(F.sum(LOSS), F.lit(0.0)).alias("total_loss"), F.count(LOSS).alias("rows")
    )
