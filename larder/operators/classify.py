"""Status of every (day, item) and the shape of the report."""

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from larder import defaults

CORE_COLUMNS = (
    "Date", "Item_ID", "Action_Status", "Physical_Stock", "Expected_Stock",
    "Variance", "Variance_Direction", "POS_Consumed", "Delivery_In",
    "Min_Threshold", "Item_Note",
)
REPORT_COLUMNS = (
    "Date", "Item_ID", "Action_Status", "Physical_Stock", "Min_Threshold",
    "Days_to_Stockout", "Restock_Urgency", "Expected_Stock", "Variance",
    "Variance_Direction", "Estimated_Loss_IDR", "POS_Consumed",
    "Avg_7d_Consumption", "Delivery_In", "Item_Note",
)
PLACE_COLUMNS = ("_ord", "_pos")


def invalid_groups(menu_days: DataFrame, menus: DataFrame) -> DataFrame:
    """Sales of unknown menus per day, with the two measures behind the rows."""
    return menu_days.join(menus, "Menu_ID", "left_anti").select(
        "Date",
        F.col("Menu_ID").alias("Item_ID"),
        F.col("Quantity_Clean").alias("Quantity_Total"),
        "Transaction_Count",
        F.lit(defaults.INVALID).alias("Action_Status"),
        F.lit(defaults.NOT_APPLICABLE).alias("Variance_Direction"),
        F.lit(defaults.INVALID_NOTE).alias("Item_Note"),
    )


def attach_thresholds(
    df: DataFrame, thresholds: DataFrame, fallback: float = defaults.FALLBACK_THRESHOLD
) -> DataFrame:
    return df.join(thresholds, "Item_ID", "left").withColumn(
        "Min_Threshold", F.coalesce(F.col("Min_Threshold"), F.lit(fallback))
    )


def status(limit: float = defaults.ANOMALY_LIMIT) -> Column:
    """A missing variance or count makes its test fail, and the next one is tried."""
    return (
        F.when(F.abs(F.col("Variance")) > limit, defaults.ANOMALY)
        .when(F.col("stock_remaining") < F.col("Min_Threshold"), defaults.RESTOCK)
        .otherwise(defaults.SAFE)
    )


def direction() -> Column:
    side = F.when(F.col("Variance") < 0, defaults.SHRINKAGE).otherwise(defaults.OVERCOUNT)
    return F.when(F.col("Action_Status") == defaults.ANOMALY, side).otherwise(
        defaults.NOT_APPLICABLE
    )


def attach_notes(df: DataFrame, without_recipe: DataFrame) -> DataFrame:
    """A note on items whose movement no sale can explain."""
    marked = without_recipe.withColumn("Item_Note", F.lit(defaults.NO_RECIPE_NOTE))
    return df.join(marked, "Item_ID", "left").withColumn(
        "Item_Note", F.coalesce(F.col("Item_Note"), F.lit(""))
    )


def classify(
    reconciled: DataFrame,
    thresholds: DataFrame,
    without_recipe: DataFrame,
    limit: float = defaults.ANOMALY_LIMIT,
    fallback: float = defaults.FALLBACK_THRESHOLD,
) -> DataFrame:
    levelled = attach_thresholds(reconciled, thresholds, fallback)
    tagged = levelled.withColumn("Action_Status", status(limit))
    return attach_notes(tagged.withColumn("Variance_Direction", direction()), without_recipe)


def project_core(classified: DataFrame) -> DataFrame:
    """The core columns under their report names; row places ride along for sorting."""
    renamed = classified.withColumnsRenamed(
        {"stock_remaining": "Physical_Stock", "delivery_in": "Delivery_In"}
    )
    return renamed.select(*CORE_COLUMNS, *[c for c in PLACE_COLUMNS if c in renamed.columns])


def bind_invalid(core: DataFrame, invalid: DataFrame) -> DataFrame:
    """Append the invalid rows; columns they lack are null."""
    rows = invalid.select(*[c for c in CORE_COLUMNS if c in invalid.columns])
    return core.unionByName(rows, allowMissingColumns=True)


def status_rank() -> Column:
    rank = F.lit(9)
    order = (defaults.ANOMALY, defaults.INVALID, defaults.RESTOCK, defaults.SAFE)
    for place, name in reversed(list(enumerate(order))):
        rank = F.when(F.col("Action_Status") == name, place).otherwise(rank)
    return rank


def sort_report(report: DataFrame) -> DataFrame:
    """Total order: day, status, item, then input order.

    Row places last: a range sort can then cut inside a day and item that holds
    many rows.
    """
    places = [c for c in PLACE_COLUMNS if c in report.columns]
    ties = places or [c for c in report.columns if c not in ("Date", "Action_Status", "Item_ID")]
    return report.orderBy("Date", status_rank(), "Item_ID", *ties).drop(*places)


def status_counts(report: DataFrame) -> DataFrame:
    """Rows per status and direction, with subtotals (null direction)."""
    counted = report.groupBy("Action_Status", "Variance_Direction").agg(F.count("*").alias("_n"))
    return counted.rollup("Action_Status", "Variance_Direction").agg(
        F.sum("_n").alias("rows"), F.grouping_id().cast("int").alias("level")
    )


STATUSES = (defaults.ANOMALY, defaults.INVALID, defaults.RESTOCK, defaults.SAFE)
DIRECTIONS = (defaults.SHRINKAGE, defaults.OVERCOUNT, defaults.NOT_APPLICABLE)


def watch_statuses(report: DataFrame, watch: Observation) -> DataFrame:
    """The report, counted by ``watch`` as it is written."""
    pairs = [(s, d) for s in STATUSES for d in DIRECTIONS]
    is_pair = [(F.col("Action_Status") == s) & (F.col("Variance_Direction") == d) for s, d in pairs]
    return report.observe(watch, F.count("*").alias("rows"), *[F.count_if(test).alias(f"{s}|{d}") for (s, d), test in zip(pairs, is_pair)])


def watched_counts(spark: SparkSession, watch: Observation) -> DataFrame:
    """The rows of ``status_counts``, from what ``watch`` counted; a status of no kind known fails."""
    found = dict(watch.get)
    total = found.pop("rows")
    if total != sum(found.values()):
        raise ValueError("the report holds a status or direction that is not known")
    rows = [(*name.split("|"), n, 0) for name, n in found.items() if n]
    parts = {s: sum(n for status, _, n, _ in rows if status == s) for s in STATUSES}
    rows += [(s, None, n, 1) for s, n in parts.items() if n]
    rows.append((None, None, total, 3))
    return spark.createDataFrame(rows, "Action_Status string, Variance_Direction string, rows bigint, level int")


def layout(report: DataFrame) -> DataFrame:
    """The report columns in their fixed order."""
    return report.select(*[c for c in REPORT_COLUMNS if c in report.columns])


def urgent_rows(report: DataFrame) -> DataFrame:
    return report.filter(F.col("Restock_Urgency").isin("CRITICAL", "URGENT"))


# Which rows of the report each role works from: status, and urgency or direction.
VIEWS = {
    "manager_restock": lambda: (F.col("Action_Status") == defaults.RESTOCK)
    & (F.col("Restock_Urgency") == "CRITICAL"),
    "manager_anomaly": lambda: F.col("Action_Status") == defaults.ANOMALY,
    "purchasing": lambda: (F.col("Action_Status") == defaults.RESTOCK)
    & (F.col("Restock_Urgency") == "PLAN_ORDER"),
    "finance": lambda: F.col("Estimated_Loss_IDR").isNotNull(),
    "operations": lambda: (F.col("Action_Status") == defaults.ANOMALY)
    & (F.col("Variance_Direction") == defaults.SHRINKAGE),
    "analyst": lambda: F.col("Action_Status") == defaults.INVALID,
}


def role_view(report: DataFrame, role: str) -> DataFrame:
    return report.filter(VIEWS[role]())


def role_counts(report: DataFrame) -> DataFrame:
    """Rows in every role's view, from one pass over the report."""
    counted = report.agg(*[F.count_if(rule()).alias(role) for role, rule in VIEWS.items()])
    return counted.unpivot([], list(VIEWS), "role", "rows")
