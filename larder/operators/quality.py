"""Cleansing of sales: every rejected row gets exactly one reason."""

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder import defaults
from larder.functions.dates import timestamp_steps
from larder.functions.numbers import quantity_steps
from larder.functions.steps import apply_steps
from larder.functions.text import is_error_flag, strip_ws
from larder.operators.lookups import flag_missing
from larder.operators.ordered import flag_repeats, keep_first
from larder.operators.settle import settle

REASON = "Quarantine_Reason"
PARSED = ("DateTime_Parsed", "Date", "Quantity_Clean")
QUANTITY_REASONS = (defaults.NEGATIVE, defaults.BAD_QUANTITY, defaults.ZERO)

Rule = tuple[str, Column]


def parse_sales(sales: DataFrame) -> DataFrame:
    """Add the typed columns; each is null where its text cannot be read."""
    stamp = timestamp_steps("DateTime", "DateTime_Parsed")
    quantity = quantity_steps("Quantity", "Quantity_Clean", "is_negative")
    return apply_steps(sales, stamp, quantity).withColumn("Date", F.to_date("DateTime_Parsed"))


def missing_critical() -> Column:
    """Without these three a sale cannot be used; the id is not among them."""
    return F.col("DateTime").isNull() | F.col("Menu_ID").isNull() | F.col("Quantity").isNull()


def row_rules() -> list[Rule]:
    """Rules that need one parsed row only, in the order in which they apply."""
    quantity = F.col("Quantity_Clean")
    return [
        (defaults.ERROR_FLAG, is_error_flag(F.col("Additional_Info"))),
        (defaults.NULL_FIELD, missing_critical()),
        (defaults.BAD_DATE, F.col("DateTime_Parsed").isNull()),
        (defaults.NEGATIVE, F.col("is_negative")),
        (defaults.BAD_QUANTITY, quantity.isNull()),
        (defaults.ZERO, quantity == 0),
    ]


def first_violation(rules: Sequence[Rule]) -> Column:
    """Reason of the first rule that holds, null if none does."""
    (name, broken), *later = rules
    reason = F.when(broken, F.lit(name))
    for name, broken in later:
        reason = reason.when(broken, F.lit(name))
    return reason


def tag_rows(sales: DataFrame) -> DataFrame:
    """Parse and tag by the row rules alone (also fits a streaming DataFrame)."""
    tagged = parse_sales(sales).withColumn(REASON, first_violation(row_rules()))
    return settle(tagged.drop("is_negative"), [*PARSED, REASON])


def mark_repeats(
    rows: DataFrame, key: str = "Transaction_ID", order: str = "_ord", among: DataFrame | None = None
) -> DataFrame:
    """Rows of ``tag_rows`` with repeated ids tagged as such, whatever else they break.

    The first places of ids come from narrow rows of ``among``, by default ``rows`` themselves, which
    should then be a written table: a plan would be worked out twice.
    """
    tagged = flag_repeats(rows, key, order, "_repeat", among=among)
    reason = F.when(F.col("_repeat"), F.lit(defaults.DUPLICATE)).otherwise(F.col(REASON))
    tagged = tagged.withColumn(REASON, reason).drop("_repeat")
    reached = F.col(REASON).isNull() | F.col(REASON).isin(*QUANTITY_REASONS)
    return tagged.withColumns({c: F.when(reached, F.col(c)) for c in PARSED})


def tag_sales(sales: DataFrame, key: str = "Transaction_ID", order: str = "_ord") -> DataFrame:
    """Every sale with its typed columns and its one reason.

    A repeated id outranks all other reasons, and the first occurrence counts even
    if it is itself rejected. Typed columns are filled as far as the row got.
    """
    return mark_repeats(tag_rows(sales), key, order, among=sales)


def clean_part(tagged: DataFrame) -> DataFrame:
    return tagged.filter(F.col(REASON).isNull()).drop(REASON)


def quarantine_part(tagged: DataFrame) -> DataFrame:
    return tagged.filter(F.col(REASON).isNotNull())


def valid_sales(sales: DataFrame, key: str = "Transaction_ID", order: str = "_ord") -> DataFrame:
    """The clean part alone, without carrying rejected rows through a shuffle.

    Same rows as ``clean_part(tag_sales(sales))``. Rows that break a row rule go
    before the join, which then moves the columns the caller uses and no others.
    """
    kept = tag_rows(sales).filter(F.col(REASON).isNull()).drop(REASON)
    return keep_first(kept, key, order, among=sales)


def flag_unknown_menus(
    clean: DataFrame, menus: DataFrame, flag: str = "is_ghost_menu"
) -> DataFrame:
    trimmed = clean.withColumn("Menu_ID", strip_ws(F.col("Menu_ID")))
    return flag_missing(trimmed, "Menu_ID", menus, flag)


def flag_unknown_employees(
    clean: DataFrame, employees: DataFrame, flag: str = "is_unknown_employee"
) -> DataFrame:
    """Sales stay as they are if there is no employee list at all."""
    listed = employees.agg(F.count("*")).scalar() > 0
    named = strip_ws(F.coalesce(F.col("Employee_ID"), F.lit(defaults.UNKNOWN_EMPLOYEE)))
    named = clean.withColumn("Employee_ID", F.when(listed, named).otherwise(F.col("Employee_ID")))
    flagged = flag_missing(named, "Employee_ID", employees, flag)
    return flagged.withColumn(flag, F.col(flag) & listed)


def unknown_counts(clean: DataFrame, key: str, flag: str, flagged: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Rows per id that the lookup ``flagged`` does not know, from sales counted per id first."""
    groups = flagged(clean.groupBy(key).agg(F.count("*").alias("_n")))
    return groups.filter(F.col(flag)).groupBy(key).agg(F.sum("_n").alias("rows"))


def unknown_menu_counts(clean: DataFrame, menus: DataFrame) -> DataFrame:
    return unknown_counts(clean, "Menu_ID", "is_ghost_menu", lambda ids: flag_unknown_menus(ids, menus))


def unknown_employee_counts(clean: DataFrame, employees: DataFrame) -> DataFrame:
    """The sales that someone should look into: they stay valid."""
    return unknown_counts(clean, "Employee_ID", "is_unknown_employee", lambda ids: flag_unknown_employees(ids, employees))


REASONS = (
    defaults.DUPLICATE, defaults.ERROR_FLAG, defaults.NULL_FIELD, defaults.BAD_DATE,
    defaults.NEGATIVE, defaults.BAD_QUANTITY, defaults.ZERO,
)


def cleansing_metrics(
    tagged: DataFrame, menus: DataFrame, employees: DataFrame
) -> DataFrame:
    """One row: all rows, rows per reason, valid rows, unknown menus and employees.

    Counted per (reason, menu, employee) first, so that the lookups meet a few
    groups instead of all sales.
    """
    groups = tagged.groupBy(REASON, "Menu_ID", "Employee_ID").agg(F.count("*").alias("_n"))
    groups = flag_unknown_menus(groups, menus)
    groups = flag_unknown_employees(groups, employees)
    n, valid = F.col("_n"), F.col(REASON).isNull()

    def total(when: Column) -> Column:
        return F.coalesce(F.sum(F.when(when, n)), F.lit(0))

    return groups.agg(
        total(F.lit(True)).alias("raw_rows"),
        *[total(F.col(REASON) == r).alias(r.lower()) for r in REASONS],
        total(valid).alias("valid_rows"),
        total(~valid).alias("quarantined_rows"),
        total(valid & F.col("is_ghost_menu")).alias("unknown_menu_rows"),
        total(valid & F.col("is_unknown_employee")).alias("unknown_employee_rows"),
    )


def triage(quarantine: DataFrame) -> DataFrame:
    """Add what a rejected sale may still be worth."""
    reason = F.col(REASON)
    label, recovery = F.lit("UNRECOVERABLE"), F.lit("NONE")
    for name, cls, chance in defaults.TRIAGE:
        label = F.when(reason == name, cls).otherwise(label)
        recovery = F.when(reason == name, chance).otherwise(recovery)
    return quarantine.withColumns({"Triage_Class": label, "Recovery": recovery})


def _part(rows: str = "rows") -> Column:
    """A counted row as a part of all counted rows, which are few."""
    return F.col(rows) / F.sum(rows).over(Window.partitionBy(F.lit(0)))


def triage_summary(quarantine: DataFrame) -> DataFrame:
    """Rows per class and the part of the whole quarantine they make up."""
    counted = quarantine.groupBy(REASON).agg(F.count("*").alias("_n"))
    classes = triage(counted).groupBy("Triage_Class", "Recovery").agg(F.sum("_n").alias("rows"))
    return classes.select("*", (F.col("Recovery") != "NONE").alias("recoverable"), _part().alias("share"))


def reason_shares(tagged: DataFrame) -> DataFrame:
    """Each reason as a part of the quarantine and of all sales."""
    counted = tagged.groupBy(REASON).agg(F.count("*").alias("rows"))
    rejected = F.col(REASON).isNotNull()
    shared = counted.withColumn("share_of_total", _part())
    return shared.filter(rejected).select(REASON, "rows", _part().alias("share_of_quarantine"), "share_of_total")


def value_shares(df: DataFrame, column: str) -> DataFrame:
    """Rows per value of ``column`` and their part of the table."""
    counted = df.groupBy(column).agg(F.count("*").alias("rows"))
    return counted.select(column, "rows", _part().alias("share"))


def item_quarantine_rate(
    tagged: DataFrame, bom: DataFrame, low: float = 0.05, high: float = 0.20
) -> DataFrame:
    """Part of the sales of an item's menus that was rejected, with a band.

    Sales are counted per menu first; the recipe join then sees one row per menu.
    """
    menus = tagged.groupBy(strip_ws(F.col("Menu_ID")).alias("Menu_ID")).agg(
        F.count("*").alias("_all"), F.count(REASON).alias("_out")
    )
    rate = F.col("rejected") / F.col("sales")
    return (
        menus.join(bom.select("Menu_ID", "Item_ID"), "Menu_ID")
        .groupBy("Item_ID")
        .agg(F.sum("_all").alias("sales"), F.sum("_out").alias("rejected"))
        .withColumn("rate", rate)
        .withColumn(
            "band", F.when(rate < low, "LOW").when(rate > high, "HIGH").otherwise("MEDIUM")
        )
    )
