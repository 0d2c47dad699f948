"""The three flows: action report, quarantine log, and both written out."""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from larder.operators import classify, consumption, dims, finance, forecast, quality, stock
from larder.session import scratch_folder
from larder.sources import readers, sinks


@dataclass(frozen=True)
class Sources:
    """Raw tables; the readers and any table of the same columns will do."""

    sales: DataFrame
    stock_records: DataFrame
    inventory: DataFrame
    menus: DataFrame
    employees: DataFrame


def load(
    spark: SparkSession,
    sales: str,
    stock: str,
    inventory: str,
    menus: str,
    employees: str,
    multi_line_csv: bool = True,
    multi_line_json: bool = True,
) -> Sources:
    return Sources(
        readers.read_sales(spark, sales, multi_line_csv),
        readers.read_stock_records(spark, stock, multi_line_json),
        readers.read_inventory(spark, inventory),
        readers.read_menus(spark, menus, multi_line_json),
        readers.read_employees(spark, employees, multi_line_json),
    )


def core_report(
    menu_days: DataFrame,
    counts: DataFrame,
    bom: DataFrame,
    thresholds: DataFrame,
    without_recipe: DataFrame,
) -> DataFrame:
    """Status of every (day, item), and the days on which unknown menus were sold."""
    used = consumption.daily_consumption(menu_days, bom)
    known = classify.classify(stock.reconcile(counts, used), thresholds, without_recipe)
    invalid = classify.invalid_groups(menu_days, dims.known_menus(bom))
    return classify.bind_invalid(classify.project_core(known), invalid)


def full_report(core: DataFrame, used: DataFrame, costs: DataFrame) -> DataFrame:
    """Forecast and losses on top of the core report, in the final layout."""
    report = forecast.add_stockout(forecast.trailing_mean(used, core))
    report = finance.add_loss(report, costs)
    places = [c for c in classify.PLACE_COLUMNS if c in report.columns]
    return report.select(*classify.REPORT_COLUMNS, *places)


def build_report(
    valid_sales: DataFrame, sources: Sources, keep: Callable[[DataFrame, str], DataFrame] = lambda df, name: df
) -> DataFrame:
    """The report from clean sales, as a plan.

    Sales per day and menu and the recipe list are read by the consumption, the
    forecast, its period and the invalid rows; none of them goes back to the sales.
    Both are small next to their sources. ``keep`` may write them, given a name;
    otherwise Spark reuses their exchanges.
    """
    spark = valid_sales.sparkSession
    bom = keep(dims.flatten_menus(sources.menus), "bom")
    menu_days = keep(consumption.sales_by_menu_day(valid_sales), "menu_days")
    used = consumption.daily_consumption(menu_days, bom)
    core = core_report(
        menu_days,
        stock.cleanse_stock(sources.stock_records),
        bom,
        dims.thresholds(sources.inventory, dims.carton_units(spark)),
        dims.no_recipe_items(spark),
    )
    return full_report(core, used, dims.unit_costs(spark))


def action_report(sources: Sources) -> DataFrame:
    return build_report(quality.valid_sales(sources.sales), sources)


def quarantine_log(sources: Sources) -> DataFrame:
    return quality.quarantine_part(quality.tag_sales(sources.sales))


def run(sources: Sources, out: str, scratch: str, fmt: str = "csv") -> DataFrame:
    """Write report and quarantine log under ``out``; rows per status come back.

    Tables that are read more than once are written below ``scratch``, a folder that
    all executors reach, and removed at the end, whether the run succeeds or fails. The sales
    are read and parsed once, into a table from which repeats are found by narrow columns; the tagged
    ones are written in a clean and a rejected part for both outputs. Statuses are counted as the report is written.
    """
    spark = sources.sales.sparkSession
    with scratch_folder(spark, scratch) as keep:
        rejected = F.col(quality.REASON).isNotNull()
        rows = keep(quality.tag_rows(sources.sales), "rows")
        tagged = keep(quality.mark_repeats(rows).withColumn("_rejected", rejected), "tagged", ("_rejected",))
        parts = tagged.filter(F.col("_rejected")), tagged.filter(~F.col("_rejected"))
        quarantine, clean = (part.drop("_rejected", "_ord") for part in parts)
        sinks.write_quarantine(quarantine, f"{out}/quarantine_log", fmt)
        watch = Observation("statuses")
        report = keep(classify.watch_statuses(build_report(clean.drop(quality.REASON), sources, keep), watch), "report")
        sinks.write_report(report, f"{out}/Action_Report", fmt)
        return classify.watched_counts(spark, watch)
