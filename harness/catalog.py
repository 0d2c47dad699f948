"""One query per operator, each over the whole derived tables."""

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from harness import inputs
from larder.functions import dates, numbers, text
from larder.operators import (
    classify, consumption, dims, finance, forecast, profile, quality, quantiles, stock,
)
from larder.operators.ordered import flag_repeats
from larder.operators.settle import settle
from larder.plans import report as flows
from larder.session import new_path, stage
from larder.sources import readers, sinks

REASON = quality.REASON


class Case:
    """The derived tables and the steps most queries start from.

    All of them are plans, but for the two small tables that consumption comes from. Else only queries of
    files, the exact quantile and the comparison of data sets write tables before their result is asked for.
    """

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def raw_sales(self) -> DataFrame:
        return inputs.sales(self.spark, self.sf_dir)

    @cached_property
    def sales(self) -> DataFrame:
        return readers.normalise_nulls(self.raw_sales, columns=readers.SALES_COLUMNS)

    @cached_property
    def records(self) -> DataFrame:
        return inputs.stock_records(self.spark, self.sf_dir)

    @cached_property
    def raw_inventory(self) -> DataFrame:
        return inputs.inventory(self.spark, self.sf_dir)

    @cached_property
    def inventory(self) -> DataFrame:
        return readers.clean_inventory(self.raw_inventory)

    @cached_property
    def menus(self) -> DataFrame:
        return inputs.menus(self.spark, self.sf_dir)

    @cached_property
    def employees(self) -> DataFrame:
        return inputs.employees(self.spark, self.sf_dir)

    @cached_property
    def sources(self) -> flows.Sources:
        return flows.Sources(self.sales, self.records, self.inventory, self.menus, self.employees)

    @cached_property
    def tagged(self) -> DataFrame:
        return quality.tag_sales(self.sales)

    @cached_property
    def clean(self) -> DataFrame:
        return quality.valid_sales(self.sales)

    @cached_property
    def bom(self) -> DataFrame:
        return dims.flatten_menus(self.menus)

    @cached_property
    def kept_bom(self) -> DataFrame:
        return self.keep(self.bom, "bom")

    @cached_property
    def known_menus(self) -> DataFrame:
        return dims.known_menus(self.bom)

    @cached_property
    def known_employees(self) -> DataFrame:
        return dims.known_employees(self.employees)

    @cached_property
    def menu_days(self) -> DataFrame:
        """Written, as the forecast, its period and the invalid rows would each parse the sales again."""
        return self.keep(consumption.sales_by_menu_day(self.clean), "menu_days")

    @cached_property
    def used(self) -> DataFrame:
        return consumption.daily_consumption(self.menu_days, self.kept_bom)

    @cached_property
    def counts(self) -> DataFrame:
        return stock.cleanse_stock(self.records)

    @cached_property
    def recon(self) -> DataFrame:
        return stock.reconcile(self.counts, self.used)

    @cached_property
    def cartons(self) -> DataFrame:
        return dims.carton_units(self.spark)

    @cached_property
    def thresholds(self) -> DataFrame:
        return dims.thresholds(self.inventory, self.cartons)

    @cached_property
    def classified(self) -> DataFrame:
        return classify.classify(self.recon, self.thresholds, dims.no_recipe_items(self.spark))

    @cached_property
    def invalid(self) -> DataFrame:
        return classify.invalid_groups(self.menu_days, dims.known_menus(self.kept_bom))

    @cached_property
    def core(self) -> DataFrame:
        return classify.bind_invalid(classify.project_core(self.classified), self.invalid)

    @cached_property
    def forecast(self) -> DataFrame:
        return forecast.trailing_mean(self.used, self.core)

    @cached_property
    def report(self) -> DataFrame:
        valid = quality.valid_sales(self.sales)
        return flows.build_report(valid, self.sources, self.keep)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Written once in the shared folder, as sales are parsed for it."""
        return stage(df, new_path(self.spark, name))

    def sales_profile(self, *columns: Column) -> DataFrame:
        """Sales counted by the given columns."""
        return _counted(self.sales.select(*columns))


def _counted(df: DataFrame) -> DataFrame:
    return df.groupBy(*df.columns).agg(F.count("*").alias("rows"))


def _core_only(df: DataFrame) -> DataFrame:
    return df.drop(*classify.PLACE_COLUMNS)


# Sources and sinks: the derived tables go to files in the shared folder and back.


def s01_csv_scan(c: Case) -> DataFrame:
    path = new_path(c.spark, "sales")
    sinks.write_table(c.raw_sales.select(*readers.SALES_COLUMNS), path, "csv")
    return readers.read_sales(c.spark, path).drop("_ord")


def _json_documents(df: DataFrame, field: str, by: Column, path: str) -> None:
    """One file with one document per value of ``by``, with an array of records."""
    record = F.struct(*[col for col in df.columns if col != "_ord"])
    documents = df.groupBy(by.alias("_by")).agg(F.collect_list(record).alias(field))
    text = F.to_json(F.struct(field), {"ignoreNullFields": "false"})
    documents.select(F.coalesce(F.col("_by").cast("string"), F.lit("none")).alias("_by"), text.alias("value")).write.partitionBy("_by").text(path)


def s02_stock_scan(c: Case) -> DataFrame:
    path = new_path(c.spark, "stock")
    # A document holds the records of a year, two a day at most.
    _json_documents(c.records, "records", F.floor(F.col("_ord") / 744), path)
    read = readers.read_stock_records(c.spark, path)
    return read.select("record_id", "date", "recorded_by", F.size("stock_entries").cast("bigint").alias("entries"))


def s03_inventory_scan(c: Case) -> DataFrame:
    path = new_path(c.spark, "inventory")
    sinks.write_table(c.raw_inventory.drop("_ord"), path, "csv")
    return readers.read_inventory(c.spark, path).drop("_ord")


def s04_menu_scan(c: Case) -> DataFrame:
    path = new_path(c.spark, "menus")
    _json_documents(c.menus, "menu_items", F.floor(F.col("_ord") / 5), path)
    read = readers.read_menus(c.spark, path)
    return read.select(
        "Menu_ID", "Menu_Name", "Selling_Price_IDR", F.size("ingredients").cast("bigint").alias("links")
    )


def s05_employee_scan(c: Case) -> DataFrame:
    path = new_path(c.spark, "employees")
    _json_documents(c.employees, "employees", F.col("Shift"), path)
    return readers.read_employees(c.spark, path).drop("_ord")


def s06_source_policy(c: Case) -> DataFrame:
    path = new_path(c.spark, "sources")
    sinks.write_table(c.raw_sales.select(*readers.SALES_COLUMNS), f"{path}/sales", "csv")
    _json_documents(c.records, "records", F.floor(F.col("_ord") / 744), f"{path}/stock")
    sinks.write_table(c.raw_inventory.drop("_ord"), f"{path}/inventory", "csv")
    _json_documents(c.menus, "menu_items", F.floor(F.col("_ord") / 5), f"{path}/menus")
    loaded = flows.load(
        c.spark, f"{path}/sales", f"{path}/stock", f"{path}/inventory", f"{path}/menus",
        f"{path}/no-such-employees",
    )
    rows = None
    for source, df, required in (
        ("sales", loaded.sales, True), ("stock", loaded.stock_records, True),
        ("inventory", loaded.inventory, True), ("menus", loaded.menus, True),
        ("employees", loaded.employees, False),
    ):
        row = df.agg(F.count("*").alias("rows")).select(
            F.lit(source).alias("source"), F.lit(required).alias("required"), "rows"
        )
        rows = row if rows is None else rows.unionByName(row)
    return rows


def s07_report_sink(c: Case) -> DataFrame:
    path = new_path(c.spark, "Action_Report")
    sinks.write_report(c.report, path)
    schema = _core_only(c.report).schema
    # An empty note is a quoted empty text in the file and a null is a bare one; the
    # reader tells them apart if the mark of a null is not itself the empty text.
    read = c.spark.read.schema(schema).option("header", True).option("nullValue", "\x01")
    return read.option("escape", '"').csv(path)


def s08_quarantine_sink(c: Case) -> DataFrame:
    path = new_path(c.spark, "quarantine_log")
    log = quality.quarantine_part(c.tagged).drop("_ord")
    sinks.write_quarantine(log, path)
    read = c.spark.read.schema(log.schema).option("header", True).option("multiLine", True)
    return sinks.count_reasons(read.option("escape", '"').csv(path))


# Cleansing of sales.


def c01_null_tokens(c: Case) -> DataFrame:
    return c.sales.select(*readers.SALES_COLUMNS)


def c02_keep_first(c: Case) -> DataFrame:
    return flag_repeats(c.sales, "Transaction_ID").select("Transaction_ID", "_ord.*", "is_duplicate")


def c03_error_flag(c: Case) -> DataFrame:
    info = F.col("Additional_Info")
    return c.sales_profile(info, text.is_error_flag(info).alias("error_flag"))


def c04_missing_critical(c: Case) -> DataFrame:
    return c.sales_profile(
        F.col("DateTime").isNull().alias("no_date"), F.col("Menu_ID").isNull().alias("no_menu"),
        F.col("Quantity").isNull().alias("no_quantity"), quality.missing_critical().alias("missing"),
    )


def c05_parse_timestamp(c: Case) -> DataFrame:
    return _counted(dates.with_timestamp(c.sales.select("DateTime")))


def c06_bad_dates(c: Case) -> DataFrame:
    read = dates.with_timestamp(c.sales.select("DateTime"))
    bad = F.col("DateTime").isNotNull() & F.col("DateTime_Parsed").isNull()
    return _where(read, bad, "DateTime")


def c07_dates(c: Case) -> DataFrame:
    read = dates.with_timestamp(c.sales.select("DateTime"))
    return _counted(read.select(F.to_date("DateTime_Parsed").alias("Date")))


def _quantity_layer(layer: Callable[[Column], Column]) -> Callable[[Case], DataFrame]:
    def query(c: Case) -> DataFrame:
        point = numbers.prepare(F.col("Quantity"))
        read = c.sales.select("Quantity", point.alias("_text"))
        return _counted(read.select("Quantity", layer(F.col("_text")).alias("value")))

    return query


def _quantities(c: Case) -> DataFrame:
    return numbers.with_quantity(c.sales.select("Quantity"))


def c08_parse_quantity(c: Case) -> DataFrame:
    return _counted(_quantities(c).drop("is_negative"))


def _where(df: DataFrame, test: Column, column: str) -> DataFrame:
    hits = settle(df.withColumn("_hit", test), ["_hit"]).filter("_hit")
    return _counted(hits.select(column))


def c09_negative_quantity(c: Case) -> DataFrame:
    return _where(_quantities(c), F.col("is_negative"), "Quantity")


def c10_bad_quantity(c: Case) -> DataFrame:
    bad = F.col("Quantity_Clean").isNull() & ~F.col("is_negative")
    return _where(_quantities(c), bad, "Quantity")


def c11_zero_quantity(c: Case) -> DataFrame:
    return _where(_quantities(c), F.col("Quantity_Clean") == 0, "Quantity")


def c12_valid_sales(c: Case) -> DataFrame:
    return c.clean.select("Transaction_ID", "DateTime_Parsed", "Menu_ID", "Quantity_Clean")


def c13_unknown_menus(c: Case) -> DataFrame:
    flagged = quality.flag_unknown_menus(_counted(c.clean.select("Menu_ID")), c.known_menus)
    return flagged.groupBy("Menu_ID", "is_ghost_menu").agg(F.sum("rows").alias("rows"))


def c14_unknown_employees(c: Case) -> DataFrame:
    flagged = quality.flag_unknown_employees(_counted(c.clean.select("Employee_ID")), c.known_employees)
    return flagged.groupBy("Employee_ID", "is_unknown_employee").agg(F.sum("rows").alias("rows"))


def c13_unknown_menu_counts(c: Case) -> DataFrame:
    return quality.unknown_menu_counts(c.clean, c.known_menus)


def c14_unknown_employee_counts(c: Case) -> DataFrame:
    return quality.unknown_employee_counts(c.clean, c.known_employees)


def c15_tagged_sales(c: Case) -> DataFrame:
    return c.tagged.select(*readers.SALES_COLUMNS, *quality.PARSED, REASON)


def c16_metrics(c: Case) -> DataFrame:
    return quality.cleansing_metrics(c.tagged, c.known_menus, c.known_employees)


# Daily counts.


def w01_flatten_stock(c: Case) -> DataFrame:
    return stock.flatten_stock(c.records).drop("_ord", "_pos")


def w02_key_drift(c: Case) -> DataFrame:
    return stock.explode_entries(c.records).select(
        "record_id", F.col("_pos").cast("bigint").alias("pos"),
        stock.stock_text(F.col("_entry")).alias("stock_text"),
    )


def w03_typed_entries(c: Case) -> DataFrame:
    flat = stock.flatten_stock(c.records)
    totals = flat.groupBy("_ord").agg(
        F.count("*").alias("entries"), F.sum("stock_remaining").alias("stock"),
        F.sum("delivery_in").alias("delivered"),
    )
    return c.records.select("record_id", "_ord").join(totals, "_ord").drop("_ord")


def w04_labels(c: Case) -> DataFrame:
    return _counted(stock.flatten_stock(c.records).select("Item_ID", "UoM"))


def w05_record_dates(c: Case) -> DataFrame:
    read = stock.with_record_date(c.records.select("date"), "day")
    return _counted(read).withColumnRenamed("rows", "records")


def w06_clip_negative(c: Case) -> DataFrame:
    flat = stock.flatten_stock(c.records).withColumn("raw_stock", F.col("stock_remaining"))
    return stock.clip_negative(flat).select("Date", "Item_ID", "raw_stock", "stock_remaining")


def w07_stock_profile(c: Case) -> DataFrame:
    return stock.stock_profile(stock.flatten_stock(c.records))


# Dimensions.


def d01_unit_conversion(c: Case) -> DataFrame:
    converted = dims.convert_thresholds(c.inventory, c.cartons)
    return converted.select("Item_ID", "Supplier_UoM", "Min_Stock_Threshold", "Min_Threshold", "Fallback_Reason")


def d02_last_threshold(c: Case) -> DataFrame:
    return c.thresholds


def d03_recipe_links(c: Case) -> DataFrame:
    return dims.flatten_menus(c.menus)


def d04_known_employees(c: Case) -> DataFrame:
    return c.known_employees


def d05_known_menus(c: Case) -> DataFrame:
    return dims.known_menus(dims.flatten_menus(c.menus))


def d06_carton_units(c: Case) -> DataFrame:
    cartons = c.inventory.filter(text.strip_ws(F.col("Supplier_UoM")) == "Karton")
    return cartons.join(c.cartons, "Item_ID", "left").select("Item_ID", "Carton_Units").distinct()


def d07_unit_costs(c: Case) -> DataFrame:
    return c.inventory.select("Item_ID").distinct().join(dims.unit_costs(c.spark), "Item_ID", "left")


def d08_no_recipe(c: Case) -> DataFrame:
    return dims.items_without_recipe(c.inventory, dims.flatten_menus(c.menus))


# Consumption and reconciliation.


def j01_known_sales(c: Case) -> DataFrame:
    menus = c.clean.groupBy("Menu_ID").agg(F.count("*").alias("rows"), F.sum("Quantity_Clean").alias("quantity"))
    known = consumption.drop_unknown_menus(quality.flag_unknown_menus(menus, c.known_menus))
    return known.groupBy("Menu_ID").agg(F.sum("rows").alias("rows"), F.sum("quantity").alias("quantity"))


def _menu_sales(c: Case, *columns: str) -> DataFrame:
    return c.clean.withColumn("Menu_ID", text.strip_ws(F.col("Menu_ID"))).select("Menu_ID", *columns)


def j02_expand_recipes(c: Case) -> DataFrame:
    expanded = consumption.expand_recipes(_counted(_menu_sales(c)), c.bom)
    return expanded.groupBy("Menu_ID", "Item_ID").agg(F.sum("rows").alias("rows"))


def j03_consumed(c: Case) -> DataFrame:
    sales = _menu_sales(c, "Transaction_ID", "Date", "Quantity_Clean")
    expanded = consumption.add_consumed(consumption.expand_recipes(sales, c.bom))
    return expanded.select("Transaction_ID", "Date", "Item_ID", "Total_Consumed")


def j04_daily_consumption(c: Case) -> DataFrame:
    # Reads the sales once, so nothing needs to be written on the way.
    return consumption.daily_consumption(
        consumption.sales_by_menu_day(c.clean), dims.flatten_menus(c.menus)
    )


def j05_consumption_profile(c: Case) -> DataFrame:
    return consumption.consumption_profile(j04_daily_consumption(c))


def j06_previous_count(c: Case) -> DataFrame:
    counted = stock.previous_count(c.counts)
    return counted.select(
        "Date", "Item_ID", F.col("_ord").alias("rec_ord"), _entry_place(), "stock_remaining",
        "Prev_Physical",
    )


def _entry_place() -> Column:
    # The list place of the entry; its customer group is in the item's number.
    return F.col("_pos").cast("bigint").alias("pos")


def j07_attach_consumption(c: Case) -> DataFrame:
    joined = stock.attach_consumption(c.counts, j04_daily_consumption(c))
    return joined.select("Date", "Item_ID", F.col("_ord").alias("rec_ord"), "stock_remaining", "POS_Consumed")


def j08_orphan_days(c: Case) -> DataFrame:
    return stock.orphan_days(j04_daily_consumption(c), c.counts)


def j08_orphan_items(c: Case) -> DataFrame:
    return stock.orphan_items(j04_daily_consumption(c), c.counts)


def _recon(c: Case) -> DataFrame:
    return stock.reconcile(c.counts, j04_daily_consumption(c))


def j09_expected_stock(c: Case) -> DataFrame:
    return _recon(c).select("Date", "Item_ID", F.col("_ord").alias("rec_ord"), "Expected_Stock")


def j10_variance(c: Case) -> DataFrame:
    return _recon(c).select(
        "Date", "Item_ID", F.col("_ord").alias("rec_ord"), "Expected_Stock", "Variance"
    )


def j10_variance_profile(c: Case) -> DataFrame:
    return stock.reconcile_profile(_recon(c))


# Classification.


def k01_invalid_groups(c: Case) -> DataFrame:
    menu_days = consumption.sales_by_menu_day(c.clean)
    return classify.invalid_groups(menu_days, dims.known_menus(dims.flatten_menus(c.menus)))


def _classified(c: Case) -> DataFrame:
    return classify.classify(_recon(c), c.thresholds, dims.no_recipe_items(c.spark))


def k02_status(c: Case) -> DataFrame:
    return _classified(c).select(
        "Date", "Item_ID", F.col("_ord").alias("rec_ord"), "Variance", "stock_remaining", "Action_Status"
    )


def k03_direction(c: Case) -> DataFrame:
    return _classified(c).select(
        "Date", "Item_ID", F.col("_ord").alias("rec_ord"), "Action_Status", "Variance_Direction"
    )


def k04_notes(c: Case) -> DataFrame:
    noted = classify.attach_notes(c.counts, dims.no_recipe_items(c.spark))
    return _counted(noted.select("Item_ID", "Item_Note"))


def k05_thresholds(c: Case) -> DataFrame:
    return _counted(classify.attach_thresholds(c.counts, c.thresholds).select("Item_ID", "Min_Threshold"))


def k06_status_counts(c: Case) -> DataFrame:
    return classify.status_counts(c.core)


def k07_core_columns(c: Case) -> DataFrame:
    return _core_only(classify.project_core(_classified(c)))


def k08_bind_invalid(c: Case) -> DataFrame:
    return _core_only(c.core)


def k09_sorted_report(c: Case) -> DataFrame:
    return classify.sort_report(c.core)


# Forecast and finance.


def b01_dense_grid(c: Case) -> DataFrame:
    return forecast.day_runs(c.used)


def b02_trailing_mean(c: Case) -> DataFrame:
    at = c.counts.select("Date", "Item_ID", F.col("_ord").alias("rec_ord"))
    return forecast.trailing_mean(c.used, at)


def b03_unpivot(c: Case) -> DataFrame:
    means = forecast.trailing_mean(c.used, forecast.active_days(c.used))
    long = forecast.to_long(forecast.to_wide(means, inputs.ITEMS, forecast.MEAN), inputs.ITEMS)
    return long.filter(F.col(forecast.MEAN) != 0)


def b03w_pivot(c: Case) -> DataFrame:
    return forecast.to_wide(c.used, inputs.ITEMS)


def b04_attach_forecast(c: Case) -> DataFrame:
    return c.forecast.select("Date", "Item_ID", "Action_Status", "Physical_Stock", forecast.MEAN)


def b05_days_to_stockout(c: Case) -> DataFrame:
    return forecast.add_stockout(c.forecast).select(
        "Date", "Item_ID", "Physical_Stock", "Min_Threshold", forecast.MEAN, "Days_to_Stockout"
    )


def b06_urgency(c: Case) -> DataFrame:
    return _counted(forecast.add_stockout(c.forecast).select("Restock_Urgency", "Days_to_Stockout"))


def b07_urgent_count(c: Case) -> DataFrame:
    return classify.urgent_rows(forecast.add_stockout(c.forecast)).agg(F.count("*").alias("urgent_rows"))


def _priced(c: Case) -> DataFrame:
    return finance.add_loss(_classified(c), dims.unit_costs(c.spark))


def b08_loss(c: Case) -> DataFrame:
    return _priced(c).filter(F.col(finance.LOSS).isNotNull()).select("Date", "Item_ID", "Variance", finance.LOSS)


def b09_loss_summary(c: Case) -> DataFrame:
    return finance.loss_summary(_priced(c))


def b10_action_report(c: Case) -> DataFrame:
    return classify.layout(c.report)


def b11_run_summary(c: Case) -> DataFrame:
    return classify.status_counts(c.report)


# Source audit.


def a01_key_profile(c: Case) -> DataFrame:
    return profile.key_profile(c.raw_sales)


def a02_emptiness(c: Case) -> DataFrame:
    return profile.emptiness_profile(c.raw_sales)


def a03_quantity_profile(c: Case) -> DataFrame:
    return profile.quantity_profile(c.raw_sales)


def a04_date_formats(c: Case) -> DataFrame:
    return profile.date_formats(c.raw_sales)


def a05_unknown_dates(c: Case) -> DataFrame:
    return profile.unknown_dates(c.raw_sales)


def a06_stock_drift(c: Case) -> DataFrame:
    return profile.stock_drift(c.records)


def a07_units(c: Case) -> DataFrame:
    return profile.unit_distribution(c.raw_inventory)


def a08_menu_profile(c: Case) -> DataFrame:
    return profile.menu_profile(c.menus)


def a09_employees(c: Case) -> DataFrame:
    return profile.employee_list(c.employees)


def a11_sales_audit(c: Case) -> DataFrame:
    return profile.sales_audit(c.raw_sales)


def a10_source_summary(c: Case) -> DataFrame:
    return profile.source_summary(c.raw_sales, c.records, c.raw_inventory, c.menus, c.employees)


# Shares, triage, bounds and views.


def t01_triage(c: Case) -> DataFrame:
    return quality.triage_summary(quality.quarantine_part(c.tagged))


def t02_outlier_bound(c: Case) -> DataFrame:
    return quantiles.outlier_bound(c.keep(_recon(c).select("Variance"), "variance"), "Variance")


def t03_reason_shares(c: Case) -> DataFrame:
    return quality.reason_shares(c.tagged)


def t03_status_shares(c: Case) -> DataFrame:
    return quality.value_shares(c.core, "Action_Status")


def t04_item_rates(c: Case) -> DataFrame:
    return quality.item_quarantine_rate(c.tagged, dims.flatten_menus(c.menus))


def t05_role_views(c: Case) -> DataFrame:
    return classify.role_counts(c.report)


def t06_datasets(c: Case) -> DataFrame:
    keyed = c.sales.withColumn("_id", F.struct("dataset", "Transaction_ID"))
    tagged = c.keep(quality.tag_sales(keyed, key="_id").select("dataset", REASON, "Date", "Menu_ID"), "tagged")
    groups = quality.clean_part(tagged).select(
        "dataset", "Date", text.strip_ws(F.col("Menu_ID")).alias("Menu_ID")
    ).distinct()
    unknown = groups.join(c.known_menus, "Menu_ID", "left_anti")
    rows = stock.flatten_stock(c.records).agg(F.count("*")).scalar()
    return profile.compare_datasets(tagged, "dataset", unknown, rows)


_CASES: dict[str, Callable[[Case], DataFrame]] = {
    "c08a_quantity_number": _quantity_layer(numbers.quantity_number),
    "c08b_quantity_word": _quantity_layer(numbers.quantity_word),
    "c08c_quantity_in_text": _quantity_layer(numbers.quantity_in_text),
}
for _query in (
    s01_csv_scan, s02_stock_scan, s03_inventory_scan, s04_menu_scan, s05_employee_scan,
    s06_source_policy, s07_report_sink, s08_quarantine_sink,
    c01_null_tokens, c02_keep_first, c03_error_flag, c04_missing_critical, c05_parse_timestamp,
    c06_bad_dates, c07_dates, c08_parse_quantity, c09_negative_quantity, c10_bad_quantity, c11_zero_quantity,
    c12_valid_sales, c13_unknown_menus, c13_unknown_menu_counts, c14_unknown_employees,
    c14_unknown_employee_counts, c15_tagged_sales, c16_metrics,
    w01_flatten_stock, w02_key_drift, w03_typed_entries, w04_labels, w05_record_dates,
    w06_clip_negative, w07_stock_profile,
    d01_unit_conversion, d02_last_threshold, d03_recipe_links, d04_known_employees,
    d05_known_menus, d06_carton_units, d07_unit_costs, d08_no_recipe,
    j01_known_sales, j02_expand_recipes, j03_consumed, j04_daily_consumption,
    j05_consumption_profile, j06_previous_count, j07_attach_consumption, j08_orphan_days,
    j08_orphan_items, j09_expected_stock, j10_variance, j10_variance_profile,
    k01_invalid_groups, k02_status, k03_direction, k04_notes, k05_thresholds, k06_status_counts,
    k07_core_columns, k08_bind_invalid, k09_sorted_report,
    b01_dense_grid, b02_trailing_mean, b03_unpivot, b03w_pivot, b04_attach_forecast,
    b05_days_to_stockout, b06_urgency, b07_urgent_count, b08_loss, b09_loss_summary,
    b10_action_report, b11_run_summary,
    a01_key_profile, a02_emptiness, a03_quantity_profile, a04_date_formats, a05_unknown_dates,
    a06_stock_drift, a07_units, a08_menu_profile, a09_employees, a10_source_summary, a11_sales_audit,
    t01_triage, t02_outlier_bound, t03_reason_shares, t03_status_shares, t04_item_rates,
    t05_role_views, t06_datasets,
):
    _CASES[_query.__name__] = _query


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(query: Callable[[Case], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: query(Case(spark, sf_dir))

    return {name: bind(query) for name, query in sorted(_CASES.items())}
