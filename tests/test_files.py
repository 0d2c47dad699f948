import csv
import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from larder.operators import dims
from larder.plans import report as flows
from larder.sources import readers, sinks

HEADER = list(readers.SALES_COLUMNS)
SALES = [
    ["T1", "2025-01-01 08:00:00", "EMP-01", "M1", "Latte", "2", ""],
    ["T1", "2025-01-01 08:00:00", "EMP-01", "M1", "Latte", "2", ""],
    ["T2", "02/01/2025 09:00", "EMP-77", "M1 ", 'Latte, "large"', "dua", "NULL"],
    ["T3", "2025-01-02 09:00:00", "EMP-01", "GHOST", "two\nlines", "1", ""],
    ["T4", "2025-01-02 09:00:00", "EMP-01", "M1", "x", "-3", ""],
    ["T5", "2025-01-02 09:00:00", "EMP-01", "M1", "x", "1", "ERROR"],
    ["", "2025-01-05 09:00:00", "EMP-01", "M1", "x", "1", ""],
]
INVENTORY = [
    ["INV-0001 ", " Beans ", "Kilogram", "8", "a"], ["INV-0034", "Napkin", "Karton", "2", "b"],
    ["", "Nameless", "Pcs", "5", "b"], ["INV-0002", "Robusta", "Box", "bad", "a"],
    ["INV-0001", "Beans", "Kilogram", "99", "a"], ["INV-0003", "Decaf", "Pcs", "", "a"],
]
MENUS = {"menu_items": [
    {"Menu_ID": "M1", "Menu_Name": "Latte", "Selling_Price_IDR": "Rp 18rb", "ingredients": [
        {"Item_ID": "INV-0001", "Item_Name": "Beans", "qty_used": 18, "UoM": "Gram"},
        {"Item_ID": "INV-0034", "qty_used": "1"}, {"Item_ID": "INV-0034", "qty_used": "1", "UoM": None},
        {"Item_ID": "INV-0001", "qty_used": "much"}, {"Item_ID": None, "qty_used": 1},
        {"Item_ID": "INV-0009", "qty_used": "infinity"}]},
    {"Menu_ID": "EMPTY", "ingredients": []}, {"Menu_ID": "", "ingredients": [{"Item_ID": "A", "qty_used": 1}]},
]}
STOCK = {"records": [
    {"record_id": "W1", "date": "2025-01-01", "recorded_by": "e", "stock_entries": [
        {"Item_ID": "INV-0001", "stock_remaining": 100000, "delivery_in": 0, "UoM": "gram", "notes": "n"},
        {"Item_ID": "INV-0034", "stock_remaining": -5}]},
    {"record_id": "W2", "date": "2025-01-02", "stock_entries": [
        {"Item_ID": "INV-0001", "sisa_stok_akhir": "98000", "delivery_in": None},
        {"Item_ID": "INV-0034", "sisa_stok_akhir": 4}]},
    {"record_id": "only an id"},
]}


@pytest.fixture()
def folder(tmp_path):
    for name, header, rows in (("sales.csv", HEADER, SALES), ("items.csv", readers.INVENTORY_COLUMNS, INVENTORY)):
        with open(tmp_path / name, "w", newline="", encoding="utf-8") as f:
            csv.writer(f).writerows([header, *rows])
    (tmp_path / "menus.json").write_text(json.dumps(MENUS, indent=1))
    (tmp_path / "stock.json").write_text(json.dumps(STOCK, indent=1))
    return tmp_path


def _load(spark, folder):
    names = ("sales.csv", "stock.json", "items.csv", "menus.json", "staff.json")
    return flows.load(spark, *[str(folder / n) for n in names])


def _csv(path, *lines):
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


@pytest.mark.parametrize("multi_line", [True, False])
def test_columns_are_found_by_name(spark, tmp_path, multi_line):
    path = _csv(tmp_path / "a.csv", "b,extra,a", "1,x,2", '3,"y, z",4', "5", "6,,")
    rows = readers.read_text_csv(spark, path, ["a", "b"], multi_line).orderBy("_ord").collect()
    assert [(r["a"], r["b"]) for r in rows] == [("2", "1"), ("4", "3"), (None, "5"), (None, "6")]
    with pytest.raises(ValueError, match="no column c"):
        readers.read_text_csv(spark, path, ["a", "c"], multi_line)


@pytest.mark.parametrize("multi_line", [True, False])
def test_surplus_fields_fail_whatever_is_read(spark, tmp_path, multi_line):
    path = _csv(tmp_path / "a.csv", "a,b", "1,2", "1,2,3")
    rows = readers.read_text_csv(spark, path, ["a", "b"], multi_line)
    for df in (rows, rows.select("a"), rows.groupBy().count()):
        with pytest.raises(Exception, match="broken line"):
            df.collect()


def test_open_quotes_fail_line_by_line(spark, tmp_path):
    path = _csv(tmp_path / "a.csv", "a,b", '"two', 'lines",2')
    with pytest.raises(Exception, match="broken line"):
        readers.read_text_csv(spark, path, ["a", "b"], False).collect()


def test_files_of_other_headers_fail(spark, tmp_path):
    _csv(tmp_path / "1.csv", "a,b", "1,2")
    _csv(tmp_path / "2.csv", "b,a", "2,1")
    with pytest.raises(Exception, match="(?i)header"):
        readers.read_text_csv(spark, str(tmp_path), ["a", "b"]).collect()


def test_big_files_are_split(spark, tmp_path):
    path = _csv(tmp_path / "a.csv", "a,b", *(f"{i},{'x' * 100}" for i in range(20_000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300k")
    try:
        rows = readers.read_text_csv(spark, path, ["a", "b"], False)
        assert rows.count() == 20_000 and rows.select(F.spark_partition_id()).distinct().count() >= 5
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_thresholds_take_no_underscores(spark, tmp_path):
    path = _csv(tmp_path / "i.csv", "Category,Item_ID,Item_Name,Supplier_UoM,Min_Stock_Threshold", "c,A,x,Pcs,1_000", "c,B,x,Pcs,1000")
    rows = {r["Item_ID"]: r["Min_Stock_Threshold"] for r in readers.read_inventory(spark, path).collect()}
    assert rows == {"A": 0.0, "B": 1000.0}


def test_sales_keep_file_order_and_odd_text(spark, folder):
    rows = readers.read_sales(spark, str(folder / "sales.csv")).orderBy("_ord").collect()
    assert [r["Transaction_ID"] for r in rows] == ["T1", "T1", "T2", "T3", "T4", "T5", None]
    assert rows[2]["Item_Name"] == 'Latte, "large"' and rows[3]["Item_Name"] == "two\nlines"
    assert rows[2]["Additional_Info"] is None and rows[2]["Menu_ID"] == "M1 "


def test_dimensions(spark, folder):
    src = _load(spark, folder)
    levels = dims.thresholds(src.inventory, dims.carton_units(spark))
    assert {r["Item_ID"]: r["Min_Threshold"] for r in levels.collect()} == {
        "INV-0001": 99000.0, "INV-0034": 400.0, "INV-0002": 20000.0, "INV-0003": 0.0}
    bom = dims.flatten_menus(src.menus)
    assert sorted((r["Item_ID"], r["qty_used"], r["BOM_UoM"]) for r in bom.collect()) == [
        ("INV-0001", 18.0, "gram"), ("INV-0034", 1.0, ""), ("INV-0034", 1.0, "none")]
    assert [r["Menu_ID"] for r in dims.known_menus(bom).collect()] == ["M1"]


def test_missing_sources(spark, folder):
    assert _load(spark, folder).employees.columns == ["Employee_ID", "Full_Name", "Role", "Shift", "_ord"]
    assert readers.read_employees(spark, str(folder / "none")).isEmpty()
    with pytest.raises(AnalysisException):
        readers.read_menus(spark, str(folder / "none"))
    (folder / "broken.json").write_text("{ not json")
    assert readers.read_employees(spark, str(folder / "broken.json")).isEmpty()
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.read_menus(spark, str(folder / "broken.json")).collect()


def test_run_writes_both_files(spark, folder):
    out = str(folder / "out")
    (folder / "scratch").mkdir()
    counts = flows.run(_load(spark, folder), out, str(folder / "scratch"))
    assert list((folder / "scratch").iterdir()) == []
    got = {(r["Action_Status"], r["Variance_Direction"]): r["rows"] for r in counts.collect()}
    # Day 2: 98000 - (100000 - 36) = -1964 for beans; 4 - (0 - 4) = 8 for napkins.
    assert got == {("Anomaly", "Shrinkage"): 1, ("Anomaly", None): 1, ("Restock", "N/A"): 2, ("Restock", None): 2,
                   ("Safe", "N/A"): 1, ("Safe", None): 1, ("Invalid Data", "N/A"): 1, ("Invalid Data", None): 1,
                   (None, None): 5}
    report = spark.read.option("header", True).csv(f"{out}/Action_Report")
    assert report.columns == list(flows.classify.REPORT_COLUMNS) and report.count() == 5
    lost = report.filter("Estimated_Loss_IDR is not null").first()
    assert (lost["Item_ID"], float(lost["Estimated_Loss_IDR"])) == ("INV-0001", 1964.0 * 280)
    log = spark.read.option("header", True).option("multiLine", True).csv(f"{out}/quarantine_log")
    assert {r["Quarantine_Reason"]: r["rows"] for r in sinks.count_reasons(log).collect()} == {
        "DUPLICATE_TRANSACTION_ID": 1, "NEGATIVE_QUANTITY": 1, "ERROR_FLAG_IN_ADDINFO": 1}
    assert log.filter("Quarantine_Reason = 'NEGATIVE_QUANTITY'").first()["Date"] == "2025-01-02"


def test_reason_column_is_added_if_absent(spark):
    log = sinks.count_reasons(spark.range(3))
    assert [tuple(r) for r in log.collect()] == [("UNKNOWN", 3)]


def test_a_failed_run_leaves_no_scratch(spark, folder):
    (folder / "scratch").mkdir()
    (folder / "out").mkdir()
    (folder / "out" / "quarantine_log").write_text("in the way")
    with pytest.raises(Exception):
        flows.run(_load(spark, folder), str(folder / "out"), str(folder / "scratch"))
    assert list((folder / "scratch").iterdir()) == []


def _lines(path):
    return [line for part in sorted(path.glob("part-*")) for line in csv.DictReader(part.open(newline=""))]


def test_written_report_is_in_order(spark, tmp_path):
    rows = [(f"2025-01-0{d}", s, i, float(k)) for k, (d, s, i) in enumerate(
        [(2, "Safe", "B"), (1, "Safe", "A"), (2, "Anomaly", "C"), (1, "Restock", "B"), (1, "Invalid Data", "B"),
         (2, "Anomaly", "A"), (1, "Anomaly", "Z"), (2, "Anomaly", "A"), (1, "Safe", "A")])]
    report = spark.createDataFrame(rows, "Date string, Action_Status string, Item_ID string, Physical_Stock double")
    sinks.write_report(report.repartition(4), str(tmp_path / "report"))
    rank = {"Anomaly": 0, "Invalid Data": 1, "Restock": 2, "Safe": 3}
    want = sorted(rows, key=lambda r: (r[0], rank[r[1]], r[2], r[3]))
    assert [(r["Date"], r["Action_Status"], r["Item_ID"], float(r["Physical_Stock"])) for r in _lines(tmp_path / "report")] == want


def test_reasons_are_counted_most_frequent_first(spark):
    log = spark.createDataFrame([(r,) for r in "bbbaacccd"], "Quarantine_Reason string")
    assert [tuple(r) for r in sinks.count_reasons(log.repartition(3)).collect()] == [("b", 3), ("c", 3), ("a", 2), ("d", 1)]


def test_nan_links_are_kept(spark):
    menus = spark.createDataFrame([("M1", "m", "1", [{"Item_ID": "A", "qty_used": q} for q in ("nan", "inf", "2")], 0)],
                                  "Menu_ID string, Menu_Name string, Selling_Price_IDR string, ingredients array<map<string,string>>, _ord bigint")
    links = dims.flatten_menus(menus)
    assert sorted(str(r["qty_used"]) for r in links.collect()) == ["2.0", "nan"] and dims.known_menus(links).count() == 1
