import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from larder import defaults
from larder.operators import classify, finance, forecast, profile, quality, quantiles, stock
from larder.operators.lookups import flag_missing
from larder.operators.ordered import flag_repeats, keep_first, lag_in_order
from larder.plans.report import Sources, build_report

SALES = (
    "Transaction_ID string, DateTime string, Employee_ID string, Menu_ID string, Item_Name string, "
    "Quantity string, Additional_Info string, _ord bigint"
)


def _sales(spark, rows):
    return spark.createDataFrame(
        [(r[0], r[1], "EMP-01", r[2], "x", r[3], r[4], i) for i, r in enumerate(rows)], SALES
    )


GOOD = ("2025-01-01 10:00:00", "M1", "2", None)
TAGGED = [
    (("a", *GOOD), None),
    (("a", *GOOD), defaults.DUPLICATE),
    (("b", GOOD[0], "M1", "-1", "ERROR"), defaults.ERROR_FLAG),
    (("b", *GOOD), defaults.DUPLICATE),  # of a row that is itself rejected
    ((None, *GOOD), None),
    ((None, *GOOD), defaults.DUPLICATE),
    ((" a", *GOOD), None),  # ids are not trimmed
    (("c", None, "M1", "x", None), defaults.NULL_FIELD),
    (("d", "soon", "M1", "-1", None), defaults.BAD_DATE),
    (("e", GOOD[0], "M1", "-1", None), defaults.NEGATIVE),
    (("f", GOOD[0], "M1", "???", None), defaults.BAD_QUANTITY),
    (("g", GOOD[0], "M1", "nol", None), defaults.ZERO),
    (("h", "  ", "M1", "1", None), defaults.BAD_DATE),
]


def test_one_reason_per_row_in_order(spark):
    tagged = quality.tag_sales(_sales(spark, [r for r, _ in TAGGED]))
    got = {r["_ord"]: r for r in tagged.collect()}
    assert [got[i][quality.REASON] for i in range(len(TAGGED))] == [reason for _, reason in TAGGED]
    for row in got.values():
        reached = row[quality.REASON] in (None, *quality.QUANTITY_REASONS)
        assert (row["DateTime_Parsed"] is not None) == reached
        assert (row["Date"] is not None) == reached


def test_valid_sales_are_the_clean_part_whatever_the_row_order(spark):
    sales = _sales(spark, [r for r, _ in TAGGED])
    shuffled = sales.orderBy(F.rand(3)).repartition(3)
    want = sorted(r["_ord"] for r in quality.clean_part(quality.tag_sales(sales)).collect())
    assert sorted(r["_ord"] for r in quality.valid_sales(shuffled).collect()) == want == [0, 4, 6]


def test_metrics_conserve_rows(spark):
    tagged = quality.tag_sales(_sales(spark, [r for r, _ in TAGGED]))
    menus = spark.createDataFrame([("M2",)], "Menu_ID string")
    employees = spark.createDataFrame([("EMP-02",)], "Employee_ID string")
    row = quality.cleansing_metrics(tagged, menus, employees).first()
    assert row["raw_rows"] == len(TAGGED) == row["valid_rows"] + row["quarantined_rows"]
    assert row["quarantined_rows"] == sum(row[r.lower()] for r in quality.REASONS)
    assert row["unknown_menu_rows"] == row["unknown_employee_rows"] == 3
    none = spark.createDataFrame([], "Employee_ID string")
    assert quality.cleansing_metrics(tagged, menus, none).first()["unknown_employee_rows"] == 0


def test_row_rules_take_a_stream(spark, tmp_path):
    _sales(spark, [r for r, _ in TAGGED]).write.parquet(str(tmp_path / "s"))
    stream = spark.readStream.schema(SALES).parquet(str(tmp_path / "s"))
    assert quality.tag_rows(stream).isStreaming


def test_repeats_of_a_hot_key(spark):
    keys = [None] * 400 + ["hot"] * 300 + [f"k{i % 50}" for i in range(200)]
    random.Random(1).shuffle(keys)
    df = spark.createDataFrame(list(enumerate(keys)), "_ord bigint, k string")
    seen, want = set(), {}
    for i, key in enumerate(keys):
        want[i] = key in seen
        seen.add(key)
    assert {r["_ord"]: r["is_duplicate"] for r in flag_repeats(df, "k").collect()} == want
    assert {r["_ord"] for r in keep_first(df, "k").collect()} == {i for i, d in want.items() if not d}


@pytest.mark.parametrize("bits", [0, 1, 3, 16])
def test_lag_over_runs_equals_plain_lag(spark, bits):
    rng = random.Random(bits)
    rows = [(i, rng.choice("aaab"), rng.randrange(6), rng.choice([None, 1.0, 2.0, 3.0])) for i in range(300)]
    df = spark.createDataFrame(rows, "i bigint, k string, day int, v double")
    chunks = [[F.col("day"), F.shiftright(F.col("i"), bits)], [F.shiftright(F.col("day"), 1)]]
    got = lag_in_order(df, ["k"], [F.col("day"), F.col("i")], chunks, "v", "p")
    last, want = {}, {}
    for i, k, day, v in sorted(rows, key=lambda r: (r[2], r[0])):
        want[i] = last.get(k)
        last[k] = v
    assert {r["i"]: r["p"] for r in got.collect()} == want


def test_lookup_without_hint(spark):
    facts = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i % 7}", {"a": i}) for i in range(200)], "i int, k string, m map<string,int>")
    known = spark.createDataFrame([("hot",), ("k1",), ("zz",)], "id string")
    got = flag_missing(facts, "k", known, "f")
    assert "BroadcastHint" not in got._jdf.queryExecution().logical().toString()
    assert {(r["k"], r["f"]) for r in got.collect()} >= {("hot", False), ("k1", False), ("k2", True)} and got.count() == 200


@pytest.mark.parametrize("days, each", [(1500, 1), (40, 60)])
def test_lag_keeps_groups_small(spark, days, each):
    start = dt.date(2020, 1, 1)
    rows = [("A", start + dt.timedelta(i // each), i, 0, float(i)) for i in range(days * each)]
    df = spark.createDataFrame(rows, "Item_ID string, Date date, _ord bigint, _pos int, stock_remaining double")
    order = [F.col("Date"), F.col("_ord")]
    chunks = [[F.col("Date"), F.shiftright(F.col("_ord"), 5)], [F.trunc("Date", "month")]]
    got = {r["_ord"]: r["p"] for r in lag_in_order(df, ["Item_ID"], order, chunks, "stock_remaining", "p").collect()}
    assert got == {i: float(i - 1) if i else None for i in range(days * each)}
    # runs, edges of runs in a month, edges of months: none is near the whole item
    fine = df.groupBy(*chunks[0]).count()
    month = df.select(*[c.alias(f"f{i}") for i, c in enumerate(chunks[0])], F.trunc("Date", "month").alias("m")).distinct().groupBy("m").count()
    widest = max(fine.agg(F.max("count")).first()[0], 2 * month.agg(F.max("count")).first()[0], 2 * month.count())
    assert widest <= 6 * (days * each) ** 0.5


def test_lag_moves_whole_rows_once(spark, tmp_path):
    rows = [(f"k{i % 5}", i, float(i), "x" * 50) for i in range(2000)]
    spark.createDataFrame(rows, "k string, i bigint, v double, wide string").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    got = lag_in_order(df, ["k"], [F.col("i")], [[F.shiftright("i", 4)], [F.shiftright("i", 8)]], "v", "p")
    assert got.count() == 2000 and got.filter("p is not null and p <> v - 5").count() == 0
    got.collect()
    plan = got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("FileScan") == 1 and plan.count("ReusedExchange") >= 1
    assert plan.count("Exchange hashpartitioning(_run_2") == 1 + plan.count("BuildRight")


def test_null_keys_have_a_previous_row(spark):
    df = spark.createDataFrame([(None, i, float(i)) for i in range(40)] + [("a", i, -float(i)) for i in range(40)], "k string, i bigint, v double")
    got = lag_in_order(df, ["k"], [F.col("i")], [[F.shiftright("i", 2)], [F.shiftright("i", 4)]], "v", "p").collect()
    assert {(r["k"], r["i"]): r["p"] for r in got} == {
        (k, i): (None if i == 0 else sign * float(i - 1)) for k, sign in ((None, 1), ("a", -1)) for i in range(40)}


def _records(spark, records):
    schema = "record_id string, date string, recorded_by string, stock_entries array<map<string,string>>, _ord bigint"
    return spark.createDataFrame([(f"r{i}", d, "e", e, i) for i, (d, e) in enumerate(records)], schema)


def test_flatten_rules(spark):
    base = {"Item_ID": " A ", "delivery_in": "1", "UoM": " Gram "}
    entries = [
        {**base, "stock_remaining": "5"},
        {**base, "sisa_stok_akhir": "6"},
        {**base, "stock_remaining": "7", "sisa_stok_akhir": "8"},
        {**base, "stock_remaining": None, "sisa_stok_akhir": "9"},  # key is there: dropped
        {**base, "stock_remaining": "ERROR"},
        {"Item_ID": None, "stock_remaining": "1"},
        {"Item_ID": "", "stock_remaining": "-4"},  # no delivery, no unit
        {"Item_ID": "B", "stock_remaining": "2", "delivery_in": None, "UoM": None},
        {"Item_ID": "C", "stock_remaining": "2", "delivery_in": "late"},
        {"Item_ID": "D", "stock_remaining": "nan", "delivery_in": "3"},
    ]
    records = _records(spark, [("2025-01-01", entries), ("unknown", entries), (None, entries), ("2025-01-02", None)])
    got = stock.cleanse_stock(records).orderBy("_ord", "_pos").collect()
    day = dt.date(2025, 1, 1)
    assert [(r["Date"], r["Item_ID"], r["stock_remaining"], r["delivery_in"], r["UoM"]) for r in got] == [
        (day, "A", 5.0, 1.0, "gram"), (day, "A", 6.0, 1.0, "gram"), (day, "A", 7.0, 1.0, "gram"),
        (day, "", 0.0, 0.0, ""), (day, "B", 2.0, 0.0, "none"), (day, "D", None, 3.0, ""),
    ]


def test_reconciliation_golden(spark):
    days = [(1, 5000, 100), (2, 4900, 100), (4, 3000, 100), (5, 100, 2900), (6, 1600, 0)]
    records = _records(
        spark, [(f"2025-01-0{d}", [{"Item_ID": "A", "stock_remaining": str(s)}]) for d, s, _ in reversed(days)]
    )
    used = spark.createDataFrame([(dt.date(2025, 1, d), "A", float(u)) for d, _, u in days if u],
                                 "Date date, Item_ID string, POS_Consumed double")
    levels = spark.createDataFrame([("A", 200.0)], "Item_ID string, Min_Threshold double")
    none = spark.createDataFrame([("Z",)], "Item_ID string")
    out = classify.classify(stock.reconcile(stock.cleanse_stock(records), used), levels, none)
    got = [(r["Expected_Stock"], r["Variance"], r["Action_Status"], r["Variance_Direction"])
           for r in out.orderBy("Date").collect()]
    assert got == [
        (None, None, "Safe", "N/A"), (4900.0, 0.0, "Safe", "N/A"), (4800.0, -1800.0, "Anomaly", "Shrinkage"),
        (100.0, 0.0, "Restock", "N/A"), (100.0, 1500.0, "Anomaly", "POS_Overcount"),
    ]


def test_trailing_mean_equals_brute_force(spark):
    rng = random.Random(5)
    start = dt.date(2025, 1, 1)
    used = {(start + dt.timedelta(rng.randrange(40)), rng.choice("ab")): float(rng.randrange(9)) for _ in range(30)}
    df = spark.createDataFrame([(d, i, v) for (d, i), v in used.items()], "Date date, Item_ID string, POS_Consumed double")
    keys = [(start + dt.timedelta(n), i) for n in range(-3, 45) for i in "abc"] + [(start, "a")] * 2
    at = spark.createDataFrame(keys, "Date date, Item_ID string")
    first, last = min(d for d, _ in used), max(d for d, _ in used)
    rows = forecast.trailing_mean(df, at).collect()
    assert len(rows) == len(keys)
    for row in rows:
        day, item = row["Date"], row["Item_ID"]
        if item == "c" or not first <= day <= last:
            assert row[forecast.MEAN] is None
            continue
        span = [day - dt.timedelta(n) for n in range(7) if day - dt.timedelta(n) >= first]
        assert row[forecast.MEAN] == pytest.approx(sum(used.get((d, item), 0.0) for d in span) / len(span))


def test_stockout_and_loss_edges(spark):
    rows = [(10.0, 4.0, 2.0), (4.0, 4.0, 2.0), (10.0, 4.0, 0.0), (None, 4.0, 2.0), (10.0, 4.0, None), (20.0, 4.0, 0.5)]
    df = spark.createDataFrame(rows, f"Physical_Stock double, Min_Threshold double, {forecast.MEAN} double")
    got = [(r["Days_to_Stockout"], r["Restock_Urgency"]) for r in forecast.add_stockout(df).collect()]
    assert got == [(3.0, "URGENT"), (0.0, "CRITICAL"), (None, "N/A"), (None, "N/A"), (None, "N/A"), (32.0, "SUFFICIENT")]
    loss = spark.createDataFrame([("A", "Shrinkage", -2.5), ("A", "POS_Overcount", 9.0), ("Q", "Shrinkage", -5.0)],
                                 "Item_ID string, Variance_Direction string, Variance double")
    costs = spark.createDataFrame([("A", 1.0)], "Item_ID string, Unit_Cost double")
    priced = finance.add_loss(loss, costs)
    assert {(r["Item_ID"], r["Variance"]): r[finance.LOSS] for r in priced.collect()} == {
        ("A", -2.5): 2.0, ("A", 9.0): None, ("Q", -5.0): None}
    assert tuple(finance.loss_summary(priced).first()) == (2.0, 1)


@pytest.mark.parametrize("accuracy, few", [(20, 3), (20, 10_000), (100_000, 3), (100_000, 10_000)])
def test_quantiles_are_exact(spark, accuracy, few):
    rng = random.Random(2)
    columns = [
        [rng.choice([1.0, 2.0, rng.uniform(-50, 50)]) for _ in range(501)],
        [0.0] * 300 + [1.0] * 200 + [i / 1000 for i in range(1, 30)],  # nearly all at the ends
        [7.0],
    ]
    probabilities = (0.0, 0.25, 0.5, 0.6, 0.75, 1.0)
    for values in columns:
        df = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "x double")
        got = quantiles.exact_quantiles(df, "x", probabilities, accuracy, few)
        assert got == pytest.approx([np.quantile(values, p) for p in probabilities], abs=1e-12)
    none = spark.createDataFrame([(None,)], "x double")
    assert tuple(quantiles.outlier_bound(none, "x").first()) == (None,) * 4


def test_report_plan_stays_in_the_jvm(spark):
    sales = _sales(spark, [r for r, _ in TAGGED])
    menus = spark.createDataFrame([("M1", "m", "1", [{"Item_ID": "INV-0001", "qty_used": "2"}], 0)],
                                  "Menu_ID string, Menu_Name string, Selling_Price_IDR string, "
                                  "ingredients array<map<string,string>>, _ord bigint")
    inventory = spark.createDataFrame([("INV-0001", "x", "Pcs", 5.0, "c", 0)],
                                      "Item_ID string, Item_Name string, Supplier_UoM string, "
                                      "Min_Stock_Threshold double, Category string, _ord bigint")
    records = _records(spark, [("2025-01-01", [{"Item_ID": "INV-0001", "stock_remaining": "50"}])])
    employees = spark.createDataFrame([], "Employee_ID string")
    report = build_report(quality.valid_sales(sales), Sources(sales, records, inventory, menus, employees))
    plan = report._jdf.queryExecution().executedPlan().toString()
    for banned in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert banned not in plan
    row = report.first()
    assert (row["POS_Consumed"], row["Action_Status"], row["Min_Threshold"]) == (12.0, "Safe", 5.0)


def test_audit_of_hot_empty_and_no_ids(spark):
    rows = [(None, *GOOD)] * 5 + [("  ", *GOOD)] * 2 + [("a", None, None, "", None)] * 3 + [(" a ", "soon", "M1", "-1", None), ("b", *GOOD)]
    sales = _sales(spark, rows)
    got = {(r.profile, r.part): r.rows for r in profile.sales_audit(sales).collect()}
    ids = profile.key_profile(sales).first().asDict()
    assert {part: n for (name, part), n in got.items() if name == "ids"} == ids
    assert ids == {"rows": 12, "empty": 7, "distinct_ids": 2, "repeated": 3}
    assert {part: n for (name, part), n in got.items() if name == "quantity"} == profile.quantity_profile(sales).first().asDict()
    assert {part: n for (name, part), n in got.items() if name == "emptiness"} == profile.emptiness_profile(sales).first().asDict()
    formats = {r.format: r.rows for r in profile.date_formats(sales).collect()}
    assert {part: n for (name, part), n in got.items() if name == "dates" and n} == formats
    assert {r.rows for r in profile.sales_audit(sales.where("false")).collect()} == {0}
