import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from larder import defaults
from larder.functions.dates import date_class, with_timestamp
from larder.functions.numbers import parse_float, prepare, round_tenths, with_quantity
from larder.functions.text import is_error_flag, null_if_token, strip_ws

QUANTITIES = {
    "5": 5.0, " 2 ": 2.0, "2,5": 2.5, "3 pcs": 3.0, "eight": 8.0, "tiga": 3.0, "-7": None,
    "-5 pcs": 5.0, "1e3": 1000.0, ".5": 0.5, "5d": 5.0, "1,234.5": 1.234, "\t3\t": 3.0,
    "-INF": None, "0": 0.0, "nol": 0.0, "0 cups": 0.0, "nil": None, "-": None, "???": None,
    "N/A": None, "   ": None, "INF": None, "1_000": 1000.0, "_1": 1.0, "+4": 4.0, "7.": 7.0,
    "\xa06　": 6.0, "+nan": None, "1e999": None,
}
NEGATIVES = {"-7", "-INF"}

D = dt.datetime
STAMPS = {
    "2025-02-14 05:29:20": D(2025, 2, 14, 5, 29, 20),
    "2025-02-14": D(2025, 2, 14),
    "27/03/2025 02:33": D(2025, 3, 27, 2, 33),
    "05/03/2025": D(2025, 3, 5),
    "03/26/2025": D(2025, 3, 26),
    "05/03/2025 10:11:12": D(2025, 3, 5, 10, 11, 12),
    "Mar 20 2025": D(2025, 3, 20),
    "march 20 2025 14:05": D(2025, 3, 20, 14, 5),
    "202501170135": D(2025, 1, 17, 1, 35),
    "20250327": D(2025, 3, 27),
    "03-26-2025 05:09 PM": D(2025, 3, 26, 17, 9),
    "03-26-2025 12:09AM": D(2025, 3, 26, 0, 9),
    "03-26-2025 12:09 pm": D(2025, 3, 26, 12, 9),
    "3/4/2025 5:09 PM": D(2025, 3, 4, 17, 9),
    "26/03/2025 05:09 PM": D(2025, 3, 26, 17, 9),
    "03-04-2025": D(2025, 3, 4),
    "26-03-2025 10:10": D(2025, 3, 26, 10, 10),
    "2025/03/04 10:11": D(2025, 3, 4, 10, 11),
    "04-Mar-2025 10:11:12": D(2025, 3, 4, 10, 11, 12),
    "2025-01-01T10:00:00+07:00": D(2025, 1, 1, 10),
    "2025-01-01T10:00:00.250Z": D(2025, 1, 1, 10, 0, 0, 250000),
    "14.3.2025": D(2025, 3, 14),
    "3.4.2025": D(2025, 3, 4),
    " 2025-02-14 05:29:20\t": D(2025, 2, 14, 5, 29, 20),
    "2025-03-04  10:11:12": D(2025, 3, 4, 10, 11, 12),
    "2025-03-04 05:09 PM": D(2025, 3, 4, 17, 9),
    "20 Mar 2025": D(2025, 3, 20),
    "20 March, 2025 10:00": D(2025, 3, 20, 10),
    "Mar 20, 2025": D(2025, 3, 20),
    "March 20, 2025 10:00": D(2025, 3, 20, 10),
    "Sept 20 2025": D(2025, 9, 20),
    "20250327101112": D(2025, 3, 27, 10, 11, 12),
    "20250327T101112": D(2025, 3, 27, 10, 11, 12),
    "2025.03.04": D(2025, 3, 4),
    "04-03-25": D(2025, 4, 3),
    "13-03-25 10:00": D(2025, 3, 13, 10),
    "04.03.25": D(2025, 4, 3),
    "04/03/25": D(2025, 3, 4),
    "04-03-70": D(1970, 4, 3),
}
NO_STAMPS = [
    "2025-02-29 10:00:00", "2025032709", "12:34:56", "5/3", "not-a-date-???", "   ", "2025",
    "3000-01-01", "1500-01-01", "31/04/2025", "Foo 20 2025", "03-26-2025 17:09 PM", "20251301",
    "2025-13-04", "2025.03-04", "Mar 2025", "20250327T1011", "99-99-25", "Mars 20 2025",
]


def _one_column(spark, values):
    return spark.createDataFrame([(v,) for v in values], "t string")


def test_quantity_golden(spark):
    df = with_quantity(_one_column(spark, [*QUANTITIES, None]), "t")
    got = {r["t"]: (r["Quantity_Clean"], r["is_negative"]) for r in df.collect()}
    want = {k: (v, k in NEGATIVES) for k, v in QUANTITIES.items()}
    assert got == {**want, None: (None, False)}


def test_every_number_word(spark):
    df = with_quantity(_one_column(spark, [w for w in defaults.NUMBER_WORDS if w != "nil"]), "t")
    for row in df.collect():
        assert row["Quantity_Clean"] == defaults.NUMBER_WORDS[row["t"]]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_timestamp_golden(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = with_timestamp(_one_column(spark, [*STAMPS, *NO_STAMPS, None]), "t", "stamp")
        got = {r["t"]: r["stamp"] for r in df.collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == {**STAMPS, **dict.fromkeys(NO_STAMPS), None: None}


def test_month_first_when_asked(spark):
    df = with_timestamp(_one_column(spark, ["05/03/2025", "26/03/2025"]), "t", "stamp", day_first=False)
    assert [r["stamp"] for r in df.collect()] == [D(2025, 5, 3), D(2025, 3, 26)]


def test_error_flags(spark):
    flagged = ["ERROR", "Err0r", "EROR", "#REF!", " #VALUE!", "undefined", "INVALID", "inv4lid", "ROER, x"]
    fine = ["SYSERR", "TIMEOUT", "N/A", "#DIV/0!", None, '"ERROR"', "", "  "]
    df = _one_column(spark, flagged + fine).select("t", is_error_flag(F.col("t")).alias("f"))
    assert {r["t"] for r in df.collect() if r["f"]} == set(flagged)


def test_null_tokens_match_whole_text_only(spark):
    df = _one_column(spark, ["nan", "NULL", "", " nan", "N/A", "-"])
    got = [r[0] for r in df.select(null_if_token(F.col("t"))).collect()]
    assert got == [None, None, None, " nan", "N/A", "-"]


def test_strip_agrees_with_python(spark):
    values = [f"{c}x{c}" for c in map(chr, range(0x3100)) if c.isspace()] + ["​x", "x y"]
    df = _one_column(spark, values).select("t", strip_ws(F.col("t")).alias("s"))
    assert all(r["s"] == r["t"].strip() for r in df.collect())


def test_parse_float_agrees_with_python(spark):
    values = ["1", "1.", ".1", "1e5", "1E-5", "+1", "-0", "1_0", "1__0", "_1", "1_", "1_.5", "5f", "0x1p3",
              "inf", "-Infinity", "nan", "", "e5", ".", "1 0", " 1 "]
    df = _one_column(spark, values).withColumn("p", prepare(F.col("t"))).withColumn("n", parse_float(F.col("p")))
    for row in df.collect():
        try:
            want = float(row["t"])
        except ValueError:
            want = None
        got = row["n"]
        assert got == want or (got != got and want != want), row


def test_round_tenths_agrees_with_python(spark):
    rng = random.Random(7)
    values = [n / 20 for n in range(4000)] + [rng.uniform(0, 1e6) for _ in range(4000)] + [2.25, 0.35, 1e15]
    df = spark.createDataFrame([(v,) for v in values], "x double").select("x", round_tenths(F.col("x")).alias("r"))
    assert all(r["r"] == round(r["x"], 1) for r in df.collect())


def test_whatever_the_audit_calls_iso_is_read(spark):
    texts = [f"2025-0{m}-1{d}{blank}0{d}:1{m}:2{m}" for m in range(1, 5) for d in range(1, 5) for blank in (" ", "  ", "\t", " \t ")]
    df = with_timestamp(_one_column(spark, texts), "t", "stamp").withColumn("class", date_class(F.trim("t")))
    assert {(r["class"], r["stamp"] is None) for r in df.collect()} == {("ISO YYYY-MM-DD HH:MM:SS", False)}


@pytest.mark.parametrize("text, name", [
    ("", "EMPTY"), ("2025-01-02   03:04:05 and more", "ISO YYYY-MM-DD HH:MM:SS"), ("2025-01-02T03:04:05", "OTHER"),
    ("01/02/2025", "DD/MM/YYYY"), ("1/02/2025", "OTHER"), ("Mar 5  2025", "Month DD YYYY"), ("mar 5 2025", "OTHER"),
    ("MAR 05 2025", "OTHER"), ("Mar 123 2025", "OTHER"), ("2025010203049", "Compact 12-digit"), ("20250102030", "OTHER"),
    ("01-02-2025 03:04  PM", "MM-DD-YYYY AM/PM"), ("01-02-2025 03:04 pm", "OTHER"), ("01-02-2025 03:04 XM", "OTHER"),
])
def test_date_classes(spark, text, name):
    assert _one_column(spark, [text]).select(date_class(F.col("t"))).first()[0] == name


def test_year_month_name_day(spark):
    rows = [("2077-March-11", "2077-03-11"), (" 1925-Jan-29", "1925-01-29"), ("2001-Foo-01", None), ("12-3-4", None), ("05-05-05 10:00", "2005-05-05")]
    got = with_timestamp(spark.createDataFrame(rows, "DateTime string, want string")).collect()
    assert [str(r["DateTime_Parsed"].date()) if r["DateTime_Parsed"] else None for r in got] == [want for _, want in rows]
