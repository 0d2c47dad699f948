"""Files cut anywhere give the rows of files read whole."""

import json
import random

import pytest

from larder.sources import readers, splitting
from larder.sources.readers import MENU, STOCK_RECORD, read_source, read_text_csv


@pytest.fixture
def small_parts(spark):
    """Files are cut every thousand bytes."""
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def plain(df):
    return [tuple(r)[:-1] for r in sorted(df.collect(), key=lambda r: tuple(r["_ord"]))]


FIELDS = ["plain", "", '""', '"two\nlines"', '"a ""quoted"" word"', '"x, y"', '"\n\n"', " padded ", 'it""s', '"long ' + "text\n" * 120 + '"', "é☕"]


def csv_text(rng, rows, end):
    lines = ["id,one,two,three"]
    for i in range(rows):
        lines.append(",".join([str(i)] + [rng.choice(FIELDS) for _ in range(rng.choice([3, 3, 3, 2]))]))
        if rng.random() < .05:
            lines.append("")
    return end.join(x.replace("\n", end) for x in lines) + rng.choice(["", end])


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("seed", range(2))
def test_csv_equals_whole_files(spark, small_parts, tmp_path, seed, end):
    rng = random.Random(seed)
    for name in ("a", "b"):
        (tmp_path / f"{name}.csv").write_bytes(csv_text(rng, 150, end).encode())
    columns = ["three", "id", "one", "two"]
    whole = read_text_csv(spark, str(tmp_path), columns)
    cut = read_text_csv(spark, str(tmp_path), columns, split=True)
    assert whole.rdd.getNumPartitions() <= 2 and splitting._parts(spark, str(tmp_path), "\n").rdd.getNumPartitions() > 10
    assert plain(cut) == plain(whole) and cut.schema["_ord"].dataType.simpleString() == whole.schema["_ord"].dataType.simpleString()
    assert cut.count() == 300


def test_quotes_and_lines():
    inside = splitting.ends_in_quotes
    assert [inside(x, False) for x in ('a,"b', 'a,"b""', 'a,"b"', '5" x', '"a" "b,c', 'a,""', '"a","b', "")] == [
        True, True, False, False, False, False, True, False]
    assert [inside(x, True) for x in ("", 'b",c', 'b""', 'b"",c', 'b","c', '"')] == [True, False, True, True, True, False]


@pytest.mark.parametrize("text, message", [
    ('id,v\n1,"open\n' + "2,x\n" * 300, "open quote"), ("id,v\n" + "1,x\n" * 200 + "1,x,surplus\n", "broken line")])
def test_broken_csv_fails(spark, small_parts, tmp_path, text, message):
    (tmp_path / "a.csv").write_text(text)
    with pytest.raises(Exception, match=message):
        read_text_csv(spark, str(tmp_path), ["id", "v"], split=True).collect()


def test_other_header_fails(spark, small_parts, tmp_path):
    (tmp_path / "a.csv").write_text("id,v\n1,x\n")
    (tmp_path / "b.csv").write_text("v,id\n1,x\n")
    with pytest.raises(Exception, match="another header"):
        read_text_csv(spark, str(tmp_path), ["id", "v"], split=True).collect()


def test_a_quote_inside_a_field_opens_nothing(spark, small_parts, tmp_path):
    (tmp_path / "a.csv").write_text("id,v\n" + "5\" pipe,x\n" * 101)
    assert plain(read_text_csv(spark, str(tmp_path), ["id", "v"], split=True)) == [("5\" pipe", "x")] * 101


def test_header_alone_and_byte_order_mark(spark, tmp_path):
    (tmp_path / "a.csv").write_text("﻿id,v\n")
    (tmp_path / "b.csv").write_text("id,v\r\n7,\r\n")
    assert plain(read_text_csv(spark, str(tmp_path), ["id", "v"], split=True)) == [("7", None)]


TEXTS = ["x", "", "a}b", 'q"uote', "back\\", '\\"}{[', "é☕", "[{", "long " * 150, None, "1"]


def record(rng, i):
    entries = [{rng.choice(["Item_ID", "stock_remaining", "UoM", "a}b"]): rng.choice(TEXTS) for _ in range(rng.randint(0, 3))} for _ in range(rng.randint(0, 4))]
    return rng.choice([{"record_id": f"r{i}", "date": rng.choice(TEXTS), "recorded_by": "e}", "stock_entries": entries},
                       {"record_id": f"r{i}"}, {"stock_entries": None, "other": {"deep": [[1], {"x": "}"}]}}, {}, None])


@pytest.mark.parametrize("seed", range(3))
def test_json_equals_whole_files(spark, small_parts, tmp_path, seed):
    rng = random.Random(seed)
    for name in ("a", "b"):
        doc = {"meta": {"records": [{"record_id": "not this"}], "x": "}"}, "n": 5, "records": [record(rng, i) for i in range(rng.choice([0, 1, 120]))],
               "after": [{"record_id": "nor this"}, "}"], "z": "records"}
        if rng.random() < .5:
            doc = {"records": doc["records"]}
        text = json.dumps(doc, indent=rng.choice([None, 1]), ensure_ascii=rng.random() < .5) + rng.choice(["", "\n", " \r\n"])
        (tmp_path / f"{name}.json").write_text(text)
    whole = read_source(spark, str(tmp_path), "records", STOCK_RECORD)
    cut = read_source(spark, str(tmp_path), "records", STOCK_RECORD, split=True)
    assert plain(cut) == plain(whole) and cut.schema["_ord"].dataType.simpleString() == whole.schema["_ord"].dataType.simpleString()


def test_one_document_takes_many_tasks(spark, small_parts, tmp_path):
    menus = [{"Menu_ID": f"M{i}", "ingredients": [{"Item_ID": str(j)} for j in range(5)]} for i in range(400)]
    (tmp_path / "menus.json").write_text(json.dumps({"menu_items": menus}))
    assert splitting._parts(spark, str(tmp_path), "}").rdd.getNumPartitions() > 20
    got = read_source(spark, str(tmp_path), "menu_items", MENU, split=True).collect()
    assert [(r["Menu_ID"], len(r["ingredients"])) for r in sorted(got, key=lambda r: r["_ord"])] == [(f"M{i}", 5) for i in range(400)]


@pytest.mark.parametrize("text", [
    '{"records": [{"record_id": "1"}]', '{"records": [{"record_id": "1"}', '{"records": [{"record_id": "1"}]}}', '{"records": [{"record_id": }]}',
    '{"records": [{"record_id": "1"} {"record_id": "2"}]}', '{"records": [{"record_id": "1"},]}', '{"records": [5]}', '{"records": {"a": 1}}',
    '{"records": "text"}', '{"records": [{"record_id": "1]}', '[{"records": []}]', '{"records": [{"record_id": "1"}, 7, {}]}'])
def test_broken_documents_fail(spark, tmp_path, text):
    (tmp_path / "a.json").write_text(text)
    with pytest.raises(Exception, match="broken document|whole document|[Mm]alformed"):
        read_source(spark, str(tmp_path), "records", STOCK_RECORD, split=True).collect()


def test_flows_read_files_in_parts(spark, small_parts, tmp_path):
    (tmp_path / "s.csv").write_text(",".join(readers.SALES_COLUMNS) + "\n" + '"T\n1",2025-01-01,E,M,x,1,\n' * 200)
    assert readers.read_sales(spark, str(tmp_path / "s.csv")).filter("Transaction_ID = 'T\n1'").count() == 200
