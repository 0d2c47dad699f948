"""Big files that cannot be cut at line ends, read by many tasks.

Spark cuts a text file anywhere and reads whole lines from there, or what ends in any
other mark. What such a part begins in (a quoted field, a string, how deep in a document) depends on
all parts before it. So every part is first summed up on its own: what it ends in, for each
thing it may begin in. The few sums of a file, one row per part, are run through in order, which
tells what each part really begins in. Then every part gives its whole records, and the ends
of records that a cut went through, a few rows, are put together.

Only where records begin and end is found here; Spark's own ``from_csv`` and
``from_json`` read them.
"""

import re
import sys
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.operators.settle import settle

# Executors need no copy of this package for the functions below.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

WHOLE, HEAD, MIDDLE, TAIL, HEADER, BROKEN = range(6)
_RECORDS = "file bigint, block bigint, row bigint, part int, text string"


def _parts(spark: SparkSession, path: str, separator: str) -> DataFrame:
    """Text between separators, in file order within each part of a file (``file``, ``block``)."""
    text = spark.read.option("lineSep", separator).text(path)
    return text.select(
        "value", F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"))


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)


def _over_parts(begin: Callable, names: Sequence[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Reads each part of a file by a reader of its own, a generator that is sent lists of texts and gives lists of rows.

    ``begin(*given)`` makes it from the part's other columns; it is sent None at the end.
    """
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_()}
    schema = pa.schema([(n, kinds[k]) for n, k in (x.strip().split(" ") for x in names)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, reader = None, None
        for batch in batches:
            values = batch.column("value").to_pylist()
            given = [c for n, c in zip(batch.schema.names, batch.columns) if n != "value"]
            file, block = (batch.column(n).to_numpy() for n in ("file", "block"))
            cuts = np.flatnonzero((file[1:] != file[:-1]) | (block[1:] != block[:-1])) + 1
            for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(values)]):
                if start == end:
                    continue
                part, out = tuple(c[start].as_py() for c in given), []
                if part != now:
                    if reader is not None:
                        out = reader.send(None)
                    now, reader = part, begin(*part)
                    next(reader)
                out = out + reader.send(values[start:end])
                if out:
                    yield _batch(out, schema)
        if reader is not None and (out := reader.send(None)):
            yield _batch(out, schema)

    return run


def _join_parts(parts: DataFrame, states: DataFrame, *columns: str) -> DataFrame:
    """Texts with what their part begins in. There is one state per part, so the table is small."""
    known = F.broadcast(states.select("file", "block", *columns))
    return parts.select("value", "file", "block").join(known, ["file", "block"])


def _records(parts: DataFrame, states: DataFrame, begin: Callable, glue: str, *columns: str) -> DataFrame:
    """Whole records of all parts, and those that cuts went through: file, block, row, part, text.

    Parts with an open end are read again for the latter, others are not.
    """
    run = _over_parts(begin, _RECORDS.split(","))
    all_of = _join_parts(parts, states, *columns).mapInArrow(run, _RECORDS)
    whole = all_of.where(F.col("part").isin(WHOLE, HEADER, BROKEN))
    cut = _join_parts(parts, states.where("open"), *columns).mapInArrow(run, _RECORDS)
    in_order = Window.partitionBy("file").orderBy("block", "row")
    cut = cut.where(F.col("part").isin(HEAD, MIDDLE, TAIL)).withColumn("_record", F.sum(F.when(F.col("part") == HEAD, 1).otherwise(0)).over(in_order))
    pieces = F.sort_array(F.collect_list(F.struct("block", "row", "text")))
    mended = cut.groupBy("file", "_record").agg(pieces.alias("pieces")).select(
        "file", F.col("pieces")[0]["block"].alias("block"), F.col("pieces")[0]["row"].alias("row"),
        F.lit(WHOLE).alias("part"), F.array_join("pieces.text", glue).alias("text"))
    paths = F.broadcast(states.groupBy("file").agg(F.any_value("path").alias("path")))
    return whole.unionByName(mended).join(paths, "file")


def _place() -> Column:
    return F.struct(F.col("path").alias("file"), "block", "row").alias("_ord")


def _raise(message: Column) -> Column:
    return F.raise_error(message).cast("boolean")


def _fail(test: Column, message: Column) -> Column:
    return F.when(F.coalesce(test, F.lit(False)), _raise(message)).otherwise(True)


# Quoted CSV.


def ends_in_quotes(line: str, inside: bool) -> bool:
    """Whether a line of a CSV ends inside a quoted field, given whether it begins in one.

    A quote opens a field at its very start only; two in a row inside are one quote; what follows the
    closing one belongs to the field up to the next comma.
    """
    at = 0
    while True:
        if inside:
            at = line.find('"', at)
            while at >= 0 and line.startswith('""', at):
                at = line.find('"', at + 2)
            if at < 0:
                return True
            inside, at = False, at + 1
        elif line.startswith('"', at):
            inside, at = True, at + 1
            continue
        at = line.find(",", at) + 1
        if at == 0:
            return False


def _quote_sums(file: int, block: int) -> Iterator[list[tuple]]:
    ends = {False: False, True: True}
    rows: list[tuple] = []
    while (lines := (yield rows)) is not None:
        for line in lines:
            if '"' in line:
                first = ends_in_quotes(line, ends[False])
                ends = {False: first, True: first if ends[False] == ends[True] else ends_in_quotes(line, ends[True])}
    yield [(file, block, ends[False], ends[True])]


def _csv_reader(file: int, block: int, inside: bool) -> Iterator[list[tuple]]:
    """Records of one part; a break inside quotes reads as a line feed, and empty lines between records go."""
    row, begun, record, header = 0, -1, [], block == 0
    rows: list[tuple] = []
    while (lines := (yield rows)) is not None:
        rows = []
        for line in lines:
            line = line.removesuffix("\r")
            if not inside and not record:
                begun = row
            row += 1
            if '"' in line:
                inside = ends_in_quotes(line, inside)
            if line or inside or record:
                record.append(line)
            if not inside and record:
                part = TAIL if begun < 0 else HEADER if header else WHOLE
                header = header and part == TAIL
                rows.append((file, block, max(begun, 0), part, "\n".join(record)))
                record, begun = [], row
    part = BROKEN if header else HEAD if begun >= 0 else MIDDLE
    yield [(file, block, max(begun, 0), part, "\n".join(record))] if inside else []


def _quote_states(parts: DataFrame) -> DataFrame:
    """Of each part: whether it begins inside quotes, and whether it begins or ends there (``open``)."""
    sums = parts.select("value", "file", "block").mapInArrow(
        _over_parts(_quote_sums, ["file bigint", "block bigint", "from_out boolean", "from_in boolean"]),
        "file bigint, block bigint, from_out boolean, from_in boolean")
    names = parts.groupBy("file", "block").agg(F.any_value("path").alias("path"))
    sums = sums.join(names, ["file", "block"])
    order = Window.partitionBy("file").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    # A part either settles what follows it, whatever it begins in, or keeps or swaps that.
    settles = F.col("from_out") == F.col("from_in")
    swaps = F.sum(F.when(F.col("from_out") & ~F.col("from_in"), 1).otherwise(0)).over(order)
    known = sums.withColumn("_swaps", swaps)
    settled = F.coalesce(F.last(F.when(settles, F.col("from_out")), ignorenulls=True).over(before), F.lit(False))
    since = F.coalesce(F.max("_swaps").over(before), F.lit(0)) - F.coalesce(
        F.last(F.when(settles, F.col("_swaps")), ignorenulls=True).over(before), F.lit(0))
    states = known.select("*", (settled != (since % 2 == 1)).alias("inside"))
    ends = F.when(F.col("inside"), F.col("from_in")).otherwise(F.col("from_out"))
    broken = ends & F.lead("block").over(order).isNull()
    states = states.select("file", "block", "path", "inside", (F.col("inside") | ends).alias("open"), broken.alias("_broken"))
    return states.where(_fail(F.col("_broken"), F.concat("path", F.lit(" ends inside an open quote")))).drop("_broken")


def read_csv_records(spark: SparkSession, path: str, names: Sequence[str], ddl: Callable[[Sequence[str]], str]) -> DataFrame:
    """Rows of CSV files with header, as text columns ``names`` and ``_ord``.

    Line breaks inside quotes belong to their field. A record with more fields than the header, a file
    of another header and a file that ends inside quotes fail the job.
    """
    parts = _parts(spark, path, "\n")
    found = _records(parts, _quote_states(parts), _csv_reader, "\n", "inside")
    options = {"escape": '"', "multiLine": "true"}
    text = F.when(F.col("part") == HEADER, F.ltrim("text", F.lit("﻿"))).otherwise(F.col("text"))
    rows = settle(found.withColumn("_row", F.from_csv(text, F.lit(ddl([*names, "_surplus"])), options)), ["_row"])
    same = F.lit(True)
    for name in names:
        same = same & F.col("_row")[name].eqNullSafe(F.lit(name))
    wrong = (F.col("part") == HEADER) & ~(same & F.col("_row")["_surplus"].isNull())
    surplus = (F.col("part") != HEADER) & F.col("_row")["_surplus"].isNotNull()
    # one test, as Spark would drop headers before it looks at a test of them
    kept = F.when(wrong, _raise(F.concat("path", F.lit(" has another header: "), "text"))).when(
        surplus | (F.col("part") == BROKEN), _raise(F.concat("path", F.lit(" has a broken line: "), "text"))).otherwise(F.col("part") != HEADER)
    return rows.where(kept).select(*[F.col("_row")[n].alias(n) for n in names], _place())


# One JSON document a file.

_KEY = re.compile(rb'"((?:[^"\\]|\\.)*)"\s*:\s*\Z', re.DOTALL)
_STEP = np.zeros(256, dtype=np.int8)
_STEP[[ord("{"), ord("[")]] = 1
_STEP[[ord("}"), ord("]")]] = -1


def _quotes(text: Column) -> Column:
    """Quotes that begin or end a string. A part never begins behind a backslash, as it begins behind a brace."""
    plain = F.replace(F.replace(text, F.lit("\\\\"), F.lit("")), F.lit('\\"'), F.lit(""))
    return F.length(plain) - F.length(F.replace(plain, F.lit('"'), F.lit("")))


class Brackets:
    """The brackets of a JSON text that comes in pieces, strings passed over."""

    def __init__(self, in_string: bool, depth: int = 0):
        self.in_string, self.depth = in_string, depth

    def feed(self, text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each bracket: its place, its step (1 or -1) and the depth behind it."""
        if b"\\" in text:
            text = text.replace(b"\\\\", b"__").replace(b'\\"', b"__")
        codes = np.frombuffer(text, dtype=np.uint8)
        quotes = np.flatnonzero(codes == ord('"'))
        at = np.flatnonzero(_STEP[codes])
        at = at[(np.searchsorted(quotes, at) + self.in_string) % 2 == 0]
        steps = _STEP[codes[at]].astype(np.int64)
        after = self.depth + np.cumsum(steps)
        self.in_string = (len(quotes) + self.in_string) % 2 == 1
        if len(at):
            self.depth = int(after[-1])
        return at, steps, after


def _ended(texts_of: Callable) -> Callable:
    """Gives a reader one text for a list, with the braces that it was cut at; only the last text of an unfinished file has none."""

    def reader(*given) -> Iterator[list[tuple]]:
        inner = texts_of(*given)
        next(inner)
        unfinished = given[3]
        last: list[str] = []
        rows: list[tuple] = []
        while (texts := (yield rows)) is not None:
            whole = "}".join([*last, *texts[:-1], ""])
            rows = inner.send(whole.encode()) if whole else []
            last = texts[-1:]
        rows = inner.send((last[0] + ("" if unfinished else "}")).encode()) if last else []
        yield rows + inner.send(None)

    return reader


def _depth_sums(file: int, block: int, in_string: bool, unfinished: bool) -> Iterator[list[tuple]]:
    """Depth at the end and the least one, from that at the beginning on, and the last keys of brackets there and one above."""
    brackets = Brackets(in_string)
    least, keys, since = 0, {}, b""
    rows: list[tuple] = []
    while (text := (yield rows)) is not None:
        at, steps, after = brackets.feed(text)
        if not len(at):
            since += text
            continue
        lowest = np.minimum(np.minimum.accumulate(after), least)
        least = int(lowest[-1])
        for i in np.flatnonzero((steps > 0) & (after <= lowest + 2)).tolist():
            key = _KEY.search(text[at[i - 1] + 1:at[i]] if i else since + text[:at[0]])
            if key:
                keys[int(after[i]) - 1] = key[1].decode()
        since = text[at[-1] + 1:]
    yield [(file, block, brackets.depth, least, keys.get(least), keys.get(least + 1))]


def _between(text: str, first: bool, closing: bool) -> list[str] | None:
    """Scalars in the text between two elements of an array or before its end; None if it is broken. Only nulls may be there."""
    found = [x.strip() for x in text.split(",")]
    if not first:
        if found.pop(0):
            return None
    if not closing or (first and found == [""]):
        if not found or found.pop():
            return None
    return found if all(x == "null" for x in found) else None


def _json_reader(field: str) -> Callable:
    """Reads the elements of the top-level array ``field``; each is a record, a null one an empty object."""

    def begin(file: int, block: int, in_string: bool, unfinished: bool, depth: int, key: str | None) -> Iterator[list[tuple]]:
        brackets = Brackets(in_string, depth)
        name = re.escape(field.encode())
        other = re.compile(b'"' + name + rb'"\s*:\s*[^\s\[n]')
        target, first = depth > 1 and key == field, False
        inside, begun = target and depth > 2, False
        started = depth > 0 or block > 0
        count, kept = 0, b""
        rows: list[tuple] = []
        while (text := (yield rows)) is not None:
            rows = []
            at, steps, after = brackets.feed(text)
            done = 0
            # what is deeper inside elements, or inside other values, does not matter
            for i in np.flatnonzero(after - (steps > 0) <= 2).tolist():
                place, depth, opens = int(at[i]), int(after[i]), steps[i] > 0
                if inside:
                    rows.append((file, block, count, WHOLE if begun else TAIL, (kept + text[done:place + 1]).decode()))
                    count, kept, inside, done = count + 1, b"", False, place + 1
                    continue
                gap = kept + text[done:place] if not i or at[i - 1] < done else text[at[i - 1] + 1:place]
                kept, done = b"", place + 1
                broken = False
                if depth == 2 and opens:
                    found = _KEY.search(gap)
                    target, first = bool(found) and found[1].decode() == field, True
                    broken = target and text[place] == ord("{")
                elif target and (depth == 3 or depth == 1):
                    nulls = _between(gap.decode(), first, not opens)
                    broken, first = nulls is None, False
                    rows.extend((file, block, count + j, WHOLE, "{}") for j in range(len(nulls or ())))
                    count += len(nulls or ())
                    target = opens
                    if opens:
                        inside, begun, done = True, True, place
                elif depth == 1 and opens:
                    broken, started = started or text[place] == ord("[") or bool(gap.decode().strip("\ufeff \t\r\n")), True
                if depth < 0 or broken or (depth <= 1 and not opens and other.search(gap)):
                    rows.append((file, block, count, BROKEN, text[:200].decode("utf-8", "replace")))
            kept = kept + text[done:] if inside or not len(at) or at[-1] < done else text[at[-1] + 1:]
        yield [(file, block, count, HEAD if begun else MIDDLE, kept.decode())] if inside else []

    return _ended(begin)


def _depth_states(parts: DataFrame, field: str) -> DataFrame:
    """Of each part: string state, depth and top-level key that it begins in, whether its last text lacks its brace."""
    order = Window.partitionBy("file").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    sums = parts.groupBy("file", "block").agg(
        F.sum(_quotes(F.col("value"))).alias("quotes"), F.sum(F.octet_length("value") + 1).alias("bytes"),
        F.any_value("path").alias("path"), F.any_value("size").alias("size"))
    strings = sums.select(
        "file", "block", "path", (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1).alias("in_string"),
        (F.lead("block").over(order).isNull() & (F.sum("bytes").over(Window.partitionBy("file")) > F.col("size"))).alias("unfinished"))
    depths = "file bigint, block bigint, change bigint, least bigint, key_0 string, key_1 string"
    depth = _join_parts(parts, strings, "in_string", "unfinished").mapInArrow(_over_parts(_ended(_depth_sums), depths.split(",")), depths)
    placed = strings.join(depth, ["file", "block"]).withColumn("depth", F.coalesce(F.sum("change").over(before), F.lit(0)))
    lowest = F.col("depth") + F.col("least")
    placed = placed.withColumn("_key", F.when(lowest == 1, F.col("key_0")).when(lowest == 0, F.col("key_1")))
    key = F.last("_key", ignorenulls=True).over(before)
    end = F.col("depth") + F.col("change")
    last = F.lead("block").over(order).isNull()
    states = placed.select(
        "file", "block", "path", "in_string", "unfinished", "depth", key.alias("key"),
        (last & (end != 0)).alias("_broken"), ((F.col("depth") > 2) | (end > 2)).alias("open"))
    return states.where(_fail(F.col("_broken"), F.concat("path", F.lit(" is malformed: not a whole document")))).drop("_broken")


def read_json_elements(spark: SparkSession, path: str, field: str, element: T.StructType) -> DataFrame:
    """Elements of the top-level array ``field`` of JSON files that hold one object each, and ``_ord``.

    An element that is not an object of this shape, a document that is cut off or whose brackets do not
    match fails the job. What stands between the other top-level values is not checked.
    """
    parts = _parts(spark, path, "}")
    found = _records(parts, _depth_states(parts, field), _json_reader(field), "", "in_string", "unfinished", "depth", "key")
    sound = found.where(_fail(F.col("part") == BROKEN, F.concat("path", F.lit(" is malformed near: "), "text")))
    rows = settle(sound.withColumn("_row", F.from_json("text", element, {"mode": "FAILFAST"})), ["_row"])
    return rows.select("_row.*", _place())
