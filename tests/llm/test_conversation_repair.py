"""Cheapest repair against all repairs, streams against whole conversations, damage against zlib."""

import hashlib
import itertools
import random
import re
import zlib

import duckdb
import pytest

from larder.llm import conversation_repair as op
from larder.llm import oracle

SCHEMA = "conv_id long, turn long, role string, text string"
LEGAL = re.compile(r"(s?(ua)+)?")


def faults(rows):
    """Of each row of a conversation in order: blank, duplicate, truncated or fine."""
    seen, out = set(), []
    for role, text in rows:
        inner = text.strip(" \t\n\x0b\x0c\r")
        if not inner:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("fine" if inner[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def cheapest(rows):
    """Least (cost, edits) and its transcript, over all edits of a short conversation."""
    kinds = faults(rows)
    best = None
    for picked in itertools.product("DKR", repeat=len(rows)):
        if any(kind in ("blank", "duplicate") and edit != "D" for kind, edit in zip(kinds, picked)):
            continue
        cost = sum({"D": 4, "K": 0, "R": 3}[e] + 3 * (e != "D" and k == "truncated") for e, k in zip(picked, kinds))
        # more than one row put in at a place is never cheapest but at the end
        for put in itertools.product((0, 1), repeat=len(rows)):
            for tail in (0, 1, 2):
                edits, shown = "", []
                for (role, text), edit, before in zip(rows, picked, put):
                    edits += "I" * before + edit
                    shown += [(None, "")] * before
                    if edit != "D":
                        shown.append((role if edit == "K" else None, text))
                edits += "I" * tail
                shown += [(None, "")] * tail
                said, last = [], ""
                for role, text in shown:
                    role = role if role is not None else "assistant" if last == "u" else "user"
                    last = role[:1]
                    said.append((role, text))
                total = cost + 3 * edits.count("I")
                if LEGAL.fullmatch("".join(r[:1] or "-" for r, _ in said)) and (best is None or (total, edits) < best[:2]):
                    best = total, edits, "\n".join(f"{r}:{t}" for r, t in said)
    return best


def expected(conv, rows):
    """The row of a conversation of (turn, role, text), in order."""
    kinds = faults([r[1:] for r in rows])
    turns = [t for t, *_ in rows if t is not None]
    initials = [r[1][:1] for r in rows]
    cost, edits, said = cheapest([r[1:] for r in rows])
    return (conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *[kinds.count(k) for k in ("blank", "duplicate", "truncated")],
            sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials)), cost, edits, hashlib.sha256(said.encode()).hexdigest())


def by_turn(rows):
    digest = lambda r: hashlib.md5(f"{len(r[1])}:{r[1]}:{r[2]}".encode()).digest()
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), digest(r)))


def test_least_edits(spark):
    rng = random.Random(3)
    talks = {}
    for conv in range(150):
        roles = rng.choice([["user", "assistant"], ["user"], ["system", "user", "assistant", "tool", ""]])
        talks[conv] = [(rng.choice([None, i, i, i, i + 1]), rng.choice(roles), rng.choice(["Yes.", "no", " ", "", "What?\n", "è", "a. "]))
                       for i in range(rng.randint(1, 4))]
    rows = [(conv, *r) for conv, found in talks.items() for r in found]
    rng.shuffle(rows)
    got = op.repair(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    assert sorted(tuple(r) for r in got) == sorted(expected(conv, by_turn(found)) for conv, found in talks.items())


def search(rows):
    edits = []
    found = op.Survivors(lambda edit, role: edits.append(edit))
    widest = 0
    for role, text in rows:
        found.row(role.encode(), text.encode(), not text.strip(), text.strip()[-1:] not in (".", "!", "?"))
        widest = max(widest, found.unsettled())
    return found.end(), "".join(edits), widest


def test_long_conversation_settles():
    rng = random.Random(4)
    rows = [("assistant" if i % 2 else "user", "" if rng.random() < .05 else f"turn {i}" + rng.choice(["", ".", ".", "."])) for i in range(20_000)]
    (cost, _), edits, widest = search(rows)
    assert widest < 200 and len(edits) >= 20_000 and cost > 0


def test_ways_that_stay_tied():
    # the two halves of a pair can be renamed either way to the end, so nothing settles before it
    (cost, _), edits, widest = search([("user", "a.")] * 4000)
    assert (cost, edits) == (6000, "KR" * 2000) and widest <= 4 * 4000
    small = cheapest([("user", f"{i}.") for i in range(6)])
    (cost, digest), edits, _ = search([("user", f"{i}.") for i in range(6)])
    assert (cost, edits) == small[:2] and digest == hashlib.sha256(small[2].encode()).hexdigest()


def test_nothing_or_only_blank_rows(spark):
    empty = hashlib.sha256(b"").hexdigest()
    assert op.repair(spark.createDataFrame([], SCHEMA)).collect() == []
    gone = spark.createDataFrame([(7, 1, "user", "x", 0), (8, None, None, None, 1)], SCHEMA + ", copies int")
    assert {tuple(r) for r in op.repair(gone).collect()} == {
        (7, 0, 0, 0, 0, 0, 0, "", empty), (8, 0, 1, 0, 0, 0, 4, "D", empty)}


def test_null_ids_other_columns_and_text_ids(spark):
    rows = spark.createDataFrame([(None, 0, "user", "Hm?", 1, b"x"), (None, 1, "assistant", "Yes.", 2, b"y"), ("a", 5, "system", "Be.", 3, b"")],
                                 "conv_id string, turn int, role string, text string, digest long, is_row binary")
    got = {r["conv_id"]: (r["cost"], r["audit"]) for r in op.repair(rows).collect()}
    assert got == {None: (0, "KK"), "a": (4, "D")}


@pytest.mark.parametrize("parts", [1, 7])
def test_repeats_across_turns(spark, parts):
    rows = [(1, t, "user", "Same.") for t in range(300)] + [(1, None, "user", "Same.")]
    row = op.repair(spark.createDataFrame(rows, SCHEMA).repartition(parts)).first()
    assert (row["duplicate"], row["gaps"], row["cost"], row["audit"]) == (300, 0, 1203, "K" + "D" * 300 + "I")


def test_edits_and_rows(spark):
    rng = random.Random(5)
    rows = [(c, t, rng.choice(["user", "assistant", "system"]), rng.choice(["Go.", "ok", "", "Why?"])) for c in range(40) for t in range(rng.randint(1, 7))]
    df = spark.createDataFrame(rows, SCHEMA)
    want = {r["conv_id"]: r for r in op.repair(df).collect()}
    edits, said = {}, {}
    for r in sorted(op.edits(df).collect(), key=lambda r: (r["conv_id"], r["step"])):
        edits[r["conv_id"]] = edits.get(r["conv_id"], "") + r["edit"]
    for r in sorted(op.repaired(df).collect(), key=lambda r: (r["conv_id"], r["step"])):
        said.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
    assert edits == {c: r["audit"] for c, r in want.items() if r["audit"]}
    for c, r in want.items():
        assert hashlib.sha256("\n".join(said.get(c, [])).encode()).hexdigest() == r["repaired_sha256"]


def harmed(rows):
    """Each conversation's rows after damage."""
    out = {}
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        kept = out.setdefault(conv, [])
        if kind == 1:
            text = ""
        elif kind == 2:
            text = re.sub("[.!?]", "", text)
        elif kind == 4:
            role = "user"
        kept.extend([(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1))
    return out


def test_query(spark, write):
    rng = random.Random(6)
    rows = [(c, t, rng.choice(["user", "assistant", "system", None]), rng.choice(["Go. Now!", "ok", None, "Why?", f"{t}."]))
            for c in [*range(120), None] for t in [*range(rng.randint(0, 4)), None]]
    rows += rows[:30]
    got = op.op13_conversation_repair(spark, write(conversations=spark.createDataFrame(rows, SCHEMA))).collect()
    want = [expected(c, by_turn(found)) if found else (c, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for c, found in harmed(rows).items()]
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, want))


def test_query_equals_sql(spark, write):
    rng = random.Random(16)
    rows = [(c, t, rng.choice(["user", "assistant", "system", "tool", None]), rng.choice(["Go. Now!", "ok", None, "Why?", f"é{t}."]))
            for c in [*range(200), None] for t in [*range(rng.randint(0, 6)), None]]
    rows += rows[:60]
    where = write(conversations=spark.createDataFrame(rows, SCHEMA))
    duck = duckdb.connect()
    duck.execute(f"create view conversations as select * from '{where}/conversations.parquet/*.parquet'")
    cursor = duck.execute(oracle.OP13)
    got = op.op13_conversation_repair(spark, where).select(*[c[0] for c in cursor.description]).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, cursor.fetchall()))
