"""Repair of conversation structure by a Viterbi search that emits edits once its survivors coalesce.

The rows of a conversation, in order of turn, are kept (0), given the role user or
assistant (3) or deleted (4), and empty user or assistant rows are put in between (3),
so that what remains reads ``(system? (user assistant)+)?`` at least cost. Four states
tell what the repaired part ends in: nothing, system, user, assistant. Each state has one
survivor, the cheapest way to it and among those the one of least edits in ASCII order.

Survivors are leaves of a tree of backpointers with reference counts. A node that no
survivor needs goes at once; a root with one child left is settled, so its edit is emitted
and it goes too. Survivors that can never win again (another one could do the same for
less, whatever follows) are dropped, so that nearly all conversations settle within a few
rows; where ways stay tied for long, an unsettled row costs a node per survivor and no text. Every
survivor carries the SHA-256 of its own transcript, so texts are let go as they are read.

Tied survivors compare by their whole unsettled edits. As all of them have used up the
same rows and none ends in an insertion, no one's edits begin another's, and an order
between them stays what it is when both are continued: it is kept as a rank.
"""

import hashlib
from collections.abc import Callable, Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from larder.llm.common import SEPARATORS, ship, table

# Fixed by the contract.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
ENDS = ".!?"
NAMES = {"u": "user", "a": "assistant"}

NOTHING, SYSTEM, USER, ASSISTANT = range(4)
FINE, BLANK, DUPLICATE, CUT = range(4)
# What it costs the survivor of the second state, at most, to do whatever that of the first may do later.
_CATCH_UP = {
    NOTHING: {SYSTEM: 2 * INSERT, USER: INSERT + DELETE, ASSISTANT: DELETE},
    SYSTEM: {NOTHING: 0, USER: INSERT, ASSISTANT: 0},
    USER: {NOTHING: INSERT, SYSTEM: INSERT, ASSISTANT: INSERT},
    ASSISTANT: {NOTHING: 0, SYSTEM: 2 * INSERT, USER: INSERT},
}
# States from which a row of the role may follow at once, and with one row put in between.
_BEFORE = {"u": ((NOTHING, SYSTEM, ASSISTANT), (USER,)), "a": ((USER,), (NOTHING, SYSTEM, ASSISTANT))}
_STATE = {"s": SYSTEM, "u": USER, "a": ASSISTANT}


class _Node:
    """One edit of a way; ``held`` by a survivor or by the nodes that continue it."""

    __slots__ = ("parent", "edit", "role", "children", "held")

    def __init__(self, parent: "_Node | None", edit: str, role: str | None):
        self.parent, self.edit, self.role = parent, edit, role
        self.children: list[_Node] = []
        self.held = False
        if parent is not None:
            parent.children.append(self)


class Survivors:
    """The search over one conversation; ``settled(edit, role)`` hears of each edit, in order.

    ``role`` is that of a row put in or renamed, else null.
    """

    def __init__(self, settled: Callable[[str, str | None], None]):
        self.settled = settled
        self.root = _Node(None, "", None)
        self.root.held = True
        # cost, rank, node and transcript of each state's survivor
        self.ways: list[tuple | None] = [(0, 0, self.root, hashlib.sha256()), None, None, None]

    def row(self, role: bytes, text: bytes, must_go: bool, truncated: bool) -> None:
        """Take one more row."""
        start = role[:1].decode("latin-1")
        found: list[tuple | None] = [None] * 4
        # (cost, rank of the way so far, edits) decides, with the state it comes from and the new role
        for state, way in enumerate(self.ways):
            if way is not None:
                found[state] = (way[0] + DELETE, way[1], "D", state, None)
        if not must_go:
            extra = TRUNCATED if truncated else 0
            if start == "s" and self.ways[NOTHING]:
                self._offer(found, SYSTEM, NOTHING, extra, "K", None)
            for to in "ua":
                edit, cost, name = ("K", extra, None) if start == to else ("R", extra + REROLE, NAMES[to])
                at_once, between = _BEFORE[to]
                for state in at_once:
                    self._offer(found, _STATE[to], state, cost, edit, name)
                for state in between:
                    self._offer(found, _STATE[to], state, cost + INSERT, "I" + edit, name)
        self._step(found, role, text)

    def _offer(self, found: list, to: int, state: int, cost: int, edits: str, name: str | None) -> None:
        way = self.ways[state]
        if way is not None:
            new = (way[0] + cost, way[1], edits, state, name)
            if found[to] is None or new[:3] < found[to][:3]:
                found[to] = new

    def _step(self, found: list, role: bytes, text: bytes) -> None:
        for state, new in enumerate(found):
            if new is not None and any(
                other is not None and new[0] > other[0] + _CATCH_UP[state][by]
                for by, other in enumerate(found) if by != state
            ):
                found[state] = None
        order = sorted((new[1], new[2], state) for state, new in enumerate(found) if new is not None)
        rank = {state: i for i, (_, _, state) in enumerate(order)}
        before, self.ways = self.ways, [None] * 4
        for state, new in enumerate(found):
            if new is None:
                continue
            cost, _, edits, source, name = new
            node, transcript = before[source][2], before[source][3]
            if edits != "D":
                transcript = transcript.copy()
                first = source == NOTHING
                if len(edits) == 2:
                    put = "assistant" if source == USER else "user"
                    transcript.update((b"" if first else b"\n") + put.encode() + b":")
                    node, first = _Node(node, "I", put), False
                transcript.update((b"" if first else b"\n") + (name.encode() if name else role) + b":")
                transcript.update(text)
            node = _Node(node, edits[-1], name)
            self.ways[state] = (cost, rank[state], node, transcript)
        for way in before:
            if way is not None:
                way[2].held = False
        for way in self.ways:
            if way is not None:
                way[2].held = True
        for way in before:
            if way is not None:
                self._free(way[2])
        self._settle()

    def _free(self, node: _Node) -> None:
        while not node.held and not node.children and node.parent is not None:
            parent = node.parent
            parent.children.remove(node)
            node.parent, node = None, parent

    def _settle(self) -> None:
        while not self.root.held and len(self.root.children) == 1:
            self.root = self.root.children[0]
            self.root.parent = None
            self.settled(self.root.edit, self.root.role)

    def unsettled(self) -> int:
        """Nodes of the tree, the root aside."""
        count, todo = 0, [self.root]
        while todo:
            node = todo.pop()
            count += len(node.children)
            todo.extend(node.children)
        return count

    def end(self) -> tuple[int, str]:
        """Settle what is left; gives the cost and the transcript's SHA-256."""
        ends = [(way[0] + INSERT * k, way[1], k, state) for state, k in ((NOTHING, 0), (SYSTEM, 2), (USER, 1), (ASSISTANT, 0))
                if (way := self.ways[state]) is not None]
        cost, _, k, state = min(ends)
        _, _, node, transcript = self.ways[state]
        path = []
        while node is not self.root:
            path.append((node.edit, node.role))
            node = node.parent
        path = path[::-1] + [("I", name) for name in (["user", "assistant"][2 - k:])]
        for name in ["user", "assistant"][2 - k:]:
            transcript.update(b"\n" + name.encode() + b":")
        for edit, name in path:
            self.settled(edit, name)
        return cost, transcript.hexdigest()


def damage(conversations: DataFrame) -> DataFrame:
    """Rows with faults that depend on conversation and turn alone, and ``copies``, how often each row stays (0 to 2).

    Nulls read as one space, in the role, in the text and where the fault is chosen; the columns
    ``conv_id`` and ``turn`` keep theirs.
    """
    blank = F.lit(" ")
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), blank) for c in ("conv_id", "turn")])
    kind, role, text = F.col("_kind"), F.coalesce("role", blank), F.coalesce("text", blank)
    return conversations.select("conv_id", "turn", "role", "text").withColumn("_kind", F.crc32(key) % 20).select(
        "conv_id", "turn",
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ENDS, "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    )


def _fault(text: Column) -> Column:
    """Blank, truncated or fine, by the text alone."""
    inner = F.rtrim(text, F.lit(SEPARATORS))
    return F.when(inner == "", BLANK).when(F.right(inner, F.lit(1)).isin(*ENDS), FINE).otherwise(CUT)


def _in_order(rows: DataFrame) -> DataFrame:
    """Rows of a conversation side by side in order, with marks before the first row of each role and text.

    The marks come from narrow rows grouped by conversation, role and MD5, so that finding
    repeats needs no memory of a conversation's texts.
    """
    blank = F.lit(" ")
    copies = F.col("copies") if "copies" in rows.columns else F.lit(1)
    rows = rows.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", blank).alias("role"),
        F.coalesce("text", blank).alias("text"), copies.cast("int").alias("copies"))
    rows = rows.withColumn("digest", F.unhex(F.md5(F.concat_ws(":", F.length("role"), "role", "text"))))
    first = rows.where("copies > 0").groupBy("conv_id", "role", "digest").agg(F.min(F.struct("turn")).alias("at"))
    marks = first.select(
        "conv_id", F.col("at.turn").alias("turn"), F.col("role").cast("binary").alias("role"), "digest",
        F.lit(False).alias("is_row"), F.lit(None).cast("binary").alias("text"), F.lit(0).alias("copies"), F.lit(FINE).alias("fault"))
    full = rows.select(
        "conv_id", "turn", F.col("role").cast("binary").alias("role"), "digest", F.lit(True).alias("is_row"),
        F.col("text").cast("binary").alias("text"), "copies", _fault(F.col("text")).alias("fault"))
    return marks.unionByName(full).repartition("conv_id").sortWithinPartitions(
        "conv_id", F.asc_nulls_first("turn"), "role", "digest", "is_row")


class _Conversation:
    """Counts of one conversation and its search, row by row."""

    def __init__(self, settled: Callable[[str, str | None], None]):
        self.search = Survivors(settled)
        self.counts = [0] * 4
        self.illegal = self.turns = 0
        self.least = self.last = self.initial = self.fresh = None

    def mark(self, turn: int | None, role: bytes, digest: bytes) -> None:
        self.fresh = (turn, role, digest)

    def row(self, turn: int | None, role: bytes, digest: bytes, text: bytes, fault: int) -> None:
        if turn is not None and turn != self.last:
            self.least = turn if self.least is None else self.least
            self.last, self.turns = turn, self.turns + 1
        initial = role.decode("utf-8", "replace")[:1]
        if self.initial is not None and self.initial + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.initial = initial
        first, self.fresh = self.fresh == (turn, role, digest), None
        if fault != BLANK and not first:
            fault = DUPLICATE
        self.counts[fault] += 1
        self.search.row(role, text, fault in (BLANK, DUPLICATE), fault == CUT)

    def gaps(self) -> int:
        return 0 if self.last is None else self.last - self.least + 1 - self.turns


def _conversations(batches: Iterator[pa.RecordBatch], settled: Callable) -> Iterator[tuple | None]:
    """Each conversation of a sorted partition as (conv_id, conversation), when its last row is read; None after each batch.

    ``settled(conv_id, edit, role)`` hears of edits as they settle.
    """
    now, current = None, None
    for batch in batches:
        for conv, turn, role, digest, is_row, text, copies, fault in zip(*(c.to_pylist() for c in batch.columns)):
            if current is None or conv != now:
                if current is not None:
                    yield now, current
                now, current = conv, _Conversation(partial(settled, conv))
            if not is_row:
                current.mark(turn, role, digest)
            for _ in range(copies):
                current.row(turn, role, digest, text, fault)
        yield None
    if current is not None:
        yield now, current


def _sent(rows: list[tuple], schema: T.StructType) -> Iterator[pa.RecordBatch]:
    """The rows as a batch, if there are any; the list is empty after."""
    if rows:
        types = to_arrow_schema(schema)
        yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows), types)], schema=types)
        rows.clear()


def repair(rows: DataFrame) -> DataFrame:
    """One row per ``conv_id``: faults, cost and edits of the cheapest repair, SHA-256 of its transcript.

    ``rows`` has conv_id, turn, role, text, and may have ``copies``; a row of 0 copies only
    names its conversation. Other columns are left out, whatever their names. Null conv_ids are one
    conversation; null turns come first; rows of one turn go by role, then by the MD5 of role and text;
    null roles and texts read as one space. No rows give no rows. A conversation is one stream through
    one task, as a SHA-256 of it has to be, and holds no texts.
    """
    ship(rows.sparkSession)
    schema = T.StructType([
        T.StructField("conv_id", rows.schema["conv_id"].dataType),
        *[T.StructField(c, T.LongType()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        audit: list[str] = []
        out: list[tuple] = []
        for found in _conversations(batches, lambda conv, edit, role: audit.append(edit)):
            if found is None:
                yield from _sent(out, schema)
                continue
            conv, talk = found
            cost, digest = talk.search.end()
            _, blank, duplicate, truncated = talk.counts
            out.append((conv, talk.gaps(), blank, duplicate, truncated, talk.illegal, cost, "".join(audit), digest))
            audit.clear()
        yield from _sent(out, schema)

    return _in_order(rows).mapInArrow(run, schema)


def edits(rows: DataFrame) -> DataFrame:
    """One row per edit of the repair: conv_id, step (from 0), place, edit, role.

    ``place`` numbers the rows of a conversation from 0, copies included, and is null for a row put in;
    ``role`` is that of a row put in or renamed. Edits are sent on as they settle.
    """
    ship(rows.sparkSession)
    schema = T.StructType([
        T.StructField("conv_id", rows.schema["conv_id"].dataType), T.StructField("step", T.LongType()), T.StructField("place", T.LongType()),
        T.StructField("edit", T.StringType()), T.StructField("role", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        at = [0, 0]

        def settled(conv, edit: str, role: str | None) -> None:
            out.append((conv, at[0], None if edit == "I" else at[1], edit, role))
            at[0] += 1
            at[1] += edit != "I"

        for found in _conversations(batches, settled):
            if found is None:
                yield from _sent(out, schema)
            else:
                found[1].search.end()
                at[:] = [0, 0]
        yield from _sent(out, schema)

    return _in_order(rows).mapInArrow(run, schema)


def repaired(rows: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, step, role, text; rows put in have empty texts.

    Steps are those of ``edits``, so they rise but have gaps where rows were deleted.
    """
    kept = edits(rows).where("edit <> 'D'")
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "digest")
    full = _in_order(rows).where("is_row").select("conv_id", "turn", "role", "digest", "text", F.explode(F.array_repeat(F.lit(0), F.col("copies"))).alias("_"))
    placed = full.select(
        F.col("conv_id").alias("_conv"), (F.row_number().over(order) - 1).cast("long").alias("_place"),
        F.col("role").cast("string").alias("_role"), F.col("text").cast("string").alias("_text"))
    found = kept.join(placed, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("place") == F.col("_place")), "left")
    return found.select("conv_id", "step", F.coalesce("role", "_role").alias("role"), F.coalesce("_text", F.lit("")).alias("text"))


def op13_conversation_repair(spark, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every conversation after damage."""
    return repair(damage(table(spark, sf_dir, "conversations")))
