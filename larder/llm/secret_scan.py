"""Secret scans that link the parts of a credential, in DataFrame functions only.

Strong patterns are reported wherever they stand. Weak candidates (a bare key, a short
password, a login name, an endpoint) are reported only when a complementary part lies
within ``SCOPE`` code points in the same text: a weak secret or a login name needs its
counterpart, an endpoint needs both. Candidates are few rows; they meet in an interval
join over buckets of ``SCOPE`` code points. Matches of one kind do not overlap, so a
bucket holds a bounded number of them and the join stays linear in the text.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.common import Aside, stage, table
from larder.operators.settle import settle

SCOPE = 200
MASK = "[SECRET]"
_PAGE = 4096  # code points
_BLOCK = 256  # spans

# Fixed by the contract: the strong kinds in their order, and the least length of what counts.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_VALUE = 8
STRONG = {"assign": ASSIGN, "access": "AKIA[A-Z0-9]{12,}", "hex": "[0-9a-f]{32,}"}
WEAK = {
    "key40": r"(?<![A-Za-z0-9+/=])(?=[A-Za-z0-9+/]*[0-9])(?=[A-Za-z0-9+/]*[A-Z])(?=[A-Za-z0-9+/]*[a-z])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=])",
    "login": r"""(?i:username|user|login|client_?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9._@-]{3,}""",
    "short": ASSIGN,
    "endpoint": r"""https?://[^\s"'<>]+|(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?::[0-9]+)?(?![0-9.])""",
}
KINDS = (*STRONG, *WEAK)
IDENTIFIERS = ("access", "login")
SECRETS = ("assign", "hex", "key40", "short")
_RUN = 256
_SPANS = "array<struct<start:int,kind:int,end:int>>"


def _running_sum(lengths: str, i: Column) -> Column:
    """The sum of the first ``i + 1`` entries; sums of whole runs are taken from ``<lengths>_runs``."""
    add = lambda a, b: a + b
    run = F.floor(i / _RUN).cast("int")
    return (F.aggregate(F.slice(f"{lengths}_runs", F.lit(1), run), F.lit(0), add)
            + F.aggregate(F.slice(lengths, run * _RUN + 1, i - run * _RUN + 1), F.lit(0), add))


def _with_matches(df: DataFrame, name: str, pattern: str) -> DataFrame:
    """Adds an array column ``name`` of (start, end, value) of the matches in ``text``.

    Start and end count code points: the text between matches comes from a split by
    the same pattern, and lengths are summed up.
    """
    found = F.col("text").rlike(pattern)
    value = F.regexp_extract_all("text", F.lit(pattern), F.lit(2)) if name == "assign" else F.lit(None).cast("array<string>")
    df = settle(df.withColumn("m", F.when(found, F.struct(
        F.transform(F.regexp_extract_all("text", F.lit(pattern), F.lit(0)), lambda x: F.length(x)).alias("sizes"),
        F.transform(F.split("text", pattern, -1), lambda x: F.length(x)).alias("gaps"),
        F.transform(value, lambda x: F.length(x)).alias("values"),
    ))), ["m"])
    # steps: from the end of one match to the end of the next
    df = df.withColumn("steps", F.transform("m.sizes", lambda x, i: x + F.get("m.gaps", i)))
    df = settle(df, ["steps"]).withColumn("steps_runs", F.when(F.col("steps").isNotNull(), F.transform(
        F.sequence(F.lit(0), F.floor(F.size("steps") / _RUN).cast("int")),
        lambda r: F.aggregate(F.slice("steps", r * _RUN + 1, F.lit(_RUN)), F.lit(0), lambda a, b: a + b))))
    df = settle(df, ["steps_runs"])
    ends = F.transform("m.sizes", lambda x, i: F.struct(
        (_running_sum("steps", i) - x).alias("start"), _running_sum("steps", i).alias("end"),
        F.get("m.values", i).alias("value")))
    df = df.withColumn(name, F.coalesce(ends, F.array().cast("array<struct<start:int,end:int,value:int>>")))
    return settle(df, [name]).drop("m", "steps", "steps_runs")


def scan(docs: DataFrame) -> DataFrame:
    """Adds ``found``: the strong spans, the weak candidates, and a key for equal texts.

    Null and empty texts have no spans. Spans are (start, kind, end), kind by its place
    in ``KINDS``, sorted.
    """
    aside = Aside(docs, "text")
    df = aside.rows.withColumn("text", F.coalesce("text", F.lit("")))
    patterns = {k: p for k, p in (STRONG | WEAK).items() if k != "short"}
    for name, pattern in patterns.items():
        df = _with_matches(df, name, pattern)

    def spans(kind: str) -> Column:
        matches = {"assign": F.filter("assign", lambda x: x["value"] >= ASSIGN_VALUE),
                   "short": F.filter("assign", lambda x: x["value"] < ASSIGN_VALUE)}.get(kind, F.col(kind))
        return F.transform(matches, lambda x: F.struct(x["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), x["end"].alias("end")))

    strong = F.sort_array(F.concat(*[spans(k) for k in STRONG]))
    weak = F.sort_array(F.concat(*[spans(k) for k in WEAK]))
    key = F.when(F.size(F.concat(*[F.col(k) for k in patterns])) > 1, F.sha2("text", 256))
    found = F.struct(strong.alias("strong"), weak.alias("weak"), key.alias("key"))
    return aside.back(settle(df.select(*aside.names, found.alias("found")), ["found"]), "found")


def link(scanned: DataFrame, scope: int = SCOPE) -> DataFrame:
    """The weak spans whose complementary parts co-occur: one row per text, ``key`` and ``linked``.

    Equal texts have equal spans and are taken once, before anything is joined.
    """
    kinds = lambda names: [KINDS.index(k) for k in names]
    parts = (
        scanned.where(F.col("found.key").isNotNull() & (F.size("found.weak") > 0))
        .select(F.col("found.key").alias("key"), F.inline(F.concat("found.strong", "found.weak"))).distinct()
    )
    bucket = lambda place: F.floor(place / scope)
    known = parts.where(F.col("kind").isin(kinds(IDENTIFIERS + SECRETS))).select(
        F.col("key").alias("k"), F.col("start").alias("s"), F.col("end").alias("e"), F.col("kind").alias("part"),
        F.explode(F.sequence(bucket(F.col("start")), bucket(F.col("end")))).alias("b"))
    weak = parts.where(F.col("kind").isin(kinds(WEAK))).select(
        "key", "start", "kind", "end",
        F.explode(F.sequence(bucket(F.col("start")) - 1, bucket(F.col("end")) + 1)).alias("bucket"))
    met = weak.join(known, (F.col("key") == F.col("k")) & (F.col("bucket") == F.col("b"))
                    & (F.col("s") <= F.col("end") + scope) & (F.col("e") >= F.col("start") - scope))
    near = met.groupBy("key", "start", "kind", "end").agg(
        F.max(F.col("part").isin(kinds(IDENTIFIERS))).alias("identifier"), F.max(F.col("part").isin(kinds(SECRETS))).alias("secret"))
    is_kind = lambda *names: F.col("kind").isin(kinds(names))
    reported = (is_kind("key40", "short") & F.col("identifier")) | (is_kind("login") & F.col("secret")) | (
        is_kind("endpoint") & F.col("identifier") & F.col("secret"))
    return near.where(reported).groupBy("key").agg(F.collect_list(F.struct("start", "kind", "end")).alias("linked"))


def with_spans(scanned: DataFrame, linked: DataFrame) -> DataFrame:
    """Adds ``spans``, strong and linked together, to the ``found`` of scanned rows."""
    # rows without candidates get keys of their own, so that they do not meet in one task
    key = F.coalesce(F.col("found.key"), F.concat(F.lit("-"), F.xxhash64(F.col("doc_id"), F.size("found.strong")).cast("string")))
    other = linked.select(F.col("key").alias("found_key"), F.col("linked").alias("found_linked"))
    joined = scanned.withColumn("found", F.col("found").withField("key", key)).join(other, F.col("found.key") == F.col("found_key"), "left")
    spans = F.sort_array(F.concat("found.strong", F.coalesce("found_linked", F.array().cast(_SPANS))))
    return joined.withColumn("found", F.col("found").withField("spans", spans)).drop("found_key", "found_linked")


def _written(spans: str) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def op8_secret_scan(spark, sf_dir: str) -> DataFrame:
    """Spans of every document; the small table of spans is written, as two plans read it."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scanned = stage(scan(docs).select("doc_id", "found"))
    found = with_spans(scanned, link(scanned))
    count = lambda kind: F.size(F.filter("found.strong", lambda x: x["kind"] == KINDS.index(kind))).cast("long")
    return found.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(_written("found.strong"), 256).alias("base_sha256"), _written("found.spans").alias("spans"))


def masked_text(text: Column, spans: Column) -> Column:
    """``text`` with a mark in place of each run of overlapping spans, which are in order.

    The text is cut into pages, so that what a span costs does not depend on its place, and spans go in
    blocks, each of which starts behind the last end of those before: no array is copied for every span.
    """
    pages = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{_PAGE}}}"), F.lit(0))

    def piece(pages: Column, start: Column, end: Column) -> Column:
        # from a page to the one that the piece ends in; most pieces lie in one
        first, last = F.floor(start / _PAGE), F.floor((end - 1) / _PAGE)
        joined = F.array_join(F.slice(pages, (first + 1).cast("int"), (last - first + 1).cast("int")), "")
        return F.when(end <= start, F.lit("")).otherwise(F.substr(joined, (start - first * _PAGE + 1).cast("int"), (end - start).cast("int")))

    def over(state: Column) -> Column:
        pages, blocks = state["pages"], state["blocks"]
        ends = F.transform(blocks, lambda b: F.array_max(b["end"]))

        def block(b: Column, i: Column) -> Column:
            before = F.coalesce(F.array_max(F.slice(ends, F.lit(1), i)), F.lit(0))
            begin = F.struct(F.array().cast("array<string>").alias("out"), before.alias("at"))

            def cut(acc: Column, x: Column) -> Column:
                fresh = F.concat(acc["out"], F.array(piece(pages, acc["at"], x["start"]), F.lit(MASK)))
                return F.struct(F.when(x["start"] >= acc["at"], fresh).otherwise(acc["out"]).alias("out"), F.greatest(acc["at"], x["end"]).alias("at"))

            return F.aggregate(b, begin, cut, lambda acc: acc["out"])

        rest = piece(pages, F.array_max(ends), state["length"])
        return F.concat(F.array_join(F.flatten(F.transform(blocks, block)), ""), rest)

    numbers = F.sequence(F.lit(0), F.floor((F.size(spans) - 1) / _BLOCK).cast("int"))
    blocks = F.transform(numbers, lambda b: F.slice(spans, b * _BLOCK + 1, F.lit(_BLOCK)))
    state = F.struct(pages.alias("pages"), blocks.alias("blocks"), F.length(text).alias("length"))
    # in an array of one, so that pages and blocks are worked out once
    return F.transform(F.array(state), over)[0]


def mask(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with reported spans replaced by a mark and ``n_chars`` counted anew.

    Null texts stay null; texts without spans stay as they are. Overlapping spans share
    one mark. Texts are scanned once and written with what was found; only those with a span or a
    candidate meet the spans, by the digest of the text, and move for it.
    """
    aside = Aside(docs, "doc_id", "text")
    scanned = scan(aside.rows)
    some = F.size("found.strong") + F.size("found.weak") > 0
    scanned = stage(scanned.withColumn("own_digest", F.when(some, F.sha2("text", 256))).drop("doc_id", "text"))
    found = scanned.where(F.col("own_digest").isNotNull())
    parts = found.select(F.col("own_digest").alias("digest"), aside.own("doc_id").alias("doc_id"), "found")
    spans = with_spans(parts, stage(link(parts))).where(F.size("found.spans") > 0)
    # equal texts have equal spans
    spans = stage(spans.groupBy("digest").agg(F.any_value("found.spans").alias("spans")))
    found = found.join(spans, F.col("own_digest") == F.col("digest"), "left")
    text = aside.own("text")
    found = settle(found.withColumn("masked", F.when(F.col("spans").isNotNull(), masked_text(text, F.col("spans")))), ["masked"])
    found = found.withColumn("masked", F.coalesce("masked", text))
    n_chars = F.when(F.col("masked").eqNullSafe(text), aside.own("n_chars")).otherwise(F.length("masked").cast("long"))
    rest = aside.back(scanned.where(F.col("own_digest").isNull()))
    return rest.union(aside.back(found, text=F.col("masked"), n_chars=n_chars))
