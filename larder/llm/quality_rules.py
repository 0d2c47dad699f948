"""Quality rules with risk-controlled cutoffs, in DataFrame functions only.

Four shares are measured on each text; the larger, the worse. For each stratum (the
language) and rule, cutoffs are tested from lenient to strict on documents that are
labelled good. A cutoff passes if the exact binomial tail shows that it rejects at
most ``risk / rules`` of the good documents; testing stops at the first that fails
(fixed-sequence testing needs no correction within a sequence), and the level is
divided by the number of sequences (strata times rules, Bonferroni). So with
probability ``1 - delta`` all rules together reject at most ``risk`` of the good
documents of every stratum. A sequence without a passing cutoff rejects nothing.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from larder.llm.common import SEPARATORS, Aside, stage, table, without, words
from larder.operators.settle import settle

WINDOW = 8
SYMBOLS = "#*$%&|<>"
RULES = ("symbols", "dup_lines", "repeats", "loud")
CUTOFFS = (0.60, 0.50, 0.40, 0.30, 0.25, 0.20, 0.15, 0.12, 0.10, 0.08, 0.06, 0.05, 0.04, 0.03, 0.02)
RISK = 0.02
DELTA = 0.05


def measure(docs: DataFrame) -> DataFrame:
    """Adds a column ``q`` of counts, shares and the stratum to each row.

    Null and empty texts have zeros everywhere; a null language is a stratum of its
    own. Windows are compared by 64-bit hashes within one document and found again by
    sorting, so a text of n words takes n log n steps.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    solid = without(text, SEPARATORS)
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike("[^ \\x09-\\x0D]"))
    width = WINDOW
    aside = Aside(docs, "text", "lang")
    parts = aside.rows.select(
        *aside.names,
        F.coalesce(F.col("lang"), F.lit("")).alias("stratum"), words(F.col("text")).alias("words"), lines.alias("lines"),
        F.length(solid).cast("long").alias("word_chars"),
        (F.length(text) - F.length(without(text, SYMBOLS))).cast("long").alias("n_symbols"),
        (F.length(solid) - F.length(F.regexp_replace(solid, "[A-Z!]", ""))).alias("n_loud"),
    )
    windows = F.when(
        F.size("words") >= width,
        F.transform(F.sequence(F.lit(1), F.size("words") - (width - 1)), lambda i: F.xxhash64(F.slice("words", i, width))),
    ).otherwise(F.array().cast("array<bigint>"))
    # only texts with a repeated window are sorted
    by_hash = F.when(
        F.size(F.array_distinct("windows")) < F.size("windows"),
        F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
    )
    places = F.sort_array(F.transform(
        F.filter("by_hash", lambda x, i: F.get("by_hash", i - 1)["h"].eqNullSafe(x["h"])
                 | F.get("by_hash", i + 1)["h"].eqNullSafe(x["h"])),
        lambda x: x["i"],
    ))
    covered = F.transform("places", lambda p, i: F.least(F.lit(width), F.coalesce(F.get("places", i + 1) - p, F.lit(width))))
    steps = settle(parts, ["words", "lines", "word_chars"]).withColumn("windows", windows)
    steps = settle(steps, ["windows"]).withColumn("by_hash", by_hash).drop("windows")
    steps = settle(steps, ["by_hash"]).withColumn("places", places).drop("by_hash")
    steps = settle(steps, ["places"]).withColumn(
        "n_repeat", F.coalesce(F.aggregate(covered, F.lit(0), lambda a, b: a + b), F.lit(0)).cast("long"))
    n = F.size("words").cast("long")
    share = lambda part, whole: F.coalesce(F.try_divide(part, whole), F.lit(0.0)).cast("double")
    n_lines = F.size("lines")
    n_dup = (n_lines - F.size(F.array_distinct("lines"))).cast("long")
    measures = steps.select(
        *aside.names,
        F.struct(
            "stratum", n.alias("n_words"), "word_chars", "n_symbols", n_dup.alias("n_dup_lines"),
            F.col("n_repeat").alias("n_repeat_words"),
            ((n < 20) | (100 * F.col("n_repeat") > 30 * n)).alias("base_failed"),
            F.array(share(F.col("n_symbols"), F.col("word_chars")), share(n_dup, n_lines),
                    share(F.col("n_repeat"), n), share(F.col("n_loud"), F.col("word_chars"))).alias("shares"),
        ).alias("q"),
    )
    return aside.back(settle(measures, ["q"]), "q")


def binomial_cdf(k: Column, n: Column, p: float) -> Column:
    """P(at most k of n) at rate p, summed term by term in logarithms."""
    odds = F.log(F.lit(p / (1 - p)))
    first = n.cast("double") * F.log1p(F.lit(-p))
    steps = F.when(k >= 1, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>"))

    def add(acc: Column, i: Column) -> Column:
        term = acc["term"] + F.log((n - i + 1).cast("double")) - F.log(i.cast("double")) + odds
        top = F.greatest(acc["total"], term)
        total = top + F.log1p(F.exp(-F.abs(acc["total"] - term)))
        return F.struct(term.alias("term"), total.alias("total"))

    start = F.struct(first.alias("term"), first.alias("total"))
    return F.exp(F.aggregate(steps, start, add)["total"])


def fit_cutoffs(measured: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA,
                cutoffs: Sequence[float] = CUTOFFS) -> DataFrame:
    """One row per stratum with labelled good documents: ``stratum``, ``limits``.

    ``limits`` holds a cutoff per rule, null where none could be shown to be safe.
    A document counts as good if any of its labels says so; null labels and labels
    without a document are ignored. An empty label table gives no rows.
    """
    good = (labels.where(F.col("quality") == 1).groupBy(F.col("doc_id").alias("good_id")).agg(F.lit(1).alias("one")))
    holdout = measured.select(F.col("doc_id").alias("id"), F.col("q.stratum").alias("stratum"), F.col("q.shares").alias("shares"))
    holdout = holdout.join(good, holdout["id"] == good["good_id"], "left_semi")
    # passed: how many cutoffs of the grid the share exceeds
    passed = sum((F.col("share") > c).cast("int") for c in cutoffs)
    counts = (
        holdout.select("stratum", F.posexplode("shares").alias("rule", "share"))
        .withColumn("from", F.lit(len(cutoffs)) - passed)
        .groupBy("stratum", "rule", "from").agg(F.count("*").alias("n"))
    )
    # the cutoff at place j rejects what exceeds it: all rows with from <= j
    tests = (
        counts.groupBy("stratum", "rule").agg(F.sum("n").alias("n"), F.collect_list(F.struct("from", "n")).alias("at"))
        .withColumn("sequences", F.lit(len(RULES)) * F.count("*").over(Window.partitionBy("rule")))
        .select("stratum", "rule", "n", "sequences", "at",
                F.posexplode(F.array(*[F.lit(float(c)) for c in cutoffs])).alias("j", "cutoff"))
        .withColumn("k", F.aggregate(F.filter("at", lambda x: x["from"] <= F.col("j")),
                                     F.lit(0).cast("long"), lambda a, x: a + x["n"]))
    )
    rate = risk / len(RULES)
    safe = (F.col("k") < F.col("n") * rate) & (
        binomial_cdf(F.when(F.col("k") < F.col("n") * rate, F.col("k")), F.col("n"), rate) <= F.lit(delta) / F.col("sequences"))
    sequence = Window.partitionBy("stratum", "rule").orderBy("j")
    last = (
        tests.withColumn("safe", F.min(F.coalesce(safe, F.lit(False)).cast("int")).over(sequence))
        .groupBy("stratum", "rule").agg(F.min(F.when(F.col("safe") == 1, F.col("cutoff"))).alias("cutoff"))
    )
    return (
        last.groupBy("stratum").agg(F.sort_array(F.collect_list(F.struct("rule", "cutoff"))).alias("all"))
        .select("stratum", F.transform("all", lambda x: x["cutoff"]).alias("limits"))
    )


def judge(measured: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """Adds ``kept`` to ``q``: false if the base rules fail or a share exceeds its limit.

    Strata without a row of cutoffs keep whatever passes the base rules.
    """
    limits = cutoffs.select(F.col("stratum").alias("q_stratum"), F.col("limits").alias("q_limits"))
    joined = measured.join(limits, F.col("q.stratum") == F.col("q_stratum"), "left")
    over = F.exists(F.arrays_zip(F.col("q.shares").alias("share"), F.col("q_limits").alias("limit")),
                    lambda x: F.coalesce(x["share"] > x["limit"], F.lit(False)))
    kept = ~F.col("q.base_failed") & ~F.when(F.col("q_limits").isNull(), F.lit(False)).otherwise(over)
    return joined.withColumn("q", F.col("q").withField("kept", kept)).drop("q_stratum", "q_limits")


def op3_quality_rules(spark, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document.

    Texts are measured once; the small table of measures is written, as the cutoffs
    and the verdicts both read it. Repeated rows are judged each by itself.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    measured = stage(measure(docs).select("doc_id", "q"))
    cutoffs = stage(fit_cutoffs(measured, table(spark, sf_dir, "labels")))
    return judge(measured, cutoffs).select(
        "doc_id", *[f"q.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")])


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, columns as they came.

    Texts are measured twice, for the cutoffs and for the verdicts: only measures meet the labels, and no
    text moves or is written however many labels there are.
    """
    measured = stage(measure(docs.select("doc_id", "text", "lang")).select("doc_id", "q"))
    cutoffs = stage(fit_cutoffs(measured, labels))
    aside = Aside(docs, "doc_id", "text", "lang")
    return aside.back(judge(measure(aside.rows), cutoffs).where("q.kept"))
