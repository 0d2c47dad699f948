"""One timestamp out of many spellings.

A text is rewritten as ISO text and then cast, which refuses impossible dates.
Nothing depends on the session time zone or on what other rows look like.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder import defaults
from larder.functions.steps import Steps, apply_steps
from larder.functions.text import strip_ws
from larder.operators.settle import apart

EARLIEST = "1677-09-21 00:12:44"
LATEST = "2262-04-11 23:47:16"

_ISO = r"^\d{4}-\d{2}-\d{2}([ T]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?)?(Z|[+-]\d{2}:\d{2})?$"
_CLOCK = r"(?:\s+(\d{1,2}:\d{2}(?::\d{2})?)(?:\s*([AaPp])[Mm])?)?$"
_DAY_AND_MONTH = r"^\d{1,2}[-/.]\d{1,2}[-/.](\d{4}|\d{2})(?!\d)"

# The spellings of each kind of beginning, and the ISO text they stand for. Day and month in digits come
# out month first here; the other reading swaps them later. A half-day mark stays at the end, and a year of
# two digits gets a mark in front.
NAME_FIRST = (r"^([A-Za-z]+)\s+(\d{1,2}),?\s+(\d{4})" + _CLOCK, "$3-$1-$2 $4$5")
DAY_AND_NAME = (r"^(\d{1,2})(?:-|\s+)([A-Za-z]+)(?:-|,?\s+)(\d{4})" + _CLOCK, "$3-$2-$1 $4$5")
YEAR_FIRST = (r"^(\d{4})([-/.])(\d{1,2})\2(\d{1,2})" + _CLOCK, "$1-$3-$4 $5$6")
TWO_NUMBERS = (r"^(\d{1,2})([-/.])(\d{1,2})\2(\d{4})" + _CLOCK, "$4-$1-$3 $5$6")
SHORT_YEAR = (r"^(\d{1,2})([-/.])(\d{1,2})\2(\d{2})" + _CLOCK, "@$4-$1-$3 $5$6")
# Digits alone, by the length of the text.
COMPACT = {
    (14, 15): (r"^(\d{4})(\d{2})(\d{2})T?(\d{2})(\d{2})(\d{2})$", "$1-$2-$3 $4:$5:$6"),
    (12,): (r"^(\d{4})(\d{2})(\d{2})(\d{2})(\d{2})$", "$1-$2-$3 $4:$5"),
    (8,): (r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3"),
}
_DIGITS, _UPPER, _LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_NAMED = r"^(\d{4})-([A-Za-z]+)-"
_SWAP = (r"^(\d{4})-(\d{1,2})-(\d{1,2})", "$1-$3-$2")
# The cast alone would take a bare year or a bare time of day.
_REWRITTEN = r"^\d{4}-\d{1,2}-\d{1,2}([ T]|$)"


def _month_number(name: Column) -> Column:
    spellings = {s: n for n, m in enumerate(defaults.MONTHS, start=1) for s in (m, m[:3])}
    spellings["sept"] = spellings["sep"]
    pairs = ", ".join(f"'{spelling}', '{n}'" for spelling, n in spellings.items())
    return F.try_element_at(F.expr(f"map({pairs})"), F.lower(name))


def shape(text: Column, upper: str = "A") -> Column:
    """The text with every digit as 9, every capital as ``upper`` and every small letter as a."""
    return F.translate(text, _DIGITS + _UPPER + _LOWER, "9" * 10 + upper * 26 + "a" * 26)


def _kind(text: Column) -> Column:
    """How a text begins, which leaves one or two spellings to try."""
    begin = shape(text.substr(1, 5), "a")
    numbers = [f"{day}{sep}9" for day in ("9", "99") for sep in "-/."]
    return (
        F.when(begin.startswith("a"), "name")
        .when(begin.startswith("99999"), "compact")
        .when(begin.startswith("9999"), "year")
        .when(F.substring(begin, 1, 3).isin(*numbers) | F.substring(begin, 1, 4).isin(*numbers), "numbers")
        .when(begin.startswith("9"), "day")
    )


def _as_iso(text: Column, kind: Column) -> Column:
    """ISO text of the spellings known, the text as it is else."""
    compact = text
    for lengths, rewrite in COMPACT.items():
        compact = F.when(F.length(text).isin(*lengths), F.regexp_replace(text, *rewrite)).otherwise(compact)
    return (
        F.when(kind == "name", F.regexp_replace(text, *NAME_FIRST))
        .when(kind == "compact", compact)
        .when(kind == "year", F.regexp_replace(text, *YEAR_FIRST))
        .when(kind == "numbers", F.regexp_replace(F.regexp_replace(text, *TWO_NUMBERS), *SHORT_YEAR))
        .when(kind == "day", F.regexp_replace(text, *DAY_AND_NAME))
        .otherwise(text)
    )


def _whole(iso: Column, kind: Column) -> Column:
    """Month names as numbers, and years of two digits as those from 1970 to 2069."""
    name = F.regexp_extract(iso, _NAMED, 2)
    century = F.when(F.substring(iso, 2, 1) <= "6", "20").otherwise("19")
    return (
        F.when(kind.isin("name", "day", "year") & iso.rlike(_NAMED), F.replace(iso, name, _month_number(name)))
        .when(iso.startswith("@") & (kind == "numbers"), F.concat(century, F.substring(iso, 2, 1 << 20)))
        .otherwise(iso)
    )


def _on_the_clock(stamp: Column, half: Column) -> Column:
    """Move a 12-hour time to where its half of the day puts it."""
    hour = F.hour(stamp)
    shift = F.when((half == "p") & (hour < 12), 12).when((half == "a") & (hour == 12), -12)
    moved = stamp + F.make_dt_interval(hours=F.coalesce(shift, F.lit(0)))
    return F.when(half == "", stamp).when(hour <= 12, moved)


def timestamp_steps(
    source: str,
    target: str,
    day_first: bool = True,
    earliest: str = EARLIEST,
    latest: str = LATEST,
) -> Steps:
    written, text, kind, iso, half = (F.col(c) for c in (source, "_t_text", "_t_kind", "_t_iso", "_t_half"))
    plain, one, two = (F.col(c) for c in ("_t_plain", "_t_one", "_t_two"))
    other = F.when((kind == "numbers") & text.rlike(_DAY_AND_MONTH), F.regexp_replace(plain, *_SWAP))
    both = F.coalesce(one, two)
    if day_first:
        prefer_day = text.contains("/") & (half == "") & two.isNotNull()
        both = F.when(prefer_day, two).otherwise(both)
    low, high = (F.lit(x).cast("timestamp_ntz") for x in (earliest, latest))
    as_is = F.when(text.isNull(), written.try_cast("timestamp_ntz"))
    return [
        # Most rows are ISO already: they have no text to work on.
        {"_t_text": F.when(~written.rlike(_ISO), strip_ws(written))},
        {"_t_kind": _kind(text)},
        # Apart, as the steps together are more than the JVM compiles in one method.
        {"_t_iso": _as_iso(text, kind), "_t_text": apart(text)},
        {"_t_iso": _whole(iso, kind)},
        {
            "_t_half": F.when(F.lower(F.right(iso, F.lit(1))).isin("a", "p"), F.lower(F.right(iso, F.lit(1)))).otherwise(F.when(iso.isNotNull(), "")),
            "_t_plain": F.when(iso.rlike(_REWRITTEN), F.rtrim(iso, F.lit("AaPp"))),
        },
        {"_t_one": plain.try_cast("timestamp_ntz"), "_t_two": other.try_cast("timestamp_ntz")},
        {"_t_one": both},
        {"_t_one": F.coalesce(as_is, _on_the_clock(one, half))},
        {target: F.when(one.between(low, high), one)},
    ]


def with_timestamp(
    df: DataFrame, source: str = "DateTime", target: str = "DateTime_Parsed", **options
) -> DataFrame:
    """Add the timestamp_ntz that ``source`` spells, or null.

    ``day_first`` settles 24-hour slash dates: d/M, and M/d only where that is
    impossible. All other digit dates read month first and turn to day first where
    that is impossible. Offsets are dropped and the wall clock is kept. Times
    outside ``earliest`` to ``latest`` are null.
    """
    return apply_steps(df, timestamp_steps(source, target, **options))


def date_class(text: Column) -> Column:
    """Name of the spelling class of a trimmed text: '' is EMPTY, no match is OTHER.

    Classes are told by the shape of the text: digits as 9, capitals as A, small
    letters as a, white space as one blank.
    """
    blanks = F.translate(text, "\t\n\x0b\f\r", " " * 5)
    spaced = F.when(blanks.contains("  "), F.regexp_replace(blanks, " +", " ")).otherwise(blanks)
    begin = shape(spaced.substr(1, 19))
    iso, slashes, month, compact, half_day = defaults.DATE_CLASSES
    return (
        F.when(text == "", "EMPTY")
        .when(begin.startswith("9999-99-99 99:99:99"), iso)
        .when(begin.startswith("99/99/9999"), slashes)
        .when(begin.startswith("Aaa 9 9999") | begin.startswith("Aaa 99 9999"), month)
        .when(begin.startswith("9" * 12), compact)
        .when(begin.startswith("99-99-9999 99:99 AA") & spaced.substr(18, 2).isin("AM", "PM"), half_day)
        .otherwise("OTHER")
    )
