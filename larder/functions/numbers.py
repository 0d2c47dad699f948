"""Numbers out of dirty text, and rounding that agrees with the reports.

The parsers mention their argument several times. Give them a column, not a long
expression: ``with_quantity`` shows how to lay the steps out.
"""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder import defaults
from larder.functions.steps import Steps, apply_steps
from larder.functions.text import strip_ws

# try_cast alone would also take '5d', '5f' and '0x1p3'.
_DECIMAL = r"^[+-]?(\d+(\.\d*)?|\.\d+)(e[+-]?\d+)?$"
_DIGITS = r"^\d{1,15}$"
_INFINITE = r"^[+-]?inf(inity)?$"
_NOT_A_NUMBER = r"^[+-]?nan$"
_FIRST_NUMBER = r"(\d+[.,]?\d*)"
# 1_000 is a number, 1__0 and _1 are not: only a '_' between digits may go.
_SEPARATOR = r"(?<=\d)_(?=\d)"


def prepare(col: Column) -> Column:
    """Lower case without outer blanks, as the parsers below want it."""
    return F.lower(strip_ws(col))


def is_finite(number: Column) -> Column:
    return (F.abs(number) < float("inf")) & ~F.isnan(number)


def nan_to_null(number: Column) -> Column:
    """NaN sorts above every number in Spark, so it must not reach a comparison."""
    return F.when(~F.isnan(number), number)


def parse_float(prepared: Column) -> Column:
    """The double written in the text; infinities and NaN are kept, junk is null."""
    plain = F.regexp_replace(prepared, _SEPARATOR, "")
    infinity = F.when(prepared.startswith("-"), float("-inf")).otherwise(float("inf"))
    return (
        F.when(prepared.rlike(_DECIMAL), prepared.try_cast("double"))
        .when(prepared.contains("_"), F.when(plain.rlike(_DECIMAL), plain.try_cast("double")))
        .when(prepared.rlike(_INFINITE), infinity)
        .when(prepared.rlike(_NOT_A_NUMBER), float("nan"))
    )


def quantity_number(prepared: Column) -> Column:
    """Layer 1: the whole text is a number, with ',' or '.' as decimal mark.

    Signed, and with infinities and NaN, so that a caller can tell a refund from
    junk.
    """
    return parse_float(F.translate(prepared, ",", "."))


def quantity_word(prepared: Column, words: Mapping[str, int] = defaults.NUMBER_WORDS) -> Column:
    """Layer 2: the whole text is a number word."""
    pairs = ", ".join(f"'{word}', {n}D" for word, n in words.items())
    return F.try_element_at(F.expr(f"map({pairs})"), prepared)


def quantity_in_text(prepared: Column) -> Column:
    """Layer 3: the first unsigned number anywhere in the text."""
    found = F.regexp_extract(prepared, _FIRST_NUMBER, 1)
    number = F.translate(found, ",", ".").try_cast("double")
    return F.when(F.abs(number) < float("inf"), number)


def quantity_steps(
    source: str,
    target: str,
    negative: str,
    words: Mapping[str, int] = defaults.NUMBER_WORDS,
) -> Steps:
    written, text, number = F.col(source), F.col("_q_text"), F.col("_q_number")
    quantity = (
        F.when(text.isNull(), written.try_cast("bigint").cast("double"))
        .when(text.isin(*defaults.QUANTITY_BLANKS), None)
        .when(number.isNotNull(), F.when(is_finite(number) & (number >= 0), number))
        .otherwise(F.coalesce(quantity_word(text, words), quantity_in_text(text)))
    )
    return [
        # Most rows are plain digits: they have no text to work on.
        {"_q_text": F.when(~written.rlike(_DIGITS), prepare(written))},
        {"_q_point": F.translate(text, ",", ".")},
        {"_q_number": parse_float(F.col("_q_point"))},
        {target: quantity, negative: F.coalesce(number < 0, F.lit(False))},
    ]


def with_quantity(
    df: DataFrame,
    source: str = "Quantity",
    target: str = "Quantity_Clean",
    negative: str = "is_negative",
    words: Mapping[str, int] = defaults.NUMBER_WORDS,
) -> DataFrame:
    """Add the quantity (>= 0 or null), and whether the text is a number below 0.

    A text that is a number in whole never falls through to the later layers:
    layer 3 would read a sale of 7 out of the refund '-7'.
    """
    return apply_steps(df, quantity_steps(source, target, negative, words))


def round_whole(number: Column) -> Column:
    """Nearest whole number, ties to the even one."""
    return F.rint(number)


def round_tenths(number: Column) -> Column:
    """One decimal, ties to even, decided on the exact binary value.

    0.35 is stored a little below 0.35 and so gives 0.3, where rounding its
    decimal text would give 0.4. Ten times the number is the sum of 8x and 2x,
    both exact, so the part that the sum lost can be recovered and used to break
    what only looks like a tie.
    """
    high, low = number * 8.0, number * 2.0
    ten = high + low
    back = ten - high
    lost = (high - (ten - back)) + (low - back)
    floor = F.floor(ten).cast("double")
    tie = (ten - floor) == 0.5
    whole = F.when(tie & (lost < 0), floor).when(tie & (lost > 0), floor + 1.0).otherwise(F.rint(ten))
    return whole / 10.0
