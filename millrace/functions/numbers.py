"""Lenient number parsing. Bad text becomes NULL, never an error (ANSI mode is on by default)."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Java also reads `1.0d`, `1f` and hex floats as numbers; plain decimals only are wanted,
# with single underscores allowed between digits.
_DIGITS = r"\d+(?:_\d+)*"
_DECIMAL = rf"(?:{_DIGITS}\.?(?:{_DIGITS})?|\.{_DIGITS})(?:e[+-]?{_DIGITS})?"
_NUMBER = rf"(?i)\A\s*[+-]?(?:{_DECIMAL}|nan|inf|infinity)\s*\z"


def to_double(c: Column) -> Column:
    return F.when(c.rlike(_NUMBER), F.replace(c, F.lit("_"), F.lit("")).try_cast("double"))


def _plain_int(c: Column) -> Column:
    """The usual spellings `17` and `17.0`, without a regular expression; else NULL.

    `17.0` is read as 170 tenths: dropping the tail instead would accept `17 .0`.
    """
    tenths = F.concat(F.left(c, F.length(c) - 2), F.lit("0")).try_cast("bigint")
    return F.when(F.endswith(c, F.lit(".0")), (tenths / 10).try_cast("int")).otherwise(
        c.try_cast("int")
    )


def to_id(c: Column) -> Column:
    """Text such as `17.0` to int: through double, half to even, NULL when out of range."""
    return F.coalesce(_plain_int(c), F.rint(to_double(c)).try_cast("int"))


def to_int(c: Column) -> Column:
    """Text to int directly: a fraction rounds half away from zero."""
    return F.coalesce(_plain_int(c), F.round(to_double(c)).try_cast("int"))


def parse_currency(c: Column) -> Column:
    """`R 1777`, `R1269,89`, `4585` to double: leading R dropped, comma read as the decimal point."""
    amount = F.regexp_replace(F.trim(c), r"^R\s*", "")
    return to_double(F.replace(amount, F.lit(","), F.lit(".")))
