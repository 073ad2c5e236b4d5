"""Tolerant date parsing.

A format becomes one regular expression that rewrites matching text to ISO, which the
built-in date cast then reads. That takes one- or two-digit days and months and
surrounding whitespace. Month 13 or day 32 already fails the expression: a formatter, and
the cast too, would raise and catch an exception for each such value, which costs far more
than the rest of the row.
"""

import re
from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace import vocab

_FIELDS = {
    "%Y": r"(?!0+(?!\d))(?<year>\d{1,4})",
    "%m": r"(?<month>0?[1-9]|1[0-2])",
    "%d": r"(?<day>0?[1-9]|[12]\d|3[01])",
}


def _parse_one(c: Column, date_format: str) -> Column:
    parts = re.split(r"(%[Ymd])", date_format)
    body = "".join(_FIELDS.get(part) or re.escape(part) for part in parts)
    pattern = rf"\A\s*{body}\s*\z"
    # The date cast wants four to seven year digits, so `23` is read as year 0023.
    iso = F.regexp_replace(c, pattern, "000${year}-${month}-${day}")
    # Most texts are ruled out by their separator alone.
    separators = {part for part in parts if part and part not in _FIELDS}
    likely = reduce(and_, [F.contains(c, F.lit(s)) for s in sorted(separators)])
    return F.when(likely & c.rlike(pattern), iso.try_cast("date"))


def parse_date(c: Column, formats) -> Column:
    """The first of the formats (`%Y`, `%m`, `%d` and separators) that reads the text, else NULL."""
    return F.coalesce(*[_parse_one(c, f) for f in formats])


def parse_order_date(c: Column) -> Column:
    """Order dates: year first with either separator, then day/month, then month/day."""
    dashed = F.replace(c, F.lit("/"), F.lit("-"))
    return F.coalesce(_parse_one(dashed, "%Y-%m-%d"), parse_date(c, vocab.ORDER_SLASH_FORMATS))


def has_shape(c: Column, shapes) -> Column:
    """True when the whole text matches one of the shapes; says nothing about the date existing."""
    return c.rlike(r"\A(?:" + "|".join(shapes) + r")\z")
