"""Column expressions: text in, typed or conformed value out. No I/O, no UDF."""

from millrace.functions.dates import has_shape, parse_date, parse_order_date
from millrace.functions.numbers import parse_currency, to_double, to_id, to_int
from millrace.functions.text import (
    blank_to_null,
    conform_lower,
    conform_text,
    first_name,
    last_name,
    map_values,
    outside_domain,
    row_json,
    sentence_case,
)

__all__ = [
    "blank_to_null",
    "conform_lower",
    "conform_text",
    "first_name",
    "has_shape",
    "last_name",
    "map_values",
    "outside_domain",
    "parse_currency",
    "parse_date",
    "parse_order_date",
    "row_json",
    "sentence_case",
    "to_double",
    "to_id",
    "to_int",
]
