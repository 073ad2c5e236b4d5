"""Text conforming. `trim` removes spaces only."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def conform_text(c: Column) -> Column:
    return F.trim(c)


def conform_lower(c: Column) -> Column:
    return F.lower(F.trim(c))


def first_name(c: Column) -> Column:
    """Text before the first space, or all of it; a leading space gives ''."""
    return F.trim(F.substring_index(c, " ", 1))


def last_name(c: Column) -> Column:
    """Text after the first space, NULL when there is none."""
    space = F.instr(c, " ")
    return F.when(space > 0, F.trim(F.substr(c, space + 1)))


def sentence_case(c: Column) -> Column:
    """First character upper, rest lower (`initcap` would raise every word)."""
    text = F.trim(c)
    return F.concat(F.upper(F.left(text, F.lit(1))), F.lower(F.substr(text, F.lit(2))))


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def _normal(c: Column) -> Column:
    return F.upper(F.trim(c))


def map_values(c: Column, mapping: dict) -> Column:
    """Spelling to conformed value, NULL when unknown. The literal map is folded once per plan."""
    pairs = [F.lit(x) for pair in mapping.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), _normal(c))


def outside_domain(c: Column, domain) -> Column:
    """Set, but no accepted spelling. The empty string is outside; NULL is not."""
    return c.isNotNull() & ~_normal(c).isin(*domain)


def row_json(columns) -> Column:
    """A whole row as one JSON text, nulls kept."""
    return F.to_json(F.struct(*[F.col(c) for c in columns]), {"ignoreNullFields": "false"})
