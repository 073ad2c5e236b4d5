"""Quarantine rules per source.

Order dates are judged by shape (`2023-13-01` passes), customer and transaction dates by
whether they parse; this difference is part of the rules.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace import vocab
from millrace.functions import has_shape, outside_domain, parse_date, to_double
from millrace.operators.checks import union_all
from millrace.operators.quarantine import Rule, broken_rules, quarantine, summarize


def _missing(name: str):
    return lambda: F.col(name).isNull()


def _unread(name: str, read):
    return lambda: F.col(name).isNotNull() & read(F.col(name)).isNull()


def _not_in(name: str, domain):
    return lambda: outside_domain(F.col(name), domain)


def _customer_date(c: Column) -> Column:
    return parse_date(c, vocab.CUSTOMER_DATE_FORMATS)


def _transaction_date(c: Column) -> Column:
    return parse_date(c, vocab.TRANSACTION_DATE_FORMATS)


def order_date_misshapen() -> Column:
    date = F.col("order_date")
    return date.isNotNull() & ~has_shape(date, vocab.ORDER_DATE_SHAPES)


def _rule(number: int, broken) -> Rule:
    return Rule(number, vocab.REASONS[number], broken)


RULES = {
    "customers": (
        _rule(1, lambda: to_double(F.col("customer_id")).isNull()),
        _rule(2, _unread("signup_date", _customer_date)),
        _rule(3, _not_in("status", vocab.CUSTOMER_STATUS)),
    ),
    "orders": (
        _rule(4, _missing("order_id")),
        _rule(5, _missing("customer_id")),
        _rule(6, order_date_misshapen),
        _rule(7, _not_in("status", vocab.ORDER_STATUS)),
    ),
    "transactions": (
        _rule(8, _missing("transaction_id")),
        _rule(9, _unread("transaction_date", _transaction_date)),
        _rule(10, _not_in("payment_method", vocab.PAYMENT_METHOD)),
        _rule(11, _not_in("success_flag", vocab.SUCCESS_FLAG)),
    ),
    "products": (
        _rule(12, _missing("product_id")),
        _rule(13, _unread("unit_price", to_double)),
        _rule(14, _missing("category")),
    ),
}


def quarantine_source(df: DataFrame, source: str, rejected_at: str) -> DataFrame:
    return quarantine(df, RULES[source], vocab.SOURCE_FILES[source], rejected_at)


def quarantine_all(bronze: dict, rejected_at: str) -> DataFrame:
    return union_all([quarantine_source(df, source, rejected_at) for source, df in bronze.items()])


def quarantine_summary(bronze: dict) -> DataFrame:
    columns = ["_file", "_rule", "_first"]
    broken = union_all(
        [
            broken_rules(df, RULES[source], vocab.SOURCE_FILES[source]).select(columns)
            for source, df in bronze.items()
        ]
    )
    return summarize(broken, {vocab.SOURCE_FILES[s]: RULES[s] for s in bronze})
