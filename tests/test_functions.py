"""Literal tests of the column expressions."""

import datetime
import math

import pytest
from pyspark.sql import functions as F

from millrace import functions as fn
from millrace import vocab


def apply(spark, convert, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    out = df.select("i", convert(F.col("t")).alias("v")).orderBy("i").collect()
    return [r.v for r in out]


def check(spark, convert, cases):
    got = apply(spark, convert, list(cases))
    assert dict(zip(cases, got)) == cases


def date(y, m, d):
    return datetime.date(y, m, d)


IDS = {
    "1.0": 1,
    "1": 1,
    "1.5": 2,
    "2.5": 2,
    "-1.5": -2,
    ".5": 0,
    "5.": 5,
    "1e3": 1000,
    " 7 ": 7,
    "1.0d": None,
    "1f": None,
    "NaN": None,
    "inf": None,
    "3000000000": None,
    "2147483647": 2147483647,
    "2147483647.6": None,
    "-2147483648": -2147483648,
    "0x10": None,
    "1_000": 1000,
    "17.0": 17,
    "-17.0": -17,
    "17 .0": None,
    ".0": 0,
    "3000000000.0": None,
    "99999999999999999999.0": None,
    "1__0": None,
    "_1": None,
    "1_": None,
    "1,000": None,
    "abc": None,
    "": None,
    " ": None,
    None: None,
}


def test_to_id(spark):
    check(spark, fn.to_id, IDS)


def test_to_int_rounds_half_away_from_zero(spark):
    check(
        spark,
        fn.to_int,
        {"1.0": 1, "5.": 5, "1e3": 1000, "2.5": 3, ".5": 1, "-2.5": -3, "x": None, "": None, None: None},
    )


def test_to_double(spark):
    check(
        spark,
        fn.to_double,
        {
            "846": 846.0,
            "684.2153390335731": 684.2153390335731,
            "-0.5": -0.5,
            "+3": 3.0,
            "1E-2": 0.01,
            "\t4 ": 4.0,
            "Infinity": math.inf,
            "-inf": -math.inf,
            "invalid": None,
            "1.2.3": None,
            "1.0D": None,
            "1.0F": None,
            "0x1p3": None,
            "--1": None,
            "e5": None,
            "": None,
            None: None,
        },
    )
    assert math.isnan(apply(spark, fn.to_double, ["nan"])[0])


def test_parse_currency(spark):
    check(
        spark,
        fn.parse_currency,
        {
            "R 1777": 1777.0,
            "R1711,55": 1711.55,
            "3608": 3608.0,
            "R -200": -200.0,
            "  R 5 ": 5.0,
            "R\t5": 5.0,
            "r 12": None,
            "R1.234,56": None,
            "RR5": None,
            "12 R": None,
            "-R5": None,
            "1,234.50": None,
            "R": None,
            "": None,
            None: None,
        },
    )


DAY_FIRST = {
    "2023-01-05": date(2023, 1, 5),
    "2023-1-5": date(2023, 1, 5),
    " 2023-01-05 ": date(2023, 1, 5),
    "\t2023-01-05": date(2023, 1, 5),
    "2024-02-29": date(2024, 2, 29),
    "23-01-05": date(23, 1, 5),
    "2023-02-29": None,
    "2023-13-01": None,
    "2023-02-30": None,
    "2023/01/05": None,
    "13/12/2022": date(2022, 12, 13),
    "05/06/2022": date(2022, 6, 5),
    "5/6/2022": date(2022, 6, 5),
    "12/13/2022": None,
    "2023-01-05 10:00:00": None,
    "2023-01-05T10:00:00": None,
    "12023-01-01": None,
    "2023-001-05": None,
    "0000-01-01": None,
    "2023-00-10": None,
    "invalid_date": None,
    "": None,
    None: None,
}


def test_transaction_dates(spark):
    check(spark, lambda c: fn.parse_date(c, vocab.TRANSACTION_DATE_FORMATS), DAY_FIRST)


def test_customer_dates_also_take_month_day_year(spark):
    cases = DAY_FIRST | {"03-02-1997": date(1997, 3, 2), "13-02-1997": None, "3-2-97": date(97, 3, 2)}
    cases["23-01-05"] = date(23, 1, 5)
    check(spark, lambda c: fn.parse_date(c, vocab.CUSTOMER_DATE_FORMATS), cases)


def test_order_dates(spark):
    check(
        spark,
        fn.parse_order_date,
        {
            "2023-01-05": date(2023, 1, 5),
            "2023/01/05": date(2023, 1, 5),
            "2023/01-05": date(2023, 1, 5),
            "05/06/2022": date(2022, 6, 5),
            "13/12/2022": date(2022, 12, 13),
            "12/13/2022": date(2022, 12, 13),
            "13/13/2022": None,
            "2023-13-01": None,
            "03-02-1997": None,
            "invalid_date": None,
            None: None,
        },
    )


def test_shape_is_not_validity(spark):
    check(
        spark,
        lambda c: fn.has_shape(c, vocab.ORDER_DATE_SHAPES),
        {
            "2023-13-01": True,
            "2023/01/05": True,
            "99/99/2022": True,
            "2023-1-5": False,
            "2023-01-05\n": False,
            " 2023-01-05": False,
            "invalid_date": False,
            "": False,
            None: None,
        },
    )


@pytest.mark.parametrize(
    ("name", "first", "last"),
    [
        ("Ann", "Ann", None),
        ("Ann Lee", "Ann", "Lee"),
        ("Ann  Lee Ray", "Ann", "Lee Ray"),
        (" Ann Lee", "", "Ann Lee"),
        (" ", "", ""),
        ("", "", None),
        ("Ann ", "Ann", ""),
        (None, None, None),
    ],
)
def test_split_names(spark, name, first, last):
    assert apply(spark, fn.first_name, [name]) == [first]
    assert apply(spark, fn.last_name, [name]) == [last]


def test_sentence_case(spark):
    check(
        spark,
        fn.sentence_case,
        {
            "electronics": "Electronics",
            "HOME": "Home",
            "home and living": "Home and living",
            "  toys ": "Toys",
            "x": "X",
            "": "",
            "  ": "",
            None: None,
        },
    )


def test_trim_lower_and_blank(spark):
    check(spark, fn.conform_lower, {"  A@X.COM ": "a@x.com", "": "", None: None})
    check(spark, fn.conform_text, {"  a b ": "a b", "\ta": "\ta", None: None})
    check(spark, fn.blank_to_null, {" SUP2": "SUP2", "  ": None, "": None, None: None})


@pytest.mark.parametrize(
    "mapping",
    [vocab.CUSTOMER_STATUS, vocab.ORDER_STATUS, vocab.PAYMENT_METHOD, vocab.SUCCESS_FLAG],
)
def test_map_values(spark, mapping):
    cases = dict(mapping)
    cases |= {f" {k.lower()} ": v for k, v in mapping.items()}
    cases |= {"maybe": None, "": None, None: None}
    check(spark, lambda c: fn.map_values(c, mapping), cases)


def test_outside_domain(spark):
    check(
        spark,
        lambda c: fn.outside_domain(c, vocab.ORDER_STATUS),
        {" done ": False, "lost": True, "": True, None: False},
    )


def test_row_json_keeps_nulls(spark):
    df = spark.createDataFrame([("1", None, 'a"b')], "a string, b string, c string")
    text = df.select(fn.row_json(df.columns).alias("j")).first().j
    assert text == '{"a":"1","b":null,"c":"a\\"b"}'
