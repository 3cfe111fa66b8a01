"""Null, tie, zero and bad-text cases of the column functions."""

import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillwright.functions import bands, dates, money, text
from tillwright.functions.casting import parse_date, parse_flag, typed_columns
from tillwright.schemas import silver_types


def column(df, expression):
    return [row[0] for row in df.select(expression).collect()]


def test_text_cleaning(frame):
    df = frame("x string", ("  mary ANN  o'neil ",), ("",), (None,))
    assert column(df, text.proper_case(F.col("x"))) == ["Mary Ann  O'neil", "", None]
    assert column(df, text.clean_lower(F.col("x"))) == ["mary ann  o'neil", "", None]
    assert column(df, text.clean_upper(F.col("x"))) == ["MARY ANN  O'NEIL", "", None]


def test_name_and_email(frame):
    df = frame("first string, last string, n int", ("Wei", "Chen", 7))
    first, last = F.col("first"), F.col("last")
    assert column(df, text.full_name(first, last)) == ["Wei Chen"]
    assert column(df, text.email_address(first, last, F.col("n"))) == ["wei.chen7@email.com"]


def test_flags_of_bad_text_are_null(frame):
    df = frame("x string", ("Y",), ("N",), ("y",), ("maybe",), (None,))
    assert column(df, parse_flag(F.col("x"))) == [True, False, True, None, None]


def test_dates_of_bad_text_are_null(frame):
    df = frame("x string", ("2024-02-29",), ("2023-02-29",), ("29/02/2024",), (None,))
    assert column(df, parse_date(F.col("x"))) == [datetime.date(2024, 2, 29), None, None, None]


def test_typed_columns_turn_bad_text_into_null(frame):
    types = {k: v for k, v in silver_types("item_dim").items() if k in ("item_id", "unit_price")}
    df = frame("item_id string, unit_price string", ("3", "9.99"), ("x", "free"))
    rows = df.withColumns(typed_columns(df, types)).collect()
    assert [tuple(r) for r in rows] == [(3, Decimal("9.99")), (None, None)]


@pytest.mark.parametrize(
    ("age", "label"),
    [(5, "18-24"), (24, "18-24"), (25, "25-34"), (34, "25-34"), (35, "35-44"), (54, "45-54"),
     (55, "55+"), (None, "55+")],
)
def test_age_band(frame, age, label):
    assert column(frame("age int", (age,)), bands.age_band(F.col("age"))) == [label]


@pytest.mark.parametrize(
    ("price", "label"),
    [("24.99", "Budget"), ("25", "Mid-Range"), ("99.99", "Mid-Range"), ("100", "Premium"),
     ("300", "Luxury"), (None, "Luxury")],
)
def test_price_band(frame, price, label):
    df = frame("p decimal(18,2)", (None if price is None else Decimal(price),))
    assert column(df, bands.price_band(F.col("p"))) == [label]


@pytest.mark.parametrize(
    ("orders", "spend", "recency", "label"),
    [
        (5, 500.0, 999, "Champion"),
        (5, 499.99, 60, "Loyal"),
        (3, 10.0, 61, "Regular"),
        (2, 9999.0, 60, "Regular"),
        (3, 10.0, 180, "Regular"),
        (3, 10.0, 181, "At Risk"),
        (5, 500.0, None, "Champion"),
        (3, 10.0, None, "Regular"),
    ],
)
def test_customer_segment(frame, orders, spend, recency, label):
    df = frame("o int, s double, r int", (orders, spend, recency))
    segment = bands.customer_segment(F.col("o"), F.col("s"), F.col("r"), bands.SegmentThresholds())
    assert column(df, segment) == [label]


def test_half_up_goes_by_decimal_digits(frame):
    df = frame("x double", (2.345,), (1.005,), (-2.5,), (0.125,), (None,), (42.62499999999999,))
    assert column(df, money.half_up(F.col("x"), 2)) == [2.35, 1.01, -2.5, 0.13, None, 42.62]


def test_percent_of_zero_is_null(frame):
    df = frame("a decimal(18,2), b decimal(18,2)", (Decimal(1), Decimal(0)), (Decimal(1), Decimal(3)))
    assert column(df, money.percent(F.col("a"), F.col("b"))) == [None, 33.33]


def test_margin_of_a_free_item_is_null(frame):
    df = frame("p decimal(18,2), c decimal(18,2)",
               (Decimal("0"), Decimal("1")), (Decimal("80"), Decimal("46.89")))
    assert column(df, money.margin_percent(F.col("p"), F.col("c"))) == [None, 41.39]


def test_price_line_rounds_each_step(frame):
    df = frame("p decimal(18,4), q int, d decimal(9,4)", (Decimal("8.99"), 3, Decimal("0.15")))
    amounts = money.price_line(F.col("p"), F.col("q"), F.col("d"))
    row = df.select(*[c.alias(n) for n, c in amounts.items()]).first().asDict()
    assert row == {
        "gross_amount": Decimal("26.97"),
        "discount_amount": Decimal("4.05"),
        "net_amount": Decimal("22.92"),
        "tax_amount": Decimal("1.83"),
        "total_amount": Decimal("24.75"),
    }


def test_line_profit_uses_the_cost_factor(frame):
    df = frame("n decimal(18,2), q int, p decimal(18,4)", (Decimal("20.00"), 2, Decimal("10")))
    args = F.col("n"), F.col("q"), F.col("p")
    assert column(df, money.line_profit(*args)) == [Decimal("9.00")]
    assert column(df, money.line_profit(*args, "0.9")) == [Decimal("2.00")]


def test_line_profit_is_exact_for_factors_of_four_digits(frame):
    df = frame("n decimal(18,2), q int, p decimal(18,4)", (Decimal("0.00"), 1, Decimal("1.6129")))
    args = F.col("n"), F.col("q"), F.col("p")
    assert column(df, money.line_profit(*args, "0.0031")) == [Decimal("0.00")]
    assert column(df, money.line_profit(*args, "0.0032")) == [Decimal("-0.01")]


def test_calendar_expressions(frame):
    day = datetime.date(2022, 1, 1)
    df = frame("d date", (day,))
    d = F.col("d")
    assert column(df, dates.date_key(d)) == [20220101]
    assert column(df, dates.iso_weekday(d)) == [6]
    assert column(df, dates.is_weekend(d)) == [True]
    assert column(df, dates.is_fixed_holiday(d)) == [True]
    assert column(df, dates.fiscal_quarter(d)) == ["FY2022Q1"]
    assert column(df, F.weekofyear(d)) == [52]
    assert column(df, dates.years_since(d, dates.as_of_date("2024-07-01"))) == [2.5]
    assert column(df, dates.as_of_date(None)) == [datetime.date.today()]
