"""Hand inputs for the decoding rules."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from daybook.functions import decode as D
from daybook.functions import fields as E


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


CASES = [
    ("date", "20200401", dt.date(2020, 4, 1)), ("date", "2020041", None), ("date", "", None),
    ("date", "2020-04-01", dt.date(2020, 4, 1)), ("date", "20201341", None), ("date", None, None),
    ("amount", "-5.00", Decimal("-5.00")), ("amount", "abc", Decimal("0.00")),
    ("amount", "", Decimal("0.00")), ("amount", None, Decimal("0.00")),
    ("amount", "$ 100 @ 70/$ = 7000.00", Decimal("7000.00")), ("amount", "1,234", Decimal("1.00")),
    ("amount", "(-)12.5", Decimal("-12.50")), ("amount", "1e3", Decimal("1000.00")),
    ("amount", " .5", Decimal("0.50")), ("amount", "12.", Decimal("12.00")),
    ("quantity", " 12 Nos", Decimal("12.0000")), ("quantity", "x", Decimal("0.0000")),
    ("rate", "70.00/Kg", Decimal("70.0000")), ("rate", "1 = 70/Kg", Decimal("70.0000")),
    ("rate", "", Decimal("0.0000")),
    ("days", "30 Days", 30), ("days", "30 days", 0), ("days", "", 0), ("days", "30  Days", 0),
    ("logical", "Yes", 1), ("logical", "No", 0), ("logical", "", 0), ("logical", None, 0),
    ("percent", "18.5", Decimal("18.5000")),
    ("text", "a\tb&amp;c&lt;&quot;", 'ab&c<"'), ("text", None, ""), ("text", "&#65;&#2350;x&#;", "Aमx&#;"),
    ("text", "&amp;lt;", "<"),
]


@pytest.mark.parametrize("kind,raw,expected", CASES)
def test_decode(spark, kind, raw, expected):
    assert one(spark, D.decode(kind, F.lit(raw).cast("string"))) == expected


@pytest.mark.parametrize("raw,expected", [
    ("1-Apr-20", dt.date(2020, 4, 1)), ("1-Apr-85", dt.date(1985, 4, 1)),
    ("31-Dec-71", dt.date(2071, 12, 31)), ("1-Jan-72", dt.date(1972, 1, 1))])
def test_short_dates(spark, raw, expected):
    assert one(spark, D.short_date(F.lit(raw))) == expected


def test_foreign_amounts(spark):
    raw = F.lit("-$ 100 @ 70/$ = -Rs 7000")
    assert one(spark, D.foreign_amount(raw)) == Decimal("-100.00")
    assert one(spark, D.currency_symbol(raw)) == "$"
    assert one(spark, D.foreign_amount(F.lit("7000"))) == Decimal("0.00")
    assert one(spark, D.currency_symbol(F.lit("7000"))) == ""


def test_signs(spark):
    assert one(spark, D.signed_amount(F.lit("5"), F.lit(True))) == Decimal("-5.00")
    assert one(spark, D.signed_amount(F.lit("(-)5"), F.lit(False))) == Decimal("5.00")
    assert one(spark, D.signed_quantity(F.lit(12), F.lit(False))) == -12


def test_readable(spark):
    assert not one(spark, D.readable("amount", F.lit("abc")))
    assert not one(spark, D.readable("date", F.lit("2020041")))
    assert one(spark, D.readable("days", F.lit("3 Days")))


def test_export_text(spark):
    raw = "<ENVELOPE>\r\n<FLDBLANK></FLDBLANK>a\tb &amp; c&#4;&tab;</ENVELOPE>"
    assert one(spark, D.export_text(F.lit(raw))) == "a b & c"


def test_field_expressions(spark):
    assert one(spark, E.blank_root(F.lit("Primary"))) == ""
    assert one(spark, E.blank_root(F.lit("\u0004 Primary"))) == ""
    assert one(spark, E.blank_root(F.lit("Primary Stock"))) == "Primary Stock"
    assert one(spark, E.blank_not_applicable(F.lit("\u0004 Not Applicable"))) == ""
    assert one(spark, E.replace_first(F.lit("a-b-c"), "-", "+")) == "a+b-c"
    assert one(spark, E.replace_first(F.lit("abc"), "-", "+")) == "abc"
    entries = F.array(F.struct(F.lit("x").alias("f")), F.struct(F.lit("y").alias("f")))
    assert one(spark, E.first_or_last_of(F.lit(""), entries, "f")) == "y"
    assert one(spark, E.nth(entries, 3)) is None
    assert one(spark, E.formatted("%s %s", F.lit(""), F.lit("+91"), F.lit(""))) == ""
