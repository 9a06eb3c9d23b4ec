"""Cleaning, labels, periods and name text."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from basketry.functions import clean, labels, names, periods


def apply(spark, values, function, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(function(F.col("v"))).collect()]


def pair(spark, current, previous, function):
    df = spark.createDataFrame([(float(current), None if previous is None else float(previous))], "c double, p double")
    return df.select(function("c", "p")).first()[0]


@pytest.mark.parametrize("value, expected", [
    ("100.5", 100.5), ("200.0", 200.0), ("23.5%", 23.5), ("10%", 10.0), ("0%", 0.0), ("-5.5", -5.5), ("-10%", -10.0),
    ("N/A", None), ("unknown", None), ("", None), ("42", 42.0), ("0.0", 0.0), (".5", 0.5), ("-.5", -0.5),
    ("1-2", None), ("1e5", None), ("1.2.3", None), (None, None)])
def test_clean_numeric(spark, value, expected):
    assert apply(spark, [value], clean.clean_numeric) == [expected]


@pytest.mark.parametrize("current, previous, label", [
    (120, 100, "+20.0%"), (80, 100, "-20.0%"), (100, 100, "+0.0%"), (100, 0, None), (300, 100, "+200.0%"),
    (0, 100, "-100.0%"), (101.5, 100, "+1.5%"), (0, 0, None)])
def test_change_labels(spark, current, previous, label):
    assert pair(spark, current, previous, lambda c, p: labels.pct_label(labels.pct_change(c, p))) == label


@pytest.mark.parametrize("current, average, arrow", [
    (110, 100, "🡅 (10.0%)"), (90, 100, "🡇 (-10.0%)"), (100, 100, "→ (0.0%)"), (5, 0, "→ (0%)"), (5, None, "→ (0%)")])
def test_trend_arrow(spark, current, average, arrow):
    assert pair(spark, current, average, labels.trend_arrow) == arrow


def test_monthly_zero_label(spark):
    assert pair(spark, 5, 0, lambda c, p: labels.trend_arrow(c, p, labels.NOT_AVAILABLE_LABEL)) == "→ (N/A)"


def test_sales_label(spark):
    assert pair(spark, 12345, 11973.8, lambda c, p: labels.sales_label(c, labels.trend_arrow(c, p))) == "12,345.00 🡅 (3.1%)"


@pytest.mark.parametrize("text, day", [
    ("2024-03-04", dt.date(2024, 3, 4)), ("04-03-2024", dt.date(2024, 3, 4)), ("03/04/2024", dt.date(2024, 3, 4)),
    ("25/12/2024", dt.date(2024, 12, 25)), ("2024/03/04", dt.date(2024, 3, 4)), ("2024-3-4", dt.date(2024, 3, 4)),
    ("13/13/2024", None), ("2024-02-30", None), ("not-a-date", None), ("2024-03-04 10:00", None), (None, None)])
def test_order_date(spark, text, day):
    assert apply(spark, [text], clean.parse_order_date) == [day]


def test_numbers_in_text(spark):
    values = ["3.7", "-3.7", "8901234567890123", "abc", None, "nan", "inf", "1e3", "5d", " 7 "]
    assert apply(spark, values, clean.coerce_bigint) == [3, -3, 8901234567890123, None, None, None, None, 1000, None, 7]
    assert apply(spark, ["9223372036854775807", "99999999999"], clean.coerce_bigint) == [9223372036854775807, 99999999999]
    assert apply(spark, ["3.0", "99999999999"], clean.coerce_int) == [3, None]
    assert apply(spark, ["1.5", "nan", "-inf", "1e999", ""], clean.coerce_double) == [1.5, None, None, None, None]
    assert apply(spark, ["1.5", "x", None], clean.zero_fill) == [1.5, 0.0, 0.0]


def test_text_tokens(spark):
    assert apply(spark, ["10:15:00.123", "nan", "NaT", "null", "None", None], clean.clean_time) == ["10:15:00"] + [None] * 5
    assert apply(spark, ["a", "nan", "NaN", "NaT", "<NA>"], clean.clean_string) == ["a", None, None, None, None]
    assert apply(spark, ["0 days 10:15:00", "10:15:00"], clean.last_time_token) == ["10:15:00"] * 2
    assert apply(spark, ["03/04/2024", "x"], clean.iso_date_string) == ["2024-03-04", None]
    assert apply(spark, ["1,234.50 🡅 (3.1%)", "12", "x", None], clean.extract_numeric) == [1234.5, 12.0, 0.0, 0.0]
    assert apply(spark, ["98 (76)-5", "+1 2"], clean.normalise_phone) == ["whatsapp:+98765", "whatsapp:+12"]


def test_rounding_is_stable(spark):
    assert apply(spark, [0.125, 2.675, -1.005], clean.rounded, "double") == [0.13, 2.68, -1.01]
    df = spark.range(1).select(clean.ratio(F.lit(1), F.lit(0)), clean.ratio(F.lit(2), F.lit(3)))
    assert tuple(df.first()) == (None, 0.67)


@pytest.mark.parametrize("days, bucket", [(0, 0), (6, 0), (7, 1), (13, 1), (14, 2), (20, 2), (21, None), (-1, None)])
def test_week_bucket(spark, days, bucket):
    end = dt.date(2024, 4, 30)
    df = spark.createDataFrame([(end - dt.timedelta(days=days), end)], "d date, e date")
    assert df.select(periods.week_bucket("d", "e")).first()[0] == bucket


def test_months(spark):
    assert periods.shift_month("2024-01", -1) == dt.date(2023, 12, 1)
    df = spark.createDataFrame([(dt.date(2024, 1, 31),), (dt.date(2024, 2, 29),), (dt.date(2024, 3, 1),)], "d date")
    assert df.where(periods.in_months("d", "2024-02")).count() == 1
    assert df.where(periods.in_months("d", "2024-01", "2024-02")).count() == 2
    start = F.lit(dt.date(2024, 3, 1))
    assert [r[0] for r in df.orderBy("d").select(periods.month_bucket("d", start)).collect()] == [2, 1, 0]


def test_product_text(spark):
    cases = {
        "Red Bull Energy Drink 250ml Can": "red bull energy drink can",
        "Gold Cigarettes 10S": "gold cigarette",
        "Oreo 21.00gm": "oreo",
        "Lays Small 12 x 20gm": "lays x",
        "Crème-Brûlée 80.00gm": "crème brûlée",
        "": "", None: "",
    }
    assert apply(spark, list(cases), names.preprocess_product_name) == list(cases.values())
    assert apply(spark, [" A-B™ & C® "], names.normalise_name) == ["a b and c"]
    assert apply(spark, ["bb 1 a crème cd"], names.name_tokens) == [["bb", "cd"]]
    assert apply(spark, ["b  a c"], names.sorted_tokens) == ["a b c"]
